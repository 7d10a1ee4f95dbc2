"""Queries for joins, grouped statistics, sorting, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from crownledger.functions import exprs as X
from crownledger.operators import adjudication as B
from crownledger.operators import aggregates as A
from crownledger.operators import joins as J
from crownledger.operators import ordered as O
from crownledger.plans.registry import query
from crownledger.schemas import CATEGORICAL



# --- joins -----------------------------------------------------------------------------------


@query("inner_equi_join")
def inner_equi_join(t):
    lines = t.lines_core().select("line_id", "invoice_id", "allowed_amount")
    return J.lines_with_service_date(lines, t.silver("invoices"))


@query("join_using")
def join_using(t):
    claims = t.silver("claims_and_payments").select("insurance_company_id", "claim_id", "claim_status")
    payers = t.silver("insurance_companies").select("insurance_company_id", "company_name", "payer_type")
    return J.with_dim(claims, payers, "insurance_company_id")


@query("left_join_preagg")
def left_join_preagg(t):
    count = lambda table, name: t.silver(table).groupBy("patient_id").agg(X.rows().alias(name))
    return J.parent_with_children(
        t.silver("patients").select("patient_id", "age_group"),
        "patient_id",
        [count("appointments", "visits"), count("invoices", "bills"), count("claims_and_payments", "claims")],
    )


@query("left_join_then_group")
def left_join_then_group(t):
    return J.count_children(
        t.silver("dental_offices").select("office_id", "office_name"),
        t.silver("claims_and_payments"),
        "office_id",
        {"claims": F.count("claim_id"), "denied": X.n_if("is_denied"), "claimed": X.total("amount_claimed")},
        zeros=["claims", "denied"],
    )


@query("fanout_guard")
def fanout_guard(t):
    return J.fanout_report(
        {
            "appointments": (t.silver("appointments"), {"visits": X.rows(), "no_shows": X.n_if("is_no_show")}),
            "invoices": (t.silver("invoices"), {"allowed": F.sum("total_allowed_amount")}),
            "claims": (t.silver("claims_and_payments"), {"denied": X.n_if("is_denied")}),
        },
        "patient_id",
        t.silver("patients"),
    )


@query("layer_count_join")
def layer_count_join(t):
    names = ["patients", "appointments", "invoices", "claims_and_payments"]
    return J.match_counts(
        A.table_counts({n: t.bronze(n) for n in names}), A.table_counts({n: t.silver(n) for n in names})
    )


@query("fk_orphans")
def fk_orphans(t):
    return J.orphans(t.bronze("invoices"), "appointment_id", t.bronze("appointments"), "appointment_id")


@query("cross_join_pairs")
def cross_join_pairs(t):
    return J.all_pairs(
        t.silver("dental_offices"), "office_id", t.silver("insurance_companies"), "insurance_company_id"
    )


@query("shared_network")
def shared_network(t):
    return J.shared_network(t.silver("office_network_participation"), t.silver("insurance_company_networks"))


@query("composite_key_join")
def composite_key_join(t):
    claims = t.silver("claims_and_payments").select(
        "claim_id", "office_id", "insurance_company_id", "network_status"
    )
    return J.compare_on(
        claims, t.silver("office_insurance_network"), ["office_id", "insurance_company_id"], "network_status"
    )


@query("index_join")
def index_join(t):
    invoices = t.silver("invoices").select("invoice_id", "total_gross_amount", "total_allowed_amount")
    return J.with_line_totals(invoices, t.lines_core())


@query("dependent_policy")
def dependent_policy(t):
    return J.patient_policy(t.silver("primary_policy_holders"), t.silver("policy_dependents"))


@query("coverage_lookup")
def coverage_lookup(t):
    visits = t.bronze("invoices").select("invoice_id", "policy_id")
    lines = t.lines_core().select("line_id", "invoice_id", "billing_code_id").join(visits, "invoice_id")
    used = lines.select("policy_id", "billing_code_id").distinct()
    rules = B.rules_for(used, t.bronze("billing_codes"), B.plan_design(t.spark)).drop("frequency_limit_per_year")
    return J.with_rule(lines, rules)


@query("star_join_metric")
def star_join_metric(t):
    claims = t.silver("claims_and_payments").select(
        "claim_id", "insurance_company_id", "office_id", "patient_id", "amount_claimed"
    )
    wide = J.star(
        claims,
        {
            "payer": (
                t.silver("insurance_companies").select("insurance_company_id", "company_name"),
                "insurance_company_id",
            ),
            "office": (t.silver("dental_offices").select("office_id", "state"), "office_id"),
            "patient": (t.silver("patients").select("patient_id", "gender"), "patient_id"),
        },
    )
    return wide


@query("subset_check")
def subset_check(t):
    completed = t.silver("appointments").filter(F.col("appointment_status") == "completed")
    return J.set_compare(t.silver("invoices"), completed, "appointment_id")


@query("set_equality")
def set_equality(t):
    denied = t.silver("claims_and_payments").filter("is_denied")
    return J.set_compare(t.silver("claim_disputes"), denied, "claim_id")


# --- grouped statistics ----------------------------------------------------------------------


@query("conditional_count")
def conditional_count(t):
    return t.silver("claims_and_payments").groupBy("network_status").agg(
        X.n_if("is_denied").alias("denied"), X.n_if(F.col("amount_claimed") > 100000).alias("large")
    )


@query("conditional_sum")
def conditional_sum(t):
    return t.silver("invoices").groupBy("benefit_year").agg(
        X.sum_if("patient_balance", "is_overdue").cast("double").alias("overdue_balance")
    )


@query("rate_pct")
def rate_pct(t):
    return t.silver("claims_and_payments").groupBy("office_id").agg(
        X.rate_pct("is_denied").alias("denial_pct"), X.rate_pct("is_denied", 1).alias("denial_pct_1")
    )


@query("avg_round")
def avg_round(t):
    return t.silver("claims_and_payments").groupBy("insurance_company_id").agg(
        X.mean_r("days_to_adjudicate", 1).alias("days"), X.mean_r("unpaid_amount", 2).alias("unpaid")
    )


@query("count_distinct")
def count_distinct(t):
    return A.distinct_stats(t.silver("invoices"), "patient_id")


@query("min_max_bounds")
def min_max_bounds(t):
    return A.bounds(t.silver("claims_and_payments"), F.col("benefit_year"), "label", "service_date")


@query("value_counts")
def value_counts(t):
    return A.value_counts(t.silver("claims_and_payments"), "denial_reason_code")


@query("utilization_buckets")
def utilization_buckets(t):
    return A.utilization(t.silver("patient_benefit_years"), "benefit_used_pct")


@query("avg_by_status")
def avg_by_status(t):
    return A.mean_by(t.silver("claims_and_payments"), "claim_status", "unpaid_amount")


@query("collect_set_per_key")
def collect_set_per_key(t):
    """Network set per office as text, next to the members as rows."""
    nets = t.silver("office_network_participation")
    sets = A.member_sets(nets, "office_id", "network_id")
    as_text = sets.select("office_id", F.array_join(F.transform("members", lambda m: m.cast("string")), ",").alias("networks"))
    return A.members(nets, "office_id", "network_id").join(as_text, "office_id")


@query("group_sizes")
def group_sizes(t):
    out = A.group_sizes(t.silver("appointment_reminders"), ["appointment_id"])
    return out.withColumn("in_range", F.col("n").between(1, 3))


@query("ratio_of_sums")
def ratio_of_sums(t):
    lines = t.silver("invoice_lines")
    off, kept = F.sum("contractual_writeoff"), F.sum("allowed_amount")
    return lines.groupBy("procedure_category").agg(X.share_pct(off, off + kept, 2).alias("writeoff_pct"))


@query("doc_size_stats")
def doc_size_stats(t):
    return A.text_stats(t.raw("pages"), "html")


# --- ordered ---------------------------------------------------------------------------------


@query("reminder_sequence")
def reminder_sequence(t):
    out = O.sequence(t.silver("appointment_reminders"), ["appointment_id"], "lead_days", "appointment_reminder_id")
    return out.select(
        "appointment_reminder_id", "appointment_id", F.col("lead_days").cast("bigint").alias("lead_days"), "seq", "is_last"
    )


@query("first_in_year")
def first_in_year(t):
    """First cleaning visit of a patient in a benefit year, which gets the longer exam."""
    visits = t.silver("appointments").filter(F.col("visit_type") == "cleaning")
    visits = visits.select("appointment_id", "patient_id", "benefit_year", "appointment_date_time")
    return O.first_in(visits, ["patient_id", "benefit_year"], ["appointment_date_time", "appointment_id"])


@query("noshow_concentration")
def noshow_concentration(t):
    return O.concentration(t.silver("appointments"), "patient_id", "is_no_show", [0.1, 0.18, 0.5])


@query("seasonality")
def seasonality(t):
    return O.seasonality(t.silver("invoices"), "service_date")


# --- sort, top-k, sets -----------------------------------------------------------------------


@query("order_by_multi")
def order_by_multi(t):
    g = t.gold("gold_revenue_by_procedure")
    return g.select("month", "procedure_category", "total_allowed").orderBy("month", "procedure_category")


@query("order_desc")
def order_desc(t):
    g = t.gold("gold_recall_effectiveness")
    keys = ["recall_type", "communication_channel", "delivery_status", "patient_response"]
    return g.select(*keys, "total_sent").orderBy(F.desc("total_sent"), *keys)


@query("topk")
def topk(t):
    """Five offices with the highest revenue."""
    offices = t.gold("gold_office_performance").select(
        "office_id", "office_name", "specialty_type", "total_revenue", "no_show_rate_pct", "denial_rate_pct"
    )
    return A.top_n(offices, "total_revenue", ["office_id"], 5)


@query("latest_month_rows")
def latest_month_rows(t):
    """Twelve most recent month and category rows."""
    g = t.gold("gold_revenue_by_procedure")
    out = g.select("month", "procedure_category", "total_allowed", "insurance_portion", "patient_portion")
    return A.top_n(out, "month", ["procedure_category"], 12)


@query("limit_sample")
def limit_sample(t):
    """Five rows of a table, of those with the smallest ids, so that the result is the same every time."""
    claims = t.bronze("claims_and_payments")
    return claims.orderBy("claim_id").limit(5).select("claim_id", "invoice_id", "claim_status")


@query("distinct_rows")
def distinct_rows(t):
    g = t.gold("gold_appointment_analytics")
    return g.select("visit_type", "total_appointments", "no_show_rate_pct", "cancellation_rate_pct").distinct()


@query("union_all_counts")
def union_all_counts(t):
    return A.table_counts(t.silver_all())


@query("value_inventory")
def value_inventory(t):
    return A.value_inventory({n: t.silver(n) for n in {table for table, _ in CATEGORICAL}}, CATEGORICAL)


@query("set_difference")
def set_difference(t):
    """Codes that are billed against codes that are listed as needing authorisation."""
    listed = t.silver("billing_codes").filter("requires_prior_auth").select("billing_code_id")
    billed = t.lines_core().select("billing_code_id")
    return A.set_diff(listed, billed, "billing_code_id")



"""Business questions, metric views, dashboard datasets and routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from crownledger.functions import exprs as X
from crownledger.operators import aggregates as A
from crownledger.operators import retrieval as S
from crownledger.operators import semantic as G
from crownledger.plans.registry import query

YEAR_LABEL = "1998-99"
ANSWER_SCORE = 10.0  # keyword score from which a passage counts as an answer


# --- vocabulary ------------------------------------------------------------------------------


@query("normalize_value")
def normalize_value(t):
    """Raw wording of two claim columns mapped to stored values."""
    claims = t.bronze("claims_and_payments")
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias("term"))
            for c in ("claim_status", "network_status", "denial_reason_code")
        ]
    )
    terms = claims.select("claim_id", F.explode(cells).alias("x")).select("claim_id", "x.*")
    return G.normalize(terms.filter("term is not null"), "column_name", "term", G.synonym_table(t.spark))


@query("amount_semantics")
def amount_semantics(t):
    tables = {n: t.silver(n) for n in ("invoices", "claims_and_payments")}
    return G.measures(tables, G.AMOUNTS)


@query("benefit_year_check")
def benefit_year_check(t):
    return G.benefit_year_check(t.silver("claims_and_payments"), "service_date")


@query("benefit_year_drift")
def benefit_year_drift(t):
    return G.benefit_year_drift(t.silver("invoices"))


# --- questions -------------------------------------------------------------------------------


@query("q_claims_in_benefit_year")
def q_claims_in_benefit_year(t):
    return G.q_claims_in_benefit_year(t.silver("claims_and_payments"), YEAR_LABEL)


@query("q_claims_by_reason")
def q_claims_by_reason(t):
    out = G.q_claims_by_reason(t.silver("claims_and_payments"), "Max Benefit Exceeded")
    return out.select("claim_id", "patient_id", "service_date", "amount_claimed", "denial_reason_code")


@query("q_denial_rate_by_payer")
def q_denial_rate_by_payer(t):
    return G.q_denial_rate_by_payer(t.silver("claims_and_payments"), t.silver("insurance_companies"))


@query("q_writeoff_by_category")
def q_writeoff_by_category(t):
    lines = t.lines_core().withColumn("contractual_writeoff", F.col("unit_price") - F.col("allowed_amount"))
    return G.q_writeoff_by_category(lines, t.silver("billing_codes"))


@query("q_monthly_completed")
def q_monthly_completed(t):
    return G.q_monthly_completed(t.silver("appointments"))


@query("q_ar_over_90")
def q_ar_over_90(t):
    return G.q_ar_over_90(t.silver("invoices"), t.silver("dental_offices"), t.as_of)


@query("q_calendar_year_split")
def q_calendar_year_split(t):
    return G.q_calendar_year_split(t.silver("claims_and_payments"), 1998)


@query("q_noshow_history")
def q_noshow_history(t):
    """All patients, in no order: a ranking of all of them would be a global sort."""
    return G.q_noshow_history(t.silver("appointments"))


@query("ar_aging")
def ar_aging(t):
    return G.ar_aging(t.silver("invoices"), t.as_of)


# --- metric views ----------------------------------------------------------------------------


def _view(t, view, dims, names, where=None):
    needed = {view.source, *[table for table, _ in view.joins.values()]}
    return view.query({n: t.silver(n) for n in needed}, dims, names, where)


@query("metric_view")
def metric_view(t):
    """Claims by payer type and status, in-network only."""
    where = F.col("network_status") == "in-network"
    return _view(t, G.CLAIMS_VIEW, ["payer_type", "claim_status"], ["claim_count", "total_claimed"], where)


@query("mv_claims")
def mv_claims(t):
    return _view(
        t,
        G.CLAIMS_VIEW,
        ["company_name", "office_state", "payer_type", "claim_status"],
        ["unpaid_amount", "total_claimed", "total_paid", "claim_count"],
    )


@query("mv_revenue")
def mv_revenue(t):
    return _view(t, G.REVENUE_VIEW, ["gender", "patient_state", "age"], ["total_revenue", "invoice_count"])


for _key, _mv, _dim, _measure in [
    ("chart_unpaid_by_payer", G.CLAIMS_VIEW, "company_name", "unpaid_amount"),
    ("chart_claimed_by_office", G.CLAIMS_VIEW, "office_name", "total_claimed"),
    ("chart_claims_by_state", G.CLAIMS_VIEW, "office_state", "claim_count"),
    ("chart_paid_by_payer_type", G.CLAIMS_VIEW, "payer_type", "total_paid"),
    ("chart_revenue_by_gender", G.REVENUE_VIEW, "gender", "total_revenue"),
    ("chart_unpaid_by_office", G.CLAIMS_VIEW, "office_name", "unpaid_amount"),
]:
    query(_key)(lambda t, v=_mv, d=_dim, m=_measure: _view(t, v, [d], [m]))


# --- dashboard datasets ----------------------------------------------------------------------


@query("ds_overview_kpis")
def ds_overview_kpis(t):
    return t.gold("gold_kpi_summary").select(
        "total_patients", "total_appointments", "total_claims", "total_revenue", "denial_rate_pct", "no_show_rate_pct"
    )


for _key, _table, _col in [
    ("ds_appointment_status", "appointments", "appointment_status"),
    ("ds_claim_status", "claims_and_payments", "claim_status"),
    ("ds_dispute_outcomes", "claim_disputes", "dispute_outcome"),
]:
    query(_key)(lambda t, table=_table, col=_col: A.group_sizes(t.silver(table), [col]))


@query("ds_monthly_financials")
def ds_monthly_financials(t):
    return t.gold("gold_monthly_revenue").select(
        "month", F.col("net_revenue").alias("revenue"), F.col("outstanding_patient_balance").alias("balance")
    )


@query("ds_denial_by_payer")
def ds_denial_by_payer(t):
    return t.gold("gold_payer_performance").select(
        "insurance_company_id", "company_name", "actual_denial_rate_pct", "avg_days_to_adjudicate"
    )


@query("ds_denial_reasons")
def ds_denial_reasons(t):
    """Reasons of denied claims; paid ones carry a literal placeholder and are left out by the flag."""
    return A.group_sizes(t.silver("claims_and_payments").filter("is_denied"), ["denial_reason_code"])


@query("ds_appointments_by_office")
def ds_appointments_by_office(t):
    return t.gold("gold_office_performance").select("office_id", "office_name", "total_appointments")


@query("ds_noshow_by_age_group")
def ds_noshow_by_age_group(t):
    return t.gold("gold_patient_summary").groupBy("age_group").agg(
        X.share_pct(F.sum("no_show_count"), F.sum("total_appointments"), 2).alias("no_show_rate_pct")
    )


@query("ds_visit_types")
def ds_visit_types(t):
    return t.gold("gold_appointment_analytics").groupBy("visit_type").agg(F.sum("total_appointments").alias("n"))


@query("ds_recall_effectiveness")
def ds_recall_effectiveness(t):
    return t.gold("gold_recall_effectiveness").groupBy("recall_type").agg(
        X.share_pct(F.sum("appointments_created"), F.sum("total_sent"), 2).alias("conversion_rate_pct")
    )


@query("ds_balance_by_office")
def ds_balance_by_office(t):
    return t.gold("gold_office_performance").select("office_id", "office_name", "outstanding_patient_balance")


@query("ds_revenue_by_category")
def ds_revenue_by_category(t):
    return t.gold("gold_revenue_by_procedure").groupBy("procedure_category").agg(
        F.round(F.sum("total_allowed"), 2).alias("allowed")
    )


@query("ds_network_comparison")
def ds_network_comparison(t):
    return t.silver("claims_and_payments").groupBy("network_status").agg(
        X.rows().alias("n"), X.total("amount_claimed").alias("claimed")
    )


@query("measure_revenue_per_patient")
def measure_revenue_per_patient(t):
    return G.per_entity(
        t.silver("invoices"), t.silver("patients"), F.sum("total_allowed_amount"), "revenue_per_patient"
    )


@query("measure_claims_per_appointment")
def measure_claims_per_appointment(t):
    return G.per_entity(t.silver("claims_and_payments"), t.silver("appointments"), X.rows(), "claims_per_appointment")


@query("measure_revenue_per_office")
def measure_revenue_per_office(t):
    return G.per_entity(
        t.silver("invoices"), t.silver("dental_offices"), F.sum("total_allowed_amount"), "revenue_per_office"
    )


@query("measure_unpaid_amount")
def measure_unpaid_amount(t):
    return t.silver("claims_and_payments").agg(
        (F.sum("amount_claimed") - F.sum("amount_paid")).cast("double").alias("unpaid_claim_amount")
    )


# --- routing ---------------------------------------------------------------------------------


@query("route_questions")
def route_questions(t):
    """User turns routed by wording, and by how well the reference passages match them."""
    turns = t.raw("conversations").filter(F.col("role") == "user").select("conv_id", "turn", "text")
    best = S.best_score(turns, ["conv_id", "turn"], "text", t.raw("benchmark"), "item_id", "text")
    found = S.answerable(best, ANSWER_SCORE, ["conv_id", "turn"])
    return G.route(turns, ["conv_id", "turn"], hits=found)


@query("route_eval")
def route_eval(t):
    """How stable routes are in a conversation: the route of the first user turn against all of its turns."""
    routes = route_questions(t)
    first = routes.groupBy("conv_id").agg(F.min_by("route", "turn").alias("route"))
    gold = routes.select("conv_id", "turn").join(first, "conv_id")
    return G.route_eval(routes, gold, ["conv_id", "turn"])



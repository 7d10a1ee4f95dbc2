"""Adjudication queries: accumulators and revenue-cycle rules on the bound tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from crownledger.functions import exprs as X
from crownledger.operators import adjudication as B
from crownledger.plans.registry import query

LINE = ["line_id", "invoice_id", "patient_id", "benefit_year"]


def status_lines(t):
    """Lines with the network status of their claim."""
    claims = t.bronze("claims_and_payments").select("invoice_id", "network_status")
    return t.lines_core().select("line_id", "invoice_id", "billing_code_id").join(claims, "invoice_id")


@query("deductible_accumulator")
def deductible_accumulator(t):
    return B.deductible_applied(t.adjudication_lines()).select(*LINE, "allowed_amount", "deductible_applied")


@query("annual_max_accumulator")
def annual_max_accumulator(t):
    out = B.insurance_estimate(t.adjudication_lines())
    return out.select(*LINE, "est_uncapped", F.col("est_insurance").alias("paid_est"))


@query("benefit_year_rollup")
def benefit_year_rollup(t):
    return B.benefit_years(t.adjudication_lines())


@query("allowed_amount")
def allowed_amount(t):
    out = B.allowed(status_lines(t), t.bronze("billing_codes"))
    return out.select("line_id", "billing_code_id", "network_status", "allowed_amount")


@query("contractual_writeoff")
def contractual_writeoff(t):
    out = B.writeoff(B.allowed(status_lines(t), t.bronze("billing_codes")))
    return out.select("line_id", "network_status", "standard_fee", "allowed_amount", "contractual_writeoff")


@query("insurance_estimate")
def insurance_estimate(t):
    out = B.insurance_estimate(t.adjudication_lines())
    return out.select("line_id", "deductible_applied", "copay_flat_amount", "coinsurance_percentage", "est_insurance")


@query("patient_estimate")
def patient_estimate(t):
    out = B.patient_estimate(B.insurance_estimate(t.adjudication_lines()))
    return out.select("line_id", "allowed_amount", "est_insurance", "est_patient")


@query("invoice_rollup")
def invoice_rollup(t):
    visits = t.bronze("invoices").select("invoice_id", "service_date", "actual_patient_paid_at_visit")
    return B.roll_up(t.bronze("invoice_lines"), visits)


@query("needs_prior_auth")
def needs_prior_auth(t):
    return B.needs_auth(t.lines_core(), t.bronze("billing_codes"))


@query("adjudication_days")
def adjudication_days(t):
    out = B.days_to_adjudicate(t.bronze("claims_and_payments"))
    return out.select("claim_id", "submitted_date", "adjudicated_date", "days")


@query("denial_reason_precedence")
def denial_reason_precedence(t):
    out = B.denial_reason(t.judged_claims())
    return out.select("claim_id", "is_denied", "is_exhausted", "needs_auth", "reason")


@query("denial_risk_score")
def denial_risk_score(t):
    out = B.denial_risk(t.judged_claims(), t.silver("insurance_companies"))
    return out.select("claim_id", "insurance_company_id", "risk")


@query("dispute_reason_map")
def dispute_reason_map(t):
    claims = t.silver("claims_and_payments").select("claim_id", "denial_reason_code")
    disputes = t.silver("claim_disputes").select("dispute_id", "claim_id", "dispute_reason_category")
    out = B.dispute_reason(disputes.join(claims, "claim_id"))
    return out.withColumn("agrees", F.lower("category") == F.col("dispute_reason_category"))


@query("amount_recovered")
def amount_recovered(t):
    disputes = t.silver("claim_disputes").select("dispute_id", "claim_id", "dispute_outcome")
    return B.recovered(disputes, t.silver("claims_and_payments"))


@query("network_status")
def network_status(t):
    return B.network_status(
        t.silver("dental_offices"),
        t.silver("insurance_companies"),
        t.silver("office_network_participation"),
        t.silver("insurance_company_networks"),
    ).withColumn("shared_network_id", F.coalesce("shared_network_id", F.lit(0)))


@query("coverage_matrix")
def coverage_matrix(t):
    out = B.coverage_matrix(t.bronze("insurance_policies"), t.bronze("billing_codes"), B.plan_design(t.spark))
    return out.withColumn("frequency_limit_per_year", F.coalesce("frequency_limit_per_year", F.lit(0)))


@query("coverage_tier")
def coverage_tier(t):
    out = B.coverage_tier(t.bronze("primary_policy_holders"), t.bronze("policy_dependents"))
    return out.select("subscriber_id", "dependents", "tier", (F.col("tier") == F.col("coverage_tier")).alias("agrees"))


@query("weekday_shift")
def weekday_shift(t):
    return t.bronze("claims_and_payments").select(
        "claim_id", "adjudicated_date", X.to_weekday("adjudicated_date").alias("business_date")
    )


@query("recall_to_visit")
def recall_to_visit(t):
    return B.recall_funnel(t.silver("recall_reminders"), t.silver("appointments"))

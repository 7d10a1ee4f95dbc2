"""Gold layer: eight business aggregates. Children are always aggregated before they are joined."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crownledger.functions import exprs as X
from crownledger.operators import joins


def one_row(*parts: DataFrame) -> DataFrame:
    """Put one-row aggregates with different columns side by side, without a cross join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def gold_kpi_summary(
    patients: DataFrame, appointments: DataFrame, claims: DataFrame, invoices: DataFrame, disputes: DataFrame
) -> DataFrame:
    """Ten overview measures in one row; each table is read once."""
    rows = F.count(F.lit(1))
    return one_row(
        patients.agg(rows.alias("total_patients")),
        appointments.agg(rows.alias("total_appointments"), X.rate_pct("is_no_show").alias("no_show_rate_pct")),
        claims.agg(rows.alias("total_claims"), X.rate_pct("is_denied").alias("denial_rate_pct")),
        invoices.agg(
            rows.alias("total_invoices"),
            X.total("total_allowed_amount").alias("total_revenue"),
            X.total("patient_balance").alias("total_patient_balance"),
            X.rate_pct("is_overdue").alias("overdue_rate_pct"),
        ),
        disputes.agg(rows.alias("total_disputes")),
    )


def gold_monthly_revenue(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy(X.month_of("service_date").alias("month")).agg(
        F.count(F.lit(1)).alias("invoice_count"),
        X.total("total_gross_amount").alias("gross_revenue"),
        X.total("total_allowed_amount").alias("net_revenue"),
        X.total("total_contractual_writeoff").alias("total_writeoffs"),
        X.total("estimated_insurance_responsibility").alias("insurance_portion"),
        X.total("patient_balance").alias("outstanding_patient_balance"),
        X.n_if("is_overdue").alias("overdue_invoices"),
        X.sum_if("patient_balance", "is_overdue").alias("overdue_balance"),
    )


def gold_revenue_by_procedure(lines: DataFrame, invoices: DataFrame) -> DataFrame:
    """Month by category. Lines are summed per invoice and category before they meet the invoices,
    so an invoice with very many lines is reduced in the map tasks."""
    amounts = {
        "total_allowed": "allowed_amount",
        "total_writeoffs": "contractual_writeoff",
        "insurance_portion": "estimated_insurance_amount",
        "patient_portion": "estimated_patient_amount",
        "total_discounts": "discount_applied",
    }
    per_invoice = lines.groupBy("invoice_id", "procedure_category").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum("quantity").alias("total_units"),
        *[F.sum(col).alias(name) for name, col in amounts.items()],
    )
    dated = joins.lines_with_service_date(per_invoice, invoices)
    return dated.groupBy(X.month_of("service_date").alias("month"), "procedure_category").agg(
        F.sum("line_count").alias("line_count"),
        F.sum("total_units").alias("total_units"),
        *[X.total(name).alias(name) for name in amounts],
    )


def _visits_by(appointments: DataFrame, key: str, *extra: Column) -> DataFrame:
    return appointments.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_appointments"),
        X.n_if("is_no_show").alias("no_show_count"),
        X.n_if("is_cancelled").alias("cancelled_count"),
        *extra,
        X.rate_pct("is_no_show").alias("no_show_rate_pct"),
    )


def _invoices_by(invoices: DataFrame, key: str, spent: str, balance: str) -> DataFrame:
    return invoices.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_invoices"),
        X.total("total_allowed_amount").alias(spent),
        X.total("patient_balance").alias(balance),
    )


def _claims_by(claims: DataFrame, key: str, *extra: Column) -> DataFrame:
    return claims.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_claims"),
        X.n_if("is_denied").alias("denied_claims"),
        X.rate_pct("is_denied").alias("denial_rate_pct"),
        *extra,
    )


def gold_patient_summary(
    patients: DataFrame, appointments: DataFrame, invoices: DataFrame, claims: DataFrame
) -> DataFrame:
    completed = X.n_if(F.col("appointment_status") == "completed").alias("completed_visits")
    return joins.parent_with_children(
        patients.select("patient_id", "first_name", "last_name", "age", "age_group", "gender", "state"),
        "patient_id",
        [
            _visits_by(appointments, "patient_id", completed),
            _invoices_by(invoices, "patient_id", "total_spent", "outstanding_balance"),
            _claims_by(claims, "patient_id"),
        ],
    )


def gold_office_performance(
    offices: DataFrame, appointments: DataFrame, invoices: DataFrame, claims: DataFrame
) -> DataFrame:
    return joins.parent_with_children(
        offices.select("office_id", "office_name", "city", "state", "specialty_type", "provider_count"),
        "office_id",
        [
            _visits_by(appointments, "office_id"),
            _invoices_by(invoices, "office_id", "total_revenue", "outstanding_patient_balance"),
            _claims_by(claims, "office_id", X.mean_r("days_to_adjudicate", 1).alias("avg_days_to_adjudicate")),
        ],
    )


def gold_payer_performance(payers: DataFrame, claims: DataFrame) -> DataFrame:
    """A payer without claims has zero counts and rate, but NULL sums and mean."""
    network = F.col("network_status")
    return joins.count_children(
        payers.select(
            "insurance_company_id",
            "company_name",
            "payer_type",
            "average_reimbursement_turnaround_days",
            "denial_rate_baseline",
        ),
        claims,
        "insurance_company_id",
        {
            "total_claims": F.count("claim_id"),
            "denied_claims": X.n_if("is_denied"),
            "actual_denial_rate_pct": X.rate_pct("is_denied"),
            "avg_days_to_adjudicate": X.mean_r("days_to_adjudicate", 1),
            "total_claimed": X.total("amount_claimed"),
            "total_paid": X.total("amount_paid"),
            "total_unpaid": X.total("unpaid_amount"),
            "in_network_claims": X.n_if(network == "in-network"),
            "out_network_claims": X.n_if(network == "out-of-network"),
        },
        zeros=["total_claims", "denied_claims", "actual_denial_rate_pct", "in_network_claims", "out_network_claims"],
    )


def gold_appointment_analytics(appointments: DataFrame) -> DataFrame:
    return appointments.groupBy(X.month_of("appointment_date").alias("month"), "visit_type").agg(
        F.count(F.lit(1)).alias("total_appointments"),
        X.n_if("is_no_show").alias("no_show_count"),
        X.n_if("is_cancelled").alias("cancelled_count"),
        X.n_if(F.col("appointment_status") == "completed").alias("completed_count"),
        X.rate_pct("is_no_show").alias("no_show_rate_pct"),
        X.rate_pct("is_cancelled").alias("cancellation_rate_pct"),
    )


def gold_recall_effectiveness(recalls: DataFrame) -> DataFrame:
    return recalls.groupBy("recall_type", "communication_channel", "delivery_status", "patient_response").agg(
        F.count(F.lit(1)).alias("total_sent"),
        X.n_if("resulted_in_appointment").alias("appointments_created"),
        X.rate_pct("resulted_in_appointment").alias("conversion_rate_pct"),
    )


# Builders take anything with a ``silver(name)`` method that returns the cleaned table.
BUILDERS = {
    "gold_kpi_summary": lambda t: gold_kpi_summary(
        t.silver("patients"),
        t.silver("appointments"),
        t.silver("claims_and_payments"),
        t.silver("invoices"),
        t.silver("claim_disputes"),
    ),
    "gold_monthly_revenue": lambda t: gold_monthly_revenue(t.silver("invoices")),
    "gold_revenue_by_procedure": lambda t: gold_revenue_by_procedure(t.silver("invoice_lines"), t.silver("invoices")),
    "gold_patient_summary": lambda t: gold_patient_summary(
        t.silver("patients"), t.silver("appointments"), t.silver("invoices"), t.silver("claims_and_payments")
    ),
    "gold_office_performance": lambda t: gold_office_performance(
        t.silver("dental_offices"), t.silver("appointments"), t.silver("invoices"), t.silver("claims_and_payments")
    ),
    "gold_payer_performance": lambda t: gold_payer_performance(
        t.silver("insurance_companies"), t.silver("claims_and_payments")
    ),
    "gold_appointment_analytics": lambda t: gold_appointment_analytics(t.silver("appointments")),
    "gold_recall_effectiveness": lambda t: gold_recall_effectiveness(t.silver("recall_reminders")),
}

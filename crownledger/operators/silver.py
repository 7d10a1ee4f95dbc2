"""Silver layer: one stateless transform per bronze table, so each works on batches and on streams."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crownledger.functions import exprs as X
from crownledger.schemas import columns_of


def standardize(df: DataFrame, lower: Iterable[str] = (), upper: Iterable[str] = ()) -> DataFrame:
    """Lower or upper case the named text columns, keep everything else."""
    return df.withColumns({**{c: F.lower(c) for c in lower}, **{c: F.upper(c) for c in upper}})


def fill(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace NULLs per column by a constant or by a Column that depends on the row.

    A constant is cast to the column's declared type, so an integer key stays an integer.
    """
    types = dict(df.dtypes)
    return df.withColumns(
        {
            name: F.coalesce(name, value if isinstance(value, Column) else F.lit(value).cast(types[name]))
            for name, value in defaults.items()
        }
    )


def stamp(df: DataFrame, name: str = "_silver_loaded_at") -> DataFrame:
    """Load time per row. Only sinks call this, so transforms stay reproducible."""
    return df.withColumn(name, F.current_timestamp())


def _declared(table: str, df: DataFrame) -> DataFrame:
    return df.select(*columns_of(table))


def dental_offices(df: DataFrame) -> DataFrame:
    return standardize(_declared("dental_offices", df), lower=["specialty_type"], upper=["state"])


def insurance_companies(df: DataFrame) -> DataFrame:
    return standardize(_declared("insurance_companies", df), lower=["payer_type"])


def insurance_networks(df: DataFrame) -> DataFrame:
    return standardize(_declared("insurance_networks", df), lower=["network_type", "region"])


def insurance_company_networks(df: DataFrame) -> DataFrame:
    return _declared("insurance_company_networks", df)


def office_network_participation(df: DataFrame) -> DataFrame:
    return _declared("office_network_participation", df)


def office_insurance_network(df: DataFrame) -> DataFrame:
    out = _declared("office_insurance_network", df).withColumn(
        "shared_network_id", F.col("shared_network_id").cast("bigint")
    )
    return standardize(fill(out, {"shared_network_id": 0}), lower=["network_status"])


def insurance_policies(df: DataFrame) -> DataFrame:
    return _declared("insurance_policies", df)


def billing_codes(df: DataFrame) -> DataFrame:
    return standardize(_declared("billing_codes", df), lower=["procedure_category"])


def coverage_rules(df: DataFrame) -> DataFrame:
    return _declared("coverage_rules", df)


def patients(df: DataFrame) -> DataFrame:
    out = _declared("patients", df).withColumns(
        {"age_group": X.age_group("age"), "gender": X.gender_word("gender")}
    )
    return standardize(out, lower=["patient_role"], upper=["state"])


def primary_policy_holders(df: DataFrame) -> DataFrame:
    return standardize(_declared("primary_policy_holders", df), lower=["employment_status", "coverage_tier"])


def policy_dependents(df: DataFrame) -> DataFrame:
    return standardize(_declared("policy_dependents", df), lower=["relationship_to_subscriber"])


def patient_benefit_years(df: DataFrame) -> DataFrame:
    return _declared("patient_benefit_years", df).withColumns(
        {
            "deductible_met_pct": X.guarded_pct("deductible_met", "individual_deductible"),
            "benefit_used_pct": X.guarded_pct("benefit_used", "annual_maximum"),
            "is_benefit_exhausted": F.col("benefit_remaining") <= 0,
        }
    )


def recall_reminders(df: DataFrame) -> DataFrame:
    return standardize(
        _declared("recall_reminders", df),
        lower=["recall_type", "communication_channel", "delivery_status", "patient_response"],
    )


def appointments(df: DataFrame) -> DataFrame:
    out = _declared("appointments", df).withColumn("source_recall_id", F.col("source_recall_id").cast("bigint"))
    out = standardize(fill(out, {"source_recall_id": 0}), lower=["visit_type", "appointment_status"])
    return out.withColumns(
        {
            "appointment_date": F.col("appointment_date_time").cast("date"),
            "day_of_week": F.date_format("appointment_date_time", "EEEE"),
            "is_no_show": F.col("appointment_status") == "no-show",
            "is_cancelled": F.col("appointment_status") == "cancelled",
        }
    )


def appointment_reminders(df: DataFrame) -> DataFrame:
    return standardize(
        _declared("appointment_reminders", df),
        lower=["communication_channel", "delivery_status", "patient_response"],
    )


def invoices(df: DataFrame, as_of: date) -> DataFrame:
    overdue = X.is_overdue("due_date", "patient_balance", as_of)
    return _declared("invoices", df).withColumns(
        {
            "has_patient_balance": F.col("patient_balance") > 0,
            "is_overdue": overdue,
            "days_overdue": F.when(overdue, F.datediff(X.day(as_of), "due_date")).otherwise(0),
        }
    )


def invoice_lines(df: DataFrame) -> DataFrame:
    return standardize(_declared("invoice_lines", df), lower=["procedure_category"])


def claims_and_payments(df: DataFrame) -> DataFrame:
    out = standardize(_declared("claims_and_payments", df), lower=["claim_status", "network_status"])
    out = out.withColumns(
        {
            "unpaid_amount": F.col("amount_claimed") - F.col("amount_paid"),
            "is_denied": F.col("claim_status") == "denied",
        }
    )
    return fill(out, {"denial_reason_code": F.when(F.col("is_denied"), "UNKNOWN").otherwise("N/A")})


def claim_disputes(df: DataFrame) -> DataFrame:
    return standardize(_declared("claim_disputes", df), lower=["dispute_reason_category", "dispute_outcome"])


TRANSFORMS: dict[str, Callable[..., DataFrame]] = {
    f.__name__: f
    for f in (
        dental_offices,
        insurance_companies,
        insurance_networks,
        insurance_company_networks,
        office_network_participation,
        office_insurance_network,
        insurance_policies,
        billing_codes,
        coverage_rules,
        patients,
        primary_policy_holders,
        policy_dependents,
        patient_benefit_years,
        recall_reminders,
        appointments,
        appointment_reminders,
        invoices,
        invoice_lines,
        claims_and_payments,
        claim_disputes,
    )
}


def to_silver(table: str, df: DataFrame, as_of: date) -> DataFrame:
    fn = TRANSFORMS[table]
    return fn(df, as_of) if table == "invoices" else fn(df)

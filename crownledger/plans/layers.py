"""Queries over the silver and gold layers."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from crownledger.functions import exprs as X
from crownledger.operators import gold, silver
from crownledger.plans.registry import query
from crownledger.schemas import TABLES

for _table in TABLES:
    query(f"silver_{_table}")(lambda t, _table=_table: t.silver(_table))

for _table in gold.BUILDERS:
    query(_table)(lambda t, _table=_table: t.gold(_table))


@query("standardize_text")
def standardize_text(t):
    out = silver.standardize(
        t.bronze("dental_offices"), lower=["office_name", "city", "specialty_type"], upper=["state"]
    )
    return out.select("office_id", "office_name", "city", "state", "specialty_type")


@query("null_defaults")
def null_defaults(t):
    claims = t.bronze("claims_and_payments").select("claim_id", "claim_status", "denial_reason_code", "office_id")
    reason = F.when(F.col("claim_status") == "Denied", "UNKNOWN").otherwise("N/A")
    return silver.fill(claims, {"denial_reason_code": reason, "office_id": -1})


@query("audit_column")
def audit_column(t):
    stamped = silver.stamp(t.silver("insurance_companies"))
    return stamped.select(
        "insurance_company_id",
        F.col("_silver_loaded_at").isNotNull().alias("is_stamped"),
        (F.col("_silver_loaded_at") <= F.current_timestamp()).alias("not_in_future"),
    )


@query("scalar_suite")
def scalar_suite(t):
    """Scalar rules side by side, one row per claim."""
    service = F.col("service_date")
    return t.bronze("claims_and_payments").select(
        "claim_id",
        F.upper("claim_status").alias("status_upper"),
        F.lower("network_status").alias("network_lower"),
        F.coalesce("denial_reason_code", F.lit("none")).alias("reason_or_none"),
        F.when(F.col("days_to_adjudicate").between(10, 19), "fast")
        .when(F.col("days_to_adjudicate").between(20, 39), "normal")
        .otherwise("slow")
        .alias("speed_band"),
        (F.col("claim_status") == "Denied").alias("is_denied"),
        ((X.day(t.as_of) > service) & (F.col("amount_claimed") > 0)).alias("is_past_with_amount"),
        F.round(F.col("amount_claimed") * F.lit(Decimal("0.1")), 2).cast("double").alias("tenth"),
        (F.col("amount_claimed") - F.col("amount_paid")).cast("double").alias("unpaid"),
        service.cast("string").alias("service_text"),
        F.date_format(service, "EEEE").alias("weekday"),
        F.datediff(X.day(t.as_of), service).cast("bigint").alias("age_days"),
        X.month_of(service).alias("month"),
        F.year(service).cast("bigint").alias("y"),
        F.month(service).cast("bigint").alias("m"),
        F.concat(F.lit("C"), F.right(F.col("claim_id").cast("string"), F.lit(2))).alias("short_id"),
        F.round(
            F.try_divide(F.col("amount_paid").cast("double"), F.nullif("amount_claimed", F.lit(0)).cast("double")), 4
        ).alias("paid_ratio"),
        X.utilization_band(F.col("claim_id") % 120).alias("band"),
        F.length(F.coalesce("denial_reason_code", F.lit(""))).cast("bigint").alias("reason_len"),
        F.left("claim_status", F.lit(3)).alias("status_left"),
        F.col("claim_status").like("%-Paid").alias("is_paid_suffix"),
        F.lit("amount_paid").like(r"amount\_%").alias("escaped_like"),
        F.col("denial_reason_code").isin("Coding Error", "Missing X-Ray").alias("is_listed"),
        (F.coalesce("denial_reason_code", F.lit("N/A")) != "N/A").alias("has_reason"),
        F.col("denial_reason_code").isNull().alias("reason_is_null"),
        X.base_name(F.concat_ws("/", F.lit("claims"), "insurance_company_id", "claim_id")).alias("base_name"),
        F.date_add(service, 30).alias("due"),
        F.date_sub(service, 7).alias("week_before"),
        F.least("days_to_adjudicate", F.lit(30)).cast("bigint").alias("capped_days"),
        F.greatest("days_to_adjudicate", F.lit(20)).cast("bigint").alias("floored_days"),
        X.within("amount_claimed", "amount_paid").alias("is_settled"),
        F.element_at(F.create_map(F.lit("version"), F.lit("2.0")), "version").alias("option"),
        F.variant_get(
            F.parse_json(F.concat(F.lit('{"pages":[{"page_id":'), F.col("claim_id"), F.lit("}]}"))),
            "$.pages[0].page_id",
            "bigint",
        ).alias("first_page"),
        F.schema_of_variant(F.parse_json(F.concat(F.lit('{"id":'), F.col("claim_id"), F.lit("}")))).alias("shape"),
    )


@query("benefit_year_label")
def benefit_year_label(t):
    return t.bronze("claims_and_payments").select(
        "claim_id",
        X.benefit_year("service_date").alias("september"),
        X.benefit_year("service_date", 7).alias("july"),
        X.benefit_year("service_date", 1).alias("january"),
    )


@query("stable_key")
def stable_key(t):
    return t.raw("documents").select("doc_id", X.stable_key("source", "lang", "doc_id").alias("chunk_id"))

from datetime import date
from decimal import Decimal as D

import pytest
from support import rows
from pyspark.sql import functions as F

from crownledger.operators import gold, joins, silver
from crownledger.schemas import FOREIGN_KEYS, TABLES, columns_of, schema_of


def table(spark, name, *records):
    """Rows of a declared table; columns that are left out are NULL."""
    schema = schema_of(name)
    return spark.createDataFrame([tuple(r.get(f) for f in schema.fieldNames()) for r in records], schema)


def test_schemas_cover_the_model():
    assert len(TABLES) == 20 and len(FOREIGN_KEYS) == 27
    for fk in FOREIGN_KEYS:
        assert fk.column in columns_of(fk.child) and fk.key in columns_of(fk.parent)
    assert dict(zip(columns_of("dental_offices"), schema_of("dental_offices")))["zip_code"].dataType.typeName() == "string"
    assert set(silver.TRANSFORMS) == set(TABLES)


def test_nullable_keys_stay_integers(spark):
    out = silver.office_insurance_network(
        table(spark, "office_insurance_network", {"association_id": 1, "network_status": "Out-of-Network"})
    )
    assert rows(out, "shared_network_id", "network_status") == [(0, "out-of-network")]
    assert dict(out.dtypes)["shared_network_id"] == "bigint"


def test_claims_flags_work_in_any_case_and_reasons_are_filled(spark):
    claims = table(
        spark,
        "claims_and_payments",
        {"claim_id": 1, "claim_status": "Denied", "amount_claimed": D("10.00"), "amount_paid": D("0.00")},
        {"claim_id": 2, "claim_status": "Clean-Paid", "amount_claimed": D("10.00"), "amount_paid": D("7.50")},
        {"claim_id": 3, "claim_status": "DENIED", "denial_reason_code": "Coding Error"},
    )
    out = silver.claims_and_payments(claims)
    assert rows(out, "claim_id", "is_denied", "denial_reason_code", "unpaid_amount") == [
        (1, True, "UNKNOWN", D("10.00")),
        (2, False, "N/A", D("2.50")),
        (3, True, "Coding Error", None),
    ]


def test_invoices_on_the_due_date_are_not_overdue(spark):
    as_of = date(2024, 3, 1)
    out = silver.invoices(
        table(
            spark,
            "invoices",
            {"invoice_id": 1, "due_date": as_of, "patient_balance": D("5.00")},
            {"invoice_id": 2, "due_date": date(2024, 2, 20), "patient_balance": D("5.00")},
            {"invoice_id": 3, "due_date": date(2024, 2, 20), "patient_balance": D("0.00")},
        ),
        as_of,
    )
    assert rows(out, "invoice_id", "is_overdue", "days_overdue", "has_patient_balance") == [
        (1, False, 0, True),
        (2, True, 10, True),
        (3, False, 0, False),
    ]


def test_benefit_years_with_zero_limits(spark):
    out = silver.patient_benefit_years(
        table(
            spark,
            "patient_benefit_years",
            {
                "patient_id": 1,
                "individual_deductible": D("0.00"),
                "deductible_met": D("0.00"),
                "annual_maximum": D("0.00"),
                "benefit_used": D("0.00"),
                "benefit_remaining": D("0.00"),
            },
        )
    )
    assert rows(out, "deductible_met_pct", "benefit_used_pct", "is_benefit_exhausted") == [(0.0, 0.0, True)]


def test_stamp_only_adds_the_load_time(spark):
    out = silver.stamp(spark.range(2))
    assert out.columns == ["id", "_silver_loaded_at"]


@pytest.fixture()
def small(spark):
    patients = table(
        spark, "patients", {"patient_id": 1, "age": 20, "gender": "F"}, {"patient_id": 2, "age": 70, "gender": "M"}
    )
    visits = table(
        spark,
        "appointments",
        *[{"appointment_id": i, "patient_id": 1, "appointment_status": s} for i, s in enumerate(["No-Show", "Completed"])],
    )
    bills = table(
        spark,
        "invoices",
        *[{"invoice_id": i, "patient_id": 1, "total_allowed_amount": D("10.00"), "patient_balance": D("1.00")} for i in range(3)],
    )
    claims = table(spark, "claims_and_payments", *[{"claim_id": i, "patient_id": 1, "claim_status": "Denied"} for i in range(3)])
    return (
        silver.patients(patients),
        silver.appointments(visits),
        silver.invoices(bills, date(2024, 1, 1)),
        silver.claims_and_payments(claims),
    )


def test_patient_summary_does_not_multiply_children(small):
    out = gold.gold_patient_summary(*small)
    assert rows(out, "patient_id", "no_show_count", "total_invoices", "total_spent", "denied_claims", "no_show_rate_pct") == [
        (1, 1, 3, D("30.00"), 3, 50.0),
        (2, 0, 0, D("0.00"), 0, 0.0),
    ]


def test_fanout_report_matches_a_real_join(small):
    patients, visits, bills, claims = small
    report = joins.fanout_report(
        {
            "visits": (visits, {"no_shows": F.count_if("is_no_show")}),
            "bills": (bills, {"allowed": F.sum("total_allowed_amount")}),
            "claims": (claims, {"denied": F.count_if("is_denied")}),
        },
        "patient_id",
        patients,
    )
    joined = (
        patients.join(visits.select("patient_id", "is_no_show"), "patient_id", "left")
        .join(bills.select("patient_id", "total_allowed_amount"), "patient_id", "left")
        .join(claims.select("patient_id", "is_denied"), "patient_id", "left")
    )
    real = joined.agg(F.count_if("is_no_show"), F.sum("total_allowed_amount"), F.count_if("is_denied")).first()
    assert rows(report) == [
        ("bills.allowed", 30.0, float(real[1])),
        ("claims.denied", 3.0, float(real[2])),
        ("visits.no_shows", 1.0, float(real[0])),
    ]


def test_payer_without_claims_has_zero_counts_but_null_sums(spark):
    payers = table(spark, "insurance_companies", {"insurance_company_id": 1, "company_name": "A"})
    claims = silver.claims_and_payments(table(spark, "claims_and_payments"))
    row = gold.gold_payer_performance(payers, claims).first()
    assert (row["total_claims"], row["actual_denial_rate_pct"], row["in_network_claims"]) == (0, 0.0, 0)
    assert row["total_claimed"] is None and row["avg_days_to_adjudicate"] is None


def test_all_pairs_is_the_whole_product(spark):
    left, right = spark.range(100).toDF("l"), spark.range(7).toDF("r")
    assert rows(joins.all_pairs(left, "l", right, "r")) == sorted(
        ((a, b) for a in range(100) for b in range(7)), key=repr
    )


def test_pairs_of_one_small_partition_are_made_by_many_tasks(spark):
    left, right = spark.range(0, 3200, 1, 1).selectExpr("id AS l", "-id AS x"), spark.range(0, 5, 1, 1).toDF("r")
    pairs = joins.all_pairs(left, "l", right, "r", ["x"]).withColumn("task", F.spark_partition_id())
    sizes = [n for _, n in rows(pairs.groupBy("task").count())]
    assert sum(sizes) == 16_000 and max(sizes) < 1_000
    assert pairs.filter("l = -x").select("l", "r").distinct().count() == 16_000


def test_set_compare_and_orphans(spark):
    a, b = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k long"), spark.createDataFrame([(2,), (3,)], "k long")
    assert rows(joins.set_compare(a, b, "k")) == [(1, 1, 1)]
    assert rows(joins.orphans(a, "k", b, "k")) == [(1, 1)]

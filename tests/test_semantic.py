from datetime import date
from decimal import Decimal as D

import pytest
from support import rows
from pyspark.sql import functions as F

from crownledger.operators import semantic as G


def test_synonyms_map_user_wording(spark):
    asked = [
        ("claim_status", "Denied", "denied"),
        ("claim_status", " REJECTED ", "denied"),
        ("network_status", "OON", "out-of-network"),
        ("payer_type", "PPO", "commercial ppo"),
        ("specialty_type", "peds", "pediatric dentistry"),
        ("dispute_outcome", "won", "overturned-paid"),
        ("dispute_outcome", "pending", None),
    ]
    df = spark.createDataFrame([(c, t) for c, t, _ in asked], "column_name string, term string")
    out = G.normalize(df, "column_name", "term", G.synonym_table(spark))
    assert rows(out, "column_name", "term", "canonical") == sorted(asked, key=repr)
    assert [r["matched"] for r in out.filter("term = 'pending'").collect()] == [False]


def test_revenue_means_collections(spark):
    money = "decimal(12,2)"
    tables = {
        "invoices": spark.createDataFrame([(D("10.00"),)], f"total_gross_amount {money}"),
        "claims_and_payments": spark.createDataFrame([(D("4.00"),), (D("3.00"),)], f"amount_paid {money}"),
    }
    assert rows(G.measures(tables, ["revenue", "production", "collections"])) == [
        ("collections", D("7.00")),
        ("production", D("10.00")),
        ("revenue", D("7.00")),
    ]


@pytest.fixture(scope="module")
def claims(spark):
    data = [
        (1, 1, date(2024, 8, 31), "2024-25", "denied", True, "Max Benefit Exceeded", D("10.00"), D("0.00")),
        (2, 1, date(2024, 9, 1), "2024-25", "clean-paid", False, "N/A", D("10.00"), D("10.00")),
        (3, 2, date(2025, 1, 5), "2024-25", "clean-paid", False, "N/A", D("30.00"), D("20.00")),
        (4, 3, date(2025, 9, 5), "2025-26", "denied", True, "Coding Error", D("5.00"), D("0.00")),
    ]
    return spark.createDataFrame(
        data,
        "claim_id long, insurance_company_id long, service_date date, benefit_year string, claim_status string, is_denied boolean, "
        "denial_reason_code string, amount_claimed decimal(12,2), amount_paid decimal(12,2)",
    )


def test_benefit_year_questions(claims):
    assert rows(G.q_claims_in_benefit_year(claims, "2024-25")) == [(2,)]
    assert rows(G.q_calendar_year_split(claims, 2025)) == [("2024-25", 1), ("2025-26", 1)]
    assert rows(G.benefit_year_drift(claims)) == [("2024-25", "2023-24", 1), ("2024-25", "2024-25", 2), ("2025-26", "2025-26", 1)]


def test_denials_use_the_flag(claims):
    assert rows(G.q_claims_by_reason(claims, "Max Benefit Exceeded"), "claim_id") == [(1,)]


def test_payers_with_equal_names_stay_apart(spark, claims):
    payers = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B")], "insurance_company_id long, company_name string")
    assert rows(G.q_denial_rate_by_payer(claims, payers), "insurance_company_id", "denial_rate_pct") == [(1, 50.0), (2, 0.0), (3, 100.0)]


def test_receivables(spark):
    invoices = spark.createDataFrame(
        [(1, date(2024, 1, 1), D("5.00")), (1, date(2024, 4, 1), D("7.00")), (2, date(2023, 1, 1), D("9.00")), (2, date(2023, 1, 1), D("0.00"))],
        "office_id long, due_date date, patient_balance decimal(12,2)",
    )
    offices = spark.createDataFrame([(1, "A"), (2, "B")], "office_id long, office_name string")
    as_of = date(2024, 4, 1)
    assert rows(G.q_ar_over_90(invoices, offices, as_of, 1), "office_id", "balance_over_90d", "invoices") == [(2, D("9.00"), 1)]
    assert rows(G.ar_aging(invoices, as_of)) == [("90+", D("14.00"), 2)]


def test_metric_view_joins_only_what_it_needs(spark, claims):
    payers = spark.createDataFrame([(1, "A", "ppo"), (2, "B", "ppo")], "insurance_company_id long, company_name string, payer_type string")
    view = G.MetricView(
        source="claims",
        joins={"payer": ("payers", "insurance_company_id"), "office": ("missing_table", "office_id")},
        dimensions={"payer_type": "payer.payer_type", "status": "source.claim_status", "office": "office.name"},
        measures={"unpaid": "amount_claimed - amount_paid", "n": "1"},
    )
    out = view.query({"claims": claims, "payers": payers}, ["payer_type", "status"], ["unpaid", "n"])
    assert rows(out) == [
        ("ppo", "clean-paid", D("10.00"), 2),
        ("ppo", "denied", D("10.00"), 1),
        (None, "denied", D("5.00"), 1),
    ]
    assert rows(view.query({"claims": claims}, [], ["n"], F.col("is_denied"))) == [(2,)]


def test_per_entity_divides_totals(spark):
    amount = spark.createDataFrame([(D("10.00"),)], "x decimal(12,2)")
    assert rows(G.per_entity(amount, spark.range(4), F.sum("x"), "r")) == [(2.5,)]


QUESTIONS = [
    ("What is our denial rate by insurance company?", "data"),
    ("How many claims did we submit in the 2024-25 benefit year?", "data"),
    ("What does a denial code mean?", "document"),
    ("What is the difference between an HMO and a PPO dental plan?", "document"),
    ("What does the outstanding balance mean?", "ambiguous"),
    ("Predict who will no-show next month", "decline"),
    ("Hello there", "ambiguous"),
]


def test_routes(spark):
    df = spark.createDataFrame([(i, q) for i, (q, _) in enumerate(QUESTIONS)], "q long, text string")
    routes = G.route(df, ["q"])
    assert rows(routes) == [(i, r) for i, (_, r) in enumerate(QUESTIONS)]
    hits = spark.createDataFrame([(6, True), (0, True)], "q long, answerable boolean")
    assert dict(rows(G.route(df, ["q"], hits=hits)))[6] == "document"
    gold = spark.createDataFrame([(i, r) for i, (_, r) in enumerate(QUESTIONS)], "q long, route string")
    assert all(e == g for e, g, _ in rows(G.route_eval(routes, gold, ["q"])))

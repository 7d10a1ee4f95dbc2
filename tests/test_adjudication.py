from datetime import date
from decimal import Decimal as D

from support import rows
from pyspark.sql import functions as F

from crownledger.operators import adjudication as B
from crownledger.operators import aggregates as A
from crownledger.operators import joins as J


def test_network_status_covers_every_pair(spark):
    offices, companies = spark.createDataFrame([(1,), (2,)], "office_id long"), spark.createDataFrame([(7,), (8,)], "insurance_company_id long")
    o = spark.createDataFrame([(1, 3), (1, 2)], "office_id long, network_id long")
    c = spark.createDataFrame([(7, 2), (7, 3), (8, 1)], "insurance_company_id long, network_id long")
    out = B.network_status(offices, companies, o, c)
    assert rows(out, "office_id", "insurance_company_id", "shared_network_id", "network_status") == [
        (1, 7, 2, "In-Network"),
        (1, 8, None, "Out-of-Network"),
        (2, 7, None, "Out-of-Network"),
        (2, 8, None, "Out-of-Network"),
    ]


def codes(spark):
    return spark.createDataFrame(
        [(1, "Preventive", D("100.00"), D("65.00"), D("90.00"), False), (2, "major", D("200.00"), D("120.00"), D("180.00"), True)],
        "billing_code_id long, procedure_category string, standard_fee decimal(12,2), in_network_allowed_amount decimal(12,2), "
        "out_network_allowed_amount decimal(12,2), requires_prior_auth boolean",
    )


def test_allowed_and_writeoff_depend_on_the_network(spark):
    lines = spark.createDataFrame([(1, 1, "In-Network"), (2, 1, "out-of-network")], "line_id long, billing_code_id long, network_status string")
    out = B.writeoff(B.allowed(lines, codes(spark)))
    assert rows(out, "line_id", "allowed_amount", "contractual_writeoff") == [
        (1, D("65.00"), D("35.00")),
        (2, D("90.00"), D("0.00")),
    ]


def test_coverage_matrix_and_rules_for_pairs_agree(spark):
    policies = spark.createDataFrame([(10,), (11,)], "policy_id long")
    plan = B.plan_design(spark)
    matrix = B.coverage_matrix(policies, codes(spark), plan)
    assert rows(matrix, "rule_key", "copay_flat_amount", "coinsurance_percentage", "deductible_applies", "frequency_limit_per_year") == [
        ("10-1", D("0.00"), 1.0, False, 2),
        ("10-2", D("50.00"), 0.5, True, None),
        ("11-1", D("0.00"), 1.0, False, 2),
        ("11-2", D("50.00"), 0.5, True, None),
    ]
    pairs = spark.createDataFrame([(11, 2)], "policy_id long, billing_code_id long")
    assert rows(B.rules_for(pairs, codes(spark), plan)) == rows(matrix.filter("rule_key = '11-2'"))


def test_tier_needs_more_than_one_dependent(spark):
    holders = spark.createDataFrame([(1,), (2,), (3,)], "subscriber_id long")
    dependents = spark.createDataFrame([(1,), (2,), (2,)], "subscriber_id long")
    assert rows(B.coverage_tier(holders, dependents), "subscriber_id", "tier") == [
        (1, "Employee + One"),
        (2, "Employee + Family"),
        (3, "Employee + One"),
    ]


def test_denial_rules(spark):
    claims = spark.createDataFrame(
        [
            (1, 9, True, True, True, "in-network", None),
            (2, 9, True, False, True, "in-network", "Coding Error"),
            (3, 9, True, False, False, "out-of-network", "Coding Error"),
            (4, 9, False, True, True, "in-network", "N/A"),
        ],
        "claim_id long, insurance_company_id long, is_denied boolean, is_exhausted boolean, needs_auth boolean, "
        "network_status string, denial_reason_code string",
    )
    assert rows(B.denial_reason(claims), "claim_id", "reason") == [
        (1, "Max Benefit Exceeded"),
        (2, "Prior Auth Required"),
        (3, "Coding Error"),
        (4, None),
    ]
    payers = spark.createDataFrame([(9, 0.4)], "insurance_company_id long, denial_rate_baseline double")
    assert rows(B.denial_risk(claims, payers), "claim_id", "risk") == [(1, 0.85), (2, 0.65), (3, 0.45), (4, 0.85)]


def test_dispute_rules(spark):
    disputes = spark.createDataFrame(
        [(1, "Prior Auth Required", "Overturned-Paid"), (2, "Max Benefit Exceeded", "upheld-denied"), (3, None, "x")],
        "claim_id long, denial_reason_code string, dispute_outcome string",
    )
    assert rows(B.dispute_reason(disputes), "claim_id", "category") == [
        (1, "Medical Necessity"),
        (2, "Benefit Limit"),
        (3, "Administrative Error"),
    ]
    claims = spark.createDataFrame([(i, D("12.50")) for i in (1, 2, 3)], "claim_id long, amount_claimed decimal(12,2)")
    assert rows(B.recovered(disputes, claims), "claim_id", "amount_recovered") == [(1, D("12.50")), (2, D("0.00")), (3, D("0.00"))]


def test_roll_up_and_auth(spark):
    lines = spark.createDataFrame(
        [(1, 1, D("10.00"), D("8.00"), D("2.00"), D("5.00"), D("3.00")), (1, 2, D("20.00"), D("20.00"), D("0.00"), D("10.00"), D("10.00"))],
        "invoice_id long, billing_code_id long, unit_price decimal(12,2), allowed_amount decimal(12,2), contractual_writeoff decimal(12,2), "
        "estimated_insurance_amount decimal(12,2), estimated_patient_amount decimal(12,2)",
    )
    visits = spark.createDataFrame([(1, date(2024, 1, 31), D("4.00"))], "invoice_id long, service_date date, actual_patient_paid_at_visit decimal(12,2)")
    row = B.roll_up(lines, visits).first()
    assert (row["total_gross_amount"], row["patient_balance"], row["due_date"]) == (D("30.00"), D("9.00"), date(2024, 3, 1))
    assert rows(B.needs_auth(lines, codes(spark))) == [(1, True)]


def test_recall_counts_once_however_many_visits(spark):
    recalls = spark.createDataFrame([(1, "sms"), (2, "sms"), (3, "email")], "recall_id long, communication_channel string")
    visits = spark.createDataFrame([(1,), (1,), (0,)], "source_recall_id long")
    assert rows(B.recall_funnel(recalls, visits)) == [("email", 1, 0, 0.0), ("sms", 2, 1, 50.0)]


def test_dependents_inherit_the_policy(spark):
    holders = spark.createDataFrame([(1, 100, 7)], "subscriber_id long, patient_id long, policy_id long")
    dependents = spark.createDataFrame([(1, 101)], "subscriber_id long, patient_id long")
    assert rows(J.patient_policy(holders, dependents)) == [(100, 7), (101, 7)]


def test_statistics(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "a"), (None, "b")], "k long, v string")
    assert rows(A.distinct_stats(df, "k")) == [(4, 2, 2)]
    assert rows(A.value_counts(df, "v")) == [("v", "a", 2), ("v", "b", 1), ("v", None, 1)]
    assert rows(A.member_sets(df.dropna(), "k", "v")) == [(1, ["a"]), (2, ["a"])]
    a, b = spark.createDataFrame([(1,), (2,)], "x long"), spark.createDataFrame([(2,), (3,)], "x long")
    assert rows(A.set_diff(a, b, "x")) == [(1, "missing"), (3, "extra")]
    assert rows(A.top_n(df.dropna(), "k", ["v"], 1)) == [(2, "a")]
    assert rows(A.bounds(df, F.col("v"), "by", "k")) == [("a", 2, 1, 2), ("b", 1, None, None), (None, 1, 1, 1)]


def test_lines_are_read_once_for_both_levels_of_a_running_total(lake):
    scans = lambda df: sum("FileScan" in x and "l_orderkey#" in x for x in df._jdf.queryExecution().executedPlan().toString().splitlines())
    lines = lake.adjudication_lines()
    assert scans(lines) == 1  # the invoices' sums are not needed
    assert scans(B.deductible_applied(lines)) == 0  # they were written out

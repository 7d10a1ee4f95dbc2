import math
import random
from decimal import Decimal as D

from support import rows
from pyspark.sql import functions as F

from crownledger.operators import adjudication as B
from crownledger.operators import ordered as O


def make_lines(seed, patients, lines, hot_share=0.34):
    """Lines in shuffled order; one patient-year holds a third of them, many on the same day."""
    rng = random.Random(seed)
    out = []
    for i in range(lines):
        hot = rng.random() < hot_share
        out.append(
            {
                "patient_id": 0 if hot else rng.randrange(1, patients),
                "benefit_year": "2023-24" if hot else rng.choice(["2023-24", "2024-25"]),
                "service_date": f"2024-01-{rng.randrange(1, 6):02d}",
                "invoice_id": rng.randrange(20),
                "line_id": i,
                "allowed_amount": D(rng.randrange(0, 30000)) / 100,
                "deductible_applies": rng.random() < 0.7,
                "copay_flat_amount": D(rng.choice(["0.00", "20.00", "50.00"])),
                "coinsurance_percentage": rng.choice([1.0, 0.8, 0.5]),
            }
        )
    rng.shuffle(out)
    return out


SCHEMA = (
    "patient_id long, benefit_year string, service_date string, invoice_id long, line_id long, "
    "allowed_amount decimal(12,2), deductible_applies boolean, copay_flat_amount decimal(12,2), "
    "coinsurance_percentage double"
)


def sequential(lines, deductible, maximum):
    """The rule line by line, as a front desk would apply it."""
    met, used, out = {}, {}, {}
    for r in sorted(lines, key=lambda r: (r["service_date"], r["invoice_id"], r["line_id"])):
        key = (r["patient_id"], r["benefit_year"])
        applied = D("0.00")
        if r["deductible_applies"] and met.get(key, 0) < deductible:
            applied = min(deductible - met.get(key, D(0)), r["allowed_amount"])
            met[key] = met.get(key, D(0)) + applied
        base = max(r["allowed_amount"] - applied - r["copay_flat_amount"], D(0))
        est = (base * D(str(r["coinsurance_percentage"]))).quantize(D("0.01"), "ROUND_HALF_UP")
        est = min(est, max(maximum - used.get(key, D(0)), D(0)))
        used[key] = used.get(key, D(0)) + est
        out[r["line_id"]] = (applied, est)
    return out, met, used


def test_accumulators_equal_the_sequential_rule(spark):
    for seed, deductible, maximum in [(1, D("150.00"), D("1000.00")), (2, D("0.00"), D("0.00")), (3, D("50.00"), D("99999.00"))]:
        lines = make_lines(seed, 12, 400)
        df = (
            spark.createDataFrame([tuple(r.values()) for r in lines], SCHEMA)
            .withColumn("service_date", F.col("service_date").cast("date"))
            .withColumn("individual_deductible", F.lit(deductible).cast("decimal(12,2)"))
            .withColumn("annual_maximum", F.lit(maximum).cast("decimal(12,2)"))
            .withColumn("policy_id", F.lit(1))
        )
        want, met, used = sequential(lines, deductible, maximum)
        got = {r["line_id"]: (r["deductible_applied"], r["est_insurance"]) for r in B.insurance_estimate(df).collect()}
        assert got == want
        years = {
            (r["patient_id"], r["benefit_year"]): (r["deductible_met"], r["benefit_used"], r["benefit_remaining"])
            for r in B.benefit_years(df).collect()
        }
        for key, (d, u, rest) in years.items():
            assert (d, u, rest) == (met.get(key, D(0)), used[key], max(maximum - used[key], D(0)))


def test_running_total_with_null_groups_and_a_hot_group(spark):
    data = [(None if i % 3 == 0 else i % 2, i % 5, i, i * 7 % 11) for i in range(300)]
    df = spark.createDataFrame(data, "g long, b long, o long, v long")
    got = {r["o"]: (r["run"], r["all"]) for r in O.running_total(df, ["g"], ["b"], ["o"], F.col("v"), "run", "all").collect()}
    want, totals = {}, {}
    for g, b, o, v in sorted(data, key=lambda r: (r[1], r[2])):
        totals[g] = totals.get(g, 0) + v
        want[o] = totals[g]
    assert got == {o: (want[o], totals[g]) for g, _, o, _ in data}


def test_sequence_numbers_from_the_furthest_lead(spark):
    df = spark.createDataFrame([(1, 10, 2), (1, 11, 14), (1, 12, 7), (2, 13, 1)], "a long, id long, lead int")
    assert rows(O.sequence(df, ["a"], "lead", "id"), "id", "seq", "is_last") == [
        (10, 3, True),
        (11, 1, False),
        (12, 2, False),
        (13, 1, True),
    ]


def test_first_in_flags_exactly_one_row_per_group(spark):
    df = spark.createDataFrame([(1, 5, 1), (1, 3, 2), (1, 3, 3), (None, 9, 4)], "g long, t long, id long")
    assert rows(O.first_in(df, ["g"], ["t", "id"]), "id", "is_first") == [(1, False), (2, True), (3, False), (4, True)]


def test_topk_keeps_ties_by_key(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (1, "c", 2.0), (2, "d", 0.1)], "q long, k string, s double")
    assert rows(O.topk(df, ["q"], "s", ["k"], 2), "q", "k", "rk") == [(1, "b", 1), (1, "c", 2), (2, "d", 1)]


def test_concentration_equals_a_full_ranking(spark):
    rng = random.Random(5)
    data = [(rng.randrange(40), rng.random() < 0.2) for _ in range(500)]
    df = spark.createDataFrame(data, "p long, no_show boolean")
    counts = {}
    for p, f in data:
        counts[p] = counts.get(p, 0) + f
    ranked = sorted(counts.values(), reverse=True)
    for share, entities, events, ratio in rows(O.concentration(df, "p", "no_show", [0.1, 0.18, 0.5, 1.0])):
        top = math.ceil(share * len(ranked))
        assert (entities, events) == (top, sum(ranked[:top]))
        assert ratio == round(sum(ranked[:top]) / sum(ranked), 4)


def test_seasonality_ranks_months(spark):
    df = spark.createDataFrame([("2024-12-01",), ("2023-12-05",), ("2024-02-01",)], "d string")
    assert rows(O.seasonality(df.select(F.col("d").cast("date").alias("d")), "d")) == [(12, 2, 1), (2, 1, 2)]


def test_rows_are_shuffled_once(spark):
    """The lines move once, to their group and block; the join with the block offsets moves only blocks."""
    df = spark.range(100).select((F.col("id") % 3).alias("g"), (F.col("id") % 7).alias("b"), F.col("id").alias("o"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = O.running_total(df, ["g"], ["b"], ["o"], F.col("o"), "run")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = plan[plan.index("SortMergeJoin") :]
    assert join.index("Window") < join.index("Exchange")
    assert plan.count("Exchange hashpartitioning") == 4

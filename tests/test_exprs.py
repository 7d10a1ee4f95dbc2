from datetime import date

from support import rows
from pyspark.sql import functions as F

from crownledger.functions import exprs as X


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def lit(day):
    return F.lit(day).cast("date")


def test_benefit_year_changes_on_the_first_of_september(spark):
    want = {"2023-08-31": "2022-23", "2023-09-01": "2023-24", "1999-12-01": "1999-00", "2000-01-01": "1999-00"}
    for day, label in want.items():
        assert one(spark, X.benefit_year(lit(day))) == label
    assert one(spark, X.benefit_year(lit("2024-06-30"), 7)) == "2023-24"
    assert one(spark, X.benefit_year(F.lit(None).cast("date"))) is None


def test_age_bands_and_the_unknown_age(spark):
    ages = [17, 18, 30, 31, 50, 51, 65, 66, None]
    got = [one(spark, X.age_group(F.lit(a).cast("int"))) for a in ages]
    assert got == [
        "child", "young_adult", "young_adult", "adult", "adult", "middle_aged", "middle_aged", "senior", "senior",
    ]


def test_gender_words(spark):
    assert [one(spark, X.gender_word(F.lit(g))) for g in ["M", "F", "O", "X"]] == ["male", "female", "other", "x"]


def test_guarded_percentage_never_divides_by_zero(spark):
    assert one(spark, X.guarded_pct(F.lit(5), F.lit(0))) == 0.0
    assert one(spark, X.guarded_pct(F.lit(1), F.lit(3))) == 33.33


def test_rate_is_rounded_once_and_null_on_no_rows(spark):
    flags = spark.createDataFrame([(True,), (False,), (None,)], "f boolean")
    assert flags.agg(X.rate_pct("f").alias("r")).first()["r"] == 33.33
    assert flags.limit(0).agg(X.rate_pct("f").alias("r")).first()["r"] is None


def test_overdue_needs_a_later_day_and_a_balance(spark):
    as_of = date(2024, 1, 31)
    cases = [("2024-01-31", 10, False), ("2024-01-30", 10, True), ("2024-01-30", 0, False)]
    for due, balance, want in cases:
        assert one(spark, X.is_overdue(lit(due), F.lit(balance), as_of)) is want


def test_weekend_moves_to_monday(spark):
    days = ["2024-08-30", "2024-08-31", "2024-09-01", "2024-09-02"]
    got = [str(one(spark, X.to_weekday(lit(d)))) for d in days]
    assert got == ["2024-08-30", "2024-09-02", "2024-09-02", "2024-09-02"]


def test_stable_key_snippet_and_base_name(spark):
    import hashlib

    assert one(spark, X.stable_key(F.lit("a"), F.lit(1))) == hashlib.sha256(b"a::1").hexdigest()
    assert one(spark, X.snippet(F.lit(" a \n\n b " + "c" * 300))) == "a b " + "c" * 196
    assert one(spark, X.base_name(F.lit("/x/y z (1).pdf"))) == "y z (1).pdf"


def test_bands(spark):
    assert [one(spark, X.utilization_band(F.lit(p))) for p in [0, 25, 50, 75, 100]] == [
        "0-25%", "25-50%", "50-75%", "75-100%", "100%+",
    ]
    assert [one(spark, X.aging_band(F.lit(d))) for d in [30, 31, 60, 61, 90, 91]] == [
        "0-30", "31-60", "31-60", "61-90", "61-90", "90+",
    ]


def test_edge_types(spark):
    df = spark.createDataFrame([(1, "1.25")], "i int, m string").withColumn("m", X.money("m"))
    assert [t for _, t in X.edge(df).dtypes] == ["bigint", "double"]
    assert rows(X.edge(df)) == [(1, 1.25)]

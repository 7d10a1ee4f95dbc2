"""The rules measured together equal each rule measured alone, and tables are read once."""

import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from support import rows

from crownledger.operators import quality as Q
from crownledger.operators import rulebook as B
from crownledger.schemas import ForeignKey

FIELDS = "k long, g long, year string, flag boolean, x decimal(12,2), y decimal(12,2)"


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(1)

    def some(n):
        pick = lambda *v: rng.choice(v)
        return [(pick(None, *range(12)), rng.randrange(4), pick(None, "a", "b"), pick(True, False, None), D(rng.randrange(300)) / 100, pick(None, D(rng.randrange(300)) / 100)) for _ in range(n)]

    made = {name: spark.createDataFrame(some(n), FIELDS) for name, n in (("one", 60), ("two", 25), ("three", 3))}
    made["none"] = spark.createDataFrame([], FIELDS)
    made["heads"] = spark.createDataFrame([(i, 0, None, None, D(i), D(i)) for i in range(15)], FIELDS)
    return made


def verdicts(df):
    return {r["rule"]: (r["checked"], r["violations"], r["passed"]) for r in df.collect()}


def alone(t, name):
    c = F.col
    fk = ForeignKey("one", "k", "two", "k")
    return {
        "fk": lambda: (B.no_orphans(fk), Q.fk_rules(t, [fk])),
        "sizes": lambda: (B.sizes("one", ["k", "year"], 1, 2, "sizes"), Q.cardinality(t["one"], ["k", "year"], 1, 2, "sizes")),
        "where": lambda: (B.sizes("one", ["g"], 3, 9, "where", c("flag")), Q.cardinality(t["one"].filter("flag"), ["g"], 3, 9, "where")),
        "children": lambda: (B.children("heads", "one", "k", 2, 5, "children"), Q.per_parent(t["heads"], t["one"], "k", 2, 5, "children")),
        "single": lambda: (B.single("one", "k", "single"), Q.one_to_one(t["one"], "k", "single")),
        "text": lambda: (B.single("one", "year", "text"), Q.one_to_one(t["one"], "year", "text")),
        "same": lambda: (B.same_keys("one", "two", "k", "same", c("flag")), Q.same_set(t["one"], t["two"].filter("flag"), "k", "same")),
        "subset": lambda: (B.subset("one", "two", "k", c("flag"), "subset"), Q.conditional_subset(t["one"], t["two"], "k", c("flag"), "subset")),
        "covers": lambda: (B.covers("one", "two", "k", "covers"), Q.coverage(t["one"], t["two"], "k", "covers")),
        "identity": lambda: (B.identity("one", c("x"), c("y"), "identity"), Q.identity(t["one"], c("x"), c("y"), "identity")),
        "bound": lambda: (B.on_rows("one", F.lit(True), c("x") > c("y"), "bound"), Q.upper_bound(t["one"], "x", "y", "bound")),
        "ratio": lambda: (B.ratio("one", "x", "y", "0.5", "0.9", "ratio"), Q.ratio_in(t["one"], "x", "y", "0.5", "0.9", "ratio")),
        "present": lambda: (B.present("one", c("flag").isNull(), "present"), Q.has_null(t["one"], "flag", "present")),
        "absent": lambda: (B.present("heads", c("k").isNull(), "absent"), Q.has_null(t["heads"], "k", "absent")),
        "product": lambda: (B.product("one", "two", "three", "product"), Q.cross_product(t["one"], t["two"], t["three"], "product")),
        "header": lambda: (B.header_total("heads", "one", "k", "x", "y"), Q.header_vs_lines(t["heads"], t["one"].withColumnRenamed("y", "yy").filter("yy is not null"), "k", {"x": "yy"})),
    }[name]()


NAMES = "fk sizes where children single text same subset covers identity bound ratio present absent product header".split()


def test_all_rules_together_equal_each_alone(tables):
    pairs = [alone(tables, name) for name in NAMES]
    asked = []
    got = verdicts(B.measure(lambda name: asked.append(name) or tables[name], [rule for rule, _ in pairs]))
    for name, (rule, plain) in zip(NAMES, pairs, strict=True):
        assert got[rule.name] == next(iter(verdicts(plain).values())), name
    assert sorted(asked) == sorted(set(asked))  # every table is read once


def test_counts_of_two_tables(tables):
    rule = B.equal_counts("one", F.col("flag"), "two", F.col("flag"), "equal")
    flags = {n: sum(r["flag"] is True for r in tables[n].collect()) for n in ("one", "two")}
    assert verdicts(B.measure(tables.get, [rule]))["equal"] == (flags["two"], abs(flags["one"] - flags["two"]), flags["one"] == flags["two"])


def test_empty_tables_give_a_row_each(tables):
    made = [B.sizes("none", ["k"], 1, 1, "s"), B.no_orphans(ForeignKey("none", "k", "none", "k")), B.present("none", F.col("flag"), "p")]
    assert rows(B.measure(tables.get, made)) == [("none.k -> none.k", 0, 0, True), ("p", 0, 1, False), ("s", 0, 0, True)]


def test_a_plan_scans_each_table_once(spark, tmp_path, tables):
    for name in ("one", "two"):
        tables[name].write.parquet(f"{tmp_path}/{name}")
    made = [B.sizes("one", ["k"], 1, i, f"s{i}") for i in range(2, 9)] + [B.children("two", "one", "g", 0, i, f"c{i}") for i in range(5)]
    out = B.measure(lambda name: spark.read.parquet(f"{tmp_path}/{name}"), made)
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2


def test_three_keys_are_refused(tables):
    with pytest.raises(ValueError, match="at most"):
        B.measure(tables.get, [B.sizes("one", ["k", "g", "year"], 1, 1, "x")])

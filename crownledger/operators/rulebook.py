"""Many data-quality rules in one pass: every table is scanned once, whatever the number of rules that look at it.

A rule says what a row of each of its tables adds: a key, if it is a rule on keys, and counts. All rows of all tables become such
tagged additions, they are summed per rule and key, partially in the tasks that read them, and then per rule. Two
relations are therefore compared without a join, and a key with very many rows is one row per task. Rules on single rows have no key:
a task sums them to one row each.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crownledger.functions import exprs as X
from crownledger.schemas import ForeignKey

#: How the sums of a rule are read; the first group per key, the second once for the rule.
ORPHANS, SIZES, SINGLE, SAME, SUBSET, COVERS, MONEY = range(7)
ROWS, PRESENT, EQUAL, PRODUCT = range(7, 11)
AMOUNT = "decimal(18,2)"


@dataclass(frozen=True)
class Part:
    """What the rows of one table add: counts ``a``, ``b``, ``c`` and an amount on either side of a comparison."""

    table: str
    keys: tuple[str, ...] = ()
    a: Column | None = None
    b: Column | None = None
    c: Column | None = None
    amount: Column | None = None
    where: Column | None = None


@dataclass(frozen=True)
class Rule:
    name: str
    kind: int
    parts: tuple[Part, ...]
    low: int = 0
    high: int = 0


def one() -> Column:
    return F.lit(1).cast("bigint")


def no_orphans(fk: ForeignKey) -> Rule:
    """Every child key has a parent; null keys are ignored. Checked are child rows."""
    return Rule(fk.rule, ORPHANS, (Part(fk.child, (fk.column,), a=one(), where=F.col(fk.column).isNotNull()), Part(fk.parent, (fk.key,), b=one(), where=F.col(fk.key).isNotNull())))


def sizes(table: str, keys: Sequence[str], low: int, high: int, name: str, where: Column | None = None) -> Rule:
    """Rows per key that occurs lie between the bounds. Checked are keys; null is one."""
    return Rule(name, SIZES, (Part(table, tuple(keys), a=one(), b=one(), where=where),), low, high)


def children(parent: str, child: str, key: str, low: int, high: int, name: str) -> Rule:
    """Every parent key has so many children, none counting as zero."""
    return Rule(name, SIZES, (Part(child, (key,), a=one()), Part(parent, (key,), b=one())), low, high)


def single(table: str, key: str, name: str) -> Rule:
    """No two rows share a key: rows beyond one per key are violations. Checked are rows."""
    return Rule(name, SINGLE, (Part(table, (key,), a=one()),))


def same_keys(left: str, right: str, key: str, name: str, where: Column | None = None, kind: int = SAME) -> Rule:
    """Both tables, the second where the condition holds, have the same keys; nulls are ignored."""
    known = F.col(key).isNotNull()
    return Rule(name, kind, (Part(left, (key,), a=one(), where=known), Part(right, (key,), b=one(), where=known if where is None else known & where)))


def subset(child: str, parent: str, key: str, where: Column, name: str) -> Rule:
    """Child keys occur once and only for parents where the condition holds."""
    return same_keys(child, parent, key, name, where, SUBSET)


def covers(index: str, source: str, key: str, name: str) -> Rule:
    """The index has exactly the source's keys. Checked are the source's keys."""
    return same_keys(index, source, key, name, kind=COVERS)


def header_total(header: str, lines: str, key: str, total: str, line: str) -> Rule:
    """A header's amount is the sum of its lines; headers without lines and lines without header are left out."""
    known = F.col(line).isNotNull()
    return Rule(f"{total} = sum of {line}", MONEY, (Part(header, (key,), a=one(), amount=F.col(total)), Part(lines, (key,), b=one(), amount=-F.col(line), where=known)))


def on_rows(table: str, checked: Column, violated: Column, name: str, where: Column | None = None) -> Rule:
    """Single rows: how many are checked and how many violate; a null condition is no violation."""
    count = lambda flag: F.coalesce(flag.cast("bigint"), F.lit(0).cast("bigint"))
    return Rule(name, ROWS, (Part(table, a=count(checked), b=count(violated), where=where),))


def identity(table: str, left: Column, right: Column, name: str, where: Column | None = None, tolerance: str = "0.02") -> Rule:
    """Two amounts agree within the tolerance on every row where both are known."""
    return on_rows(table, (left - right).isNotNull(), ~X.within(left, right, tolerance), name, where)


def ratio(table: str, num: str, den: str, low: str, high: str, name: str) -> Rule:
    """num / den lies in the bounds; compared as products, which is exact in DECIMAL."""
    bounds = [F.col(den) * F.lit(x).cast("decimal(6,4)") for x in (low, high)]
    return on_rows(table, F.lit(True), ~F.col(num).between(*bounds), name)


def present(table: str, condition: Column, name: str) -> Rule:
    """The condition holds for some row; if it never does, that is one violation."""
    return Rule(name, PRESENT, (Part(table, a=one(), b=condition.cast("bigint")),))


def equal_counts(left: str, first: Column, right: str, second: Column, name: str) -> Rule:
    """As many rows of one table meet their condition as of the other. Checked are the other's."""
    return Rule(name, EQUAL, (Part(left, a=first.cast("bigint")), Part(right, b=second.cast("bigint"))))


def product(table: str, left: str, right: str, name: str) -> Rule:
    """A table has as many rows as the product of two others."""
    return Rule(name, PRODUCT, (Part(table, a=one()), Part(left, b=one()), Part(right, c=one())))


def additions(df: DataFrame, parts: Sequence[tuple[int, Part]]) -> DataFrame:
    """Rows (no, k, s, a, b, c, amount): what one scan of a table adds to its rules. Keys are a number and a text."""
    kinds = dict(df.dtypes)
    zero = F.lit(0).cast("bigint")

    def cell(no: int, part: Part) -> Column:
        number, text = F.lit(None).cast("bigint"), F.lit(None).cast("string")
        for i, key in enumerate(part.keys):
            if i == 0 and kinds[key] in ("bigint", "int", "smallint", "tinyint"):
                number = F.col(key).cast("bigint")
            elif i == len(part.keys) - 1 and i < 2:
                text = F.col(key).cast("string")
            else:
                raise ValueError("a key has a number and a text at most")
        counts = [F.coalesce(x, zero).alias(n) if x is not None else zero.alias(n) for n, x in (("a", part.a), ("b", part.b), ("c", part.c))]
        amount = (F.lit(None) if part.amount is None else part.amount).cast(AMOUNT).alias("amount")
        made = F.struct(F.lit(no).alias("no"), number.alias("k"), text.alias("s"), *counts, amount)
        return made if part.where is None else F.when(part.where, made)

    # a cell whose condition does not hold is a row of nulls
    return df.select(F.inline(F.array(*[cell(no, part) for no, part in parts]))).filter("no is not null")


def measure(tables: Callable[[str], DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """Rows (rule, checked, violations, passed), one per rule; ``tables`` gives each table, and is asked once per table."""
    by_table: dict[str, list[tuple[int, Part]]] = {}
    for no, rule in enumerate(rules, start=1):
        for part in rule.parts:
            by_table.setdefault(part.table, []).append((no, part))
    added = reduce(DataFrame.unionByName, [additions(tables(name), parts) for name, parts in by_table.items()])
    sums = [F.sum(c).alias(c) for c in ("a", "b", "c")]
    per_key = added.groupBy("no", "k", "s").agg(*sums, F.sum("amount").alias("amount"))
    of = lambda field: F.element_at(F.array(*[F.lit(getattr(r, field)) for r in rules]), F.col("no"))
    kind, a, b = F.col("kind"), F.col("a"), F.col("b")
    named = (F.col("k").isNotNull() | F.col("s").isNotNull()).cast("bigint")
    amiss = ((a == 0) | (b == 0)).cast("bigint")
    # of each key: whether, or with how many rows, it is checked, and how much is amiss
    checked = (
        F.when(kind.isin(ORPHANS, SINGLE), a).when(kind == SAME, 1).when(kind == SUBSET, (a > 0).cast("bigint"))
        .when(kind.isin(SIZES, COVERS), (b > 0).cast("bigint")).when(kind == MONEY, ((a > 0) & (b > 0)).cast("bigint")).otherwise(a)
    )
    outside = ~a.between(F.col("low"), F.col("high"))
    wrong = (
        F.when(kind == ORPHANS, F.when(b == 0, a).otherwise(0)).when(kind == SINGLE, a - named).when(kind.isin(SAME, COVERS), amiss)
        .when(kind == SUBSET, ((a > 0) & ((a > 1) | (b == 0))).cast("bigint")).when(kind == SIZES, ((b > 0) & outside).cast("bigint"))
        .when(kind == MONEY, ((a > 0) & (b > 0) & (F.abs("amount") > F.lit("0.02").cast(AMOUNT))).cast("bigint")).otherwise(b)
    )
    keyed = per_key.withColumns({"kind": of("kind"), "low": of("low"), "high": of("high")})
    # a rule whose tables are all empty is a row, too
    every = added.sparkSession.range(1, len(rules) + 1).select(F.col("id").cast("int").alias("no"), *[F.lit(0).cast("bigint").alias(c) for c in ("a", "b", "c")])
    counted = keyed.select("no", checked.alias("a"), wrong.alias("b"), "c").unionByName(every)
    per_rule = counted.groupBy("no").agg(*sums).withColumn("kind", of("kind"))
    violations = (
        F.when(kind == PRESENT, F.when(b > 0, 0).otherwise(1)).when(kind == EQUAL, F.abs(a - b)).when(kind == PRODUCT, F.abs(a - b * F.col("c"))).otherwise(b)
    )
    out = per_rule.select(of("name").alias("rule"), F.when(kind == EQUAL, b).otherwise(a).cast("bigint").alias("checked"), violations.cast("bigint").alias("violations"))
    return out.withColumn("passed", F.col("violations") == 0)

"""Ordered computation: running totals, numbering, firsts and rankings that survive a hot group.

A group may hold a large share of all rows, so nothing here sorts a whole group in one task. Running
totals work on two levels: totals per block inside the group, then an ordinary window inside a block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for key in keys:
        cond = cond & left[key].eqNullSafe(right[f"_{key}"])
    return cond


def running_total(
    df: DataFrame,
    group: Sequence[str],
    block: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
    total_name: str | None = None,
    descending: bool = False,
) -> DataFrame:
    """Running sum of ``value`` per ``group`` in the order ``block`` then ``order``.

    ``block`` holds the leading sort columns (such as the service date). Their totals are
    pre-aggregated and prefix-summed per group, which touches one row per block, and rows are
    shuffled by group and block, so a hot group is spread over as many tasks as it has blocks.
    ``order`` must make the sequence total. ``total_name`` adds the total of the whole group.
    """
    keys = [*group, *block]
    direction = (lambda c: F.col(c).desc()) if descending else F.col
    # One struct as key: unlike separate columns it equals itself even with NULL fields, so the window and
    # the join use the same partitioning and the rows are shuffled once. Its hash comes first, since sorts compare numbers
    # much faster than structs.
    whole = F.struct(*keys)
    rows = df.withColumns({"_value": value, "_hash": F.xxhash64(whole), "_key": whole})
    blocks = rows.groupBy("_hash", "_key").agg(F.sum("_value").alias("_block"))
    by_group = Window.partitionBy(*[F.col(f"_key.{c}") for c in group])
    in_order = by_group.orderBy(*[direction(f"_key.{c}") for c in block])
    offsets = blocks.select(
        "_hash",
        "_key",
        F.sum("_block").over(in_order.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        *([F.sum("_block").over(by_group).alias("_total")] if total_name else []),
    )
    inside = Window.partitionBy("_hash", "_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn("_within", F.sum("_value").over(inside))
    out = local.join(offsets, ["_hash", "_key"]).withColumn(name, F.coalesce(F.col("_before"), F.lit(0)) + F.col("_within"))
    if total_name:
        out = out.withColumn(total_name, F.col("_total"))
    return out.drop("_value", "_hash", "_key", "_within", "_before", "_total")


def sequence(
    df: DataFrame, part: Sequence[str], lead: str, tie: str, seq: str = "seq", last: str = "is_last"
) -> DataFrame:
    """Number the rows of a group from the furthest ``lead`` down and mark the last one."""
    out = running_total(
        df, part, [lead], [tie], F.lit(1).cast("bigint"), seq, total_name="_n", descending=True
    )
    return out.withColumn(last, F.col(seq) == F.col("_n")).drop("_n")


def first_in(df: DataFrame, part: Sequence[str], order: Sequence[str], name: str = "is_first") -> DataFrame:
    """Flag the first row of each group.

    The first row's sort key is found by a partial aggregate; the join back is on group and sort
    key together, so it spreads evenly even if one group holds most rows. ``order`` must be unique.
    """
    keys = [*part, *order]
    firsts = (
        df.groupBy(*part)
        .agg(F.min(F.struct(*order)).alias("_f"))
        .select(*[F.col(p).alias(f"_{p}") for p in part], *[F.col(f"_f.{o}").alias(f"_{o}") for o in order])
        .withColumn("_hit", F.lit(True))
    )
    out = df.join(firsts, _null_safe(df, firsts, keys), "left")
    return out.withColumn(name, F.coalesce("_hit", F.lit(False))).drop("_hit", *[f"_{k}" for k in keys])


def topk(df: DataFrame, part: Sequence[str], score: str, tie: Sequence[str], k: int, rank: str = "rk") -> DataFrame:
    """Best ``k`` rows per group. The rank filter sits right on the window, so Spark keeps only
    ``k`` rows per group in each map task before it shuffles (WindowGroupLimit)."""
    w = Window.partitionBy(*part).orderBy(F.col(score).desc(), *[F.col(c) for c in tie])
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def seasonality(df: DataFrame, date_col: str) -> DataFrame:
    """Rows per calendar month, ranked from the busiest; the window sees at most twelve rows."""
    months = df.groupBy(F.month(date_col).cast("bigint").alias("month_no")).agg(F.count(F.lit(1)).alias("n"))
    busiest = Window.partitionBy(F.lit(0)).orderBy(F.desc("n"))
    return months.withColumn("rnk", F.rank().over(busiest).cast("bigint"))


def concentration(df: DataFrame, entity: str, flag: str, shares: Sequence[float]) -> DataFrame:
    """Share of flagged events caused by the worst ``share`` of entities.

    Entities are never ranked one by one. They are folded into a histogram of their event counts
    (one row per distinct count), and the cut that falls inside a histogram row is taken pro rata,
    which is exact because all entities in it have the same count.
    """
    per_entity = df.groupBy(entity).agg(F.count_if(F.col(flag)).alias("events"))
    hist = per_entity.groupBy("events").agg(F.count(F.lit(1)).alias("entities"))
    worst = Window.partitionBy(F.lit(0)).orderBy(F.desc("events"))
    upto = worst.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    cuts = hist.select(
        "events",
        "entities",
        F.coalesce(F.sum("entities").over(upto), F.lit(0)).alias("before"),
        F.sum("entities").over(everything).alias("all_entities"),
        F.sum(F.col("events") * F.col("entities")).over(everything).alias("all_events"),
    ).withColumn("top_share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
    wanted = F.ceil(F.col("top_share") * F.col("all_entities"))
    taken = F.greatest(F.least(F.col("entities"), wanted - F.col("before")), F.lit(0))
    return (
        cuts.groupBy("top_share", "all_entities", "all_events")
        .agg(F.sum(taken * F.col("events")).alias("top_events"))
        .select(
            "top_share",
            F.ceil(F.col("top_share") * F.col("all_entities")).alias("top_entities"),
            "top_events",
            F.round(F.try_divide(F.col("top_events").cast("double"), F.col("all_events").cast("double")), 4).alias(
                "event_share"
            ),
        )
    )

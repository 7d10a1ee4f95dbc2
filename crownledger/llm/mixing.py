"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Documents are shuffled by a hash of their id. Per source, a document's virtual finish time is the number of the
source's tokens up to its end, divided by the source's target; a source whose target is above its size goes
round again, each round in a new order. All sources then share one queue in order of virtual time, which is
cut where its tokens reach the total budget. Within a source the queue follows the shuffle, so the cut is
one position per source and round, and the decision on a document is a comparison with it.

Running sums are taken in two levels, so that no source and no range of the queue is one task: sums per block
of the shuffle (or slice of the queue), a prefix sum over those few rows, and the rows within one block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crownledger.llm.text import WORD, whole_row
from crownledger.sources.scratch import written

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # total budget as a share of all sizes
ROUNDS = 2  # a document is taken so many times at most
KEY_BITS = 60  # of the hash that shuffles
BLOCK_BITS = 10  # 1,024 blocks per source and round
SLICES = 4096  # of the queue, per unit of virtual time; all targets are met near time 1


def words(text: str = "text") -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size) per row, written once: texts are read a single time."""
    return written(docs.select("doc_id", "source", words().alias("size")))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """(rank, source, source_size, target, budget) per source, ranked by code point, null last.

    Targets share ``share`` of all sizes by weight; none is above ``ROUNDS`` times its source's size. The excess goes
    to the others by weight: with the sources ordered by limit per weight, the first k are at their limits,
    and the rest get one common level. k is the first for which that level is within the next limit.
    """
    by_name, everything = W.orderBy(F.col("source").asc_nulls_last()), W.partitionBy(F.lit(0))
    limit = F.col("source_size") * ROUNDS
    ranked = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")))
        .withColumn("limit", limit / F.col("weight"))
    )
    order = W.orderBy("limit", "rank")
    at_limit = F.coalesce(F.sum(limit).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    others = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    total = F.sum("source_size").over(everything) * share
    levels = ranked.withColumn("level", (total - at_limit) / others)
    first = F.min(F.when(F.col("level") <= F.col("limit"), F.struct("limit", "rank", "level"))).over(everything)
    target = F.least(limit.cast("double"), first["level"] * F.col("weight"))
    shared = levels.withColumn("target", F.coalesce(target, limit.cast("double")))
    return shared.withColumn("budget", total).select("rank", "source", "source_size", "target", "budget")


def place(turn: Column) -> Column:
    """A document's place in the shuffle of round ``turn``. Rows that agree in id and size share one place."""
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), turn.cast("string")).cast("binary"))
    return F.struct(
        F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long").alias("key"),
        F.col("doc_id").alias("id"),
        F.col("size").alias("size"),
    )


def queue(sized: DataFrame, shares: DataFrame) -> DataFrame:
    """(rank, turn, place, finish, budget) for every document and round: its virtual finish time."""
    turns = F.when(F.col("target") > F.col("source_size"), F.sequence(F.lit(0), F.lit(ROUNDS - 1))).otherwise(F.array(F.lit(0)))
    entered = (
        sized.join(shares.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .filter("target > 0")
        .select("doc_id", "size", "rank", "source_size", "target", "budget", F.explode(turns).alias("turn"))
        .withColumn("place", place(F.col("turn")))
        .withColumn("block", F.shiftright("place.key", KEY_BITS - BLOCK_BITS))
    )
    block = ["rank", "turn", "block"]
    earlier = W.partitionBy("rank", "turn").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    sums = entered.groupBy(block).agg(F.sum("size").alias("tokens"))
    starts = sums.select(*block, F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("start"))
    inside = F.sum("size").over(W.partitionBy(block).orderBy("place").rowsBetween(W.unboundedPreceding, 0))
    done = F.col("turn") * F.col("source_size") + F.col("start") + F.col("inside")
    return (
        entered.withColumn("inside", inside)
        .join(starts, block)
        .select("rank", "turn", "place", (done / F.col("target")).alias("finish"), "budget")
    )


def plan(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """(of, source_size, target, last) per source; ``last`` holds per round the last place that the budget takes."""
    shares = written(targets(sized, weights, share))
    slice_ = F.floor(F.least(F.col("finish"), F.lit(2.0)) * SLICES)
    timed = written(queue(sized, shares).withColumn("slice", slice_))
    upto = W.orderBy("slice").rowsBetween(W.unboundedPreceding, 0)
    slices = timed.groupBy("slice").agg(F.sum("place.size").alias("tokens"), F.max("budget").alias("budget"))
    ends = slices.withColumn("end", F.sum("tokens").over(upto))
    # slices that fit as a whole, and the one in which the budget ends
    reached = ends.filter("end - tokens <= budget").select("slice", (F.col("end") > F.col("budget")).alias("edge"), (F.col("end") - F.col("tokens")).alias("start"))
    taken = timed.join(reached, "slice")
    order = W.partitionBy("slice").orderBy("finish", "rank", "place").rowsBetween(W.unboundedPreceding, 0)
    edge = taken.filter("edge").withColumn("end", F.col("start") + F.sum("place.size").over(order)).filter("end <= budget")
    kept = taken.filter("not edge").select("rank", "turn", "place").union(edge.select("rank", "turn", "place"))
    lasts = kept.groupBy("rank").agg(*[F.max(F.when(F.col("turn") == t, F.col("place"))).alias(f"t{t}") for t in range(ROUNDS)])
    last = F.array(*[F.col(f"t{t}") for t in range(ROUNDS)])
    return written(shares.join(lasts, "rank", "left").select(F.col("source").alias("of"), "source_size", "target", last.alias("last")))


def copies() -> Column:
    """How often the plan takes a document."""
    return sum(
        (F.coalesce(place(F.lit(t)) <= F.col("last")[t], F.lit(False)).cast("int") for t in range(ROUNDS)), F.lit(0)
    )


def op6_mixing(docs: DataFrame) -> DataFrame:
    """The contract's columns per document."""
    sized = sizes(docs)
    decided = sized.join(plan(sized), F.col("source").eqNullSafe(F.col("of")))
    return decided.select("doc_id", "size", "source_size", "target", (copies() * F.col("size")).alias("taken"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """The mixture: the rows of ``docs``, each as often as it is taken, with the same columns.

    Null and empty texts have no words and are taken with the words around them; a null source is a source of
    its own; a null id is an id like another. Rows that agree in source, id and size are taken alike. No rows
    or no words: no mixture. Texts are not shuffled.
    """
    decided = plan(sizes(docs), weights, share)
    rows = docs.select(whole_row(docs), "doc_id", "source", words().alias("size"))
    return (
        rows.join(decided, F.col("source").eqNullSafe(F.col("of")))
        .select("row", F.explode(F.array_repeat(F.lit(0), copies())).alias("copy"))
        .select("row.*")
    )


#: The same queue without blocks and slices; targets by resharing the excess step by step.
ORACLE_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS own, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM sized GROUP BY source
), steps AS (
  SELECT 0 AS step, source, own, rank, CASE rank % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, false AS full_, 0.0::DOUBLE AS target
  FROM sources
  UNION ALL
  SELECT step + 1, source, own, rank, weight, full_ OR level * weight > 2 * own, CASE WHEN full_ THEN 2.0 * own ELSE level * weight END
  FROM (SELECT *, (sum(own) OVER () * 1.5::DOUBLE - coalesce(sum(2 * own) FILTER (full_) OVER (), 0)) / (sum(weight) FILTER (NOT full_) OVER ()) AS level
        FROM steps WHERE step <= (SELECT count(*) FROM sources))
), targets AS (
  SELECT source, own, rank, target::DOUBLE AS target FROM steps WHERE step = (SELECT max(step) FROM steps)
), queued AS (
  SELECT doc_id, size, rank, turn, own, target,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || turn), 1, 15))::BIGINT AS key
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source, (VALUES (0), (1)) AS turns(turn)
  WHERE target > 0 AND (turn = 0 OR target > own)
), timed AS (
  SELECT *, (turn * own + sum(size) OVER (PARTITION BY rank, turn ORDER BY key, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING))::DOUBLE
            / target AS finish
  FROM queued
), used AS (
  SELECT *, sum(size) OVER (ORDER BY finish, rank, key, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS done FROM timed
), taken AS (
  SELECT doc_id, rank, sum(size) FILTER (done <= (SELECT sum(size) * 1.5::DOUBLE FROM sized)) AS taken FROM used GROUP BY doc_id, rank
)
SELECT doc_id, size, own AS source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source LEFT JOIN taken USING (doc_id, rank)
"""

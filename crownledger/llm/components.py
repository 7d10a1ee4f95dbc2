"""Connected components of a link table, by alternating star contraction.

Every round replaces the links of a node by links to its smallest neighbour (small star) and then moves each
link up to the parent's smallest parent (large star). The number of rounds grows with the logarithm of the
longest chain. Nodes and links stay in tables: a round is two shuffles of narrow rows, and its result
is written to the shared checkpoint folder, so that lineage does not grow and a lost executor costs
only its own tasks. A hub is never a shuffle key of a list: each node only keeps its minimum. Links that are
found later contract the roots that they connect, not all links anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crownledger.sources.scratch import written


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) that is not its component's smallest.

    Null ends and self links are ignored; repeated links and either direction are fine; no links, no rows.
    """
    child, parent = F.greatest("a", "b"), F.least("a", "b")
    pairs = links.filter("a is not null and b is not null and a != b")
    edges = written(pairs.select(child.alias("node"), parent.alias("up")).distinct())
    while True:
        least = edges.groupBy("node").agg(F.min("up").alias("least"))
        small = (
            edges.join(least, "node")
            .select(F.inline(F.array(F.struct("node", "least"), F.struct(F.col("up").alias("node"), "least"))))
            .filter("node != least")
            .distinct()
        )
        top = small.groupBy(F.col("node").alias("least")).agg(F.min("least").alias("above"))
        large = small.join(top, "least", "left").select("node", F.coalesce("above", "least").alias("up"))
        edges = written(large.distinct())
        children = edges.groupBy("node").agg(F.count(F.lit(1)).alias("ups"))
        # settled: every node has one parent, and no parent is a child
        chained = edges.join(children.select(F.col("node").alias("up")), "up", "left_semi").select("node")
        if not chained.union(children.filter("ups > 1").select("node")).head(1):
            return edges.withColumnRenamed("up", "root")


def rooted(rows: DataFrame, roots: DataFrame, *columns: str) -> DataFrame:
    """``rows`` with the root of each of the columns in its place; nodes without one are their own."""
    for c in columns:
        found = roots.select(F.col("node").alias(c), F.col("root").alias("__root"))
        rows = rows.join(found, c, "left").withColumn(c, F.coalesce("__root", c)).drop("__root")
    return rows


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) of what ``roots``, a result of :func:`components`, and the new ``links`` (a, b) connect together."""
    joined = components(rooted(links.select("a", "b"), roots, "a", "b"))
    return written(rooted(roots, joined, "root").select("node", "root").union(joined.select("node", "root")))

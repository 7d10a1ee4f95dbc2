"""Grouped statistics, distributions, counts per table and set comparisons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crownledger.functions import exprs as X


def distinct_stats(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys and duplicates. Counted through a group-by, so it pre-aggregates per key."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
            F.count(key).alias("distinct_keys"),
            F.coalesce(F.sum("n") - F.count(key), F.lit(0)).alias("duplicates"),
        )
    )


def bounds(df: DataFrame, by: Column, name: str, date_col: str) -> DataFrame:
    return df.groupBy(by.alias(name)).agg(
        F.count(F.lit(1)).alias("n"), F.min(date_col).alias("first"), F.max(date_col).alias("last")
    )


def value_counts(df: DataFrame, *cols: str) -> DataFrame:
    """Value distribution of one or more columns in one pass: (column_checked, value, cnt)."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_checked"), F.col(c).cast("string").alias("value")) for c in cols])
    return (
        df.select(F.explode(cells).alias("x"))
        .select("x.*")
        .groupBy("column_checked", "value")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def value_inventory(tables: Mapping[str, DataFrame], cols: Sequence[tuple[str, str]]) -> DataFrame:
    """Distinct values of categorical columns of several tables; each table is scanned once."""
    per_table: dict[str, list[str]] = {}
    for table, col in cols:
        per_table.setdefault(table, []).append(col)
    parts = [value_counts(tables[table], *names) for table, names in per_table.items()]
    return reduce(DataFrame.unionByName, parts).select(
        F.col("column_checked").alias("column_name"), "value", F.col("cnt").alias("n")
    )


def utilization(df: DataFrame, pct_col: str) -> DataFrame:
    return df.groupBy(X.utilization_band(pct_col).alias("bucket")).agg(F.count(F.lit(1)).alias("cnt"))


def mean_by(df: DataFrame, by: str, col: str, digits: int = 2) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("cnt"), X.mean_r(col, digits).alias("mean"))


def members(df: DataFrame, key: str, col: str) -> DataFrame:
    """Set of members per key as rows, which has no size limit."""
    return df.select(key, col).distinct()


def member_sets(df: DataFrame, key: str, col: str) -> DataFrame:
    """Set of members per key as a sorted array, for members of a small reference table."""
    return df.groupBy(key).agg(F.array_sort(F.collect_set(col)).alias("members"))


def group_sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def text_stats(df: DataFrame, col: str) -> DataFrame:
    size = F.length(col).cast("bigint")
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.sum(size).alias("chars"),
        F.round(F.try_divide(F.sum(size).cast("double"), F.count(col)), 1).alias("mean_chars"),
        F.round(F.sum(size).cast("double") / (1024.0 * 1024.0), 1).alias("mb"),
    )


def top_n(df: DataFrame, score: str, tie: Sequence[str], n: int) -> DataFrame:
    """Best ``n`` rows; Spark keeps ``n`` rows per task and merges them, without a full sort."""
    return df.orderBy(F.col(score).desc(), *[F.col(c) for c in tie]).limit(n)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table as one relation; a count reads no column data from parquet."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def set_diff(expected: DataFrame, actual: DataFrame, name: str) -> DataFrame:
    """Members on one side only, with the side they are missing from."""
    both = expected.select(name, F.lit(1).alias("e"), F.lit(0).alias("a")).unionByName(
        actual.select(name, F.lit(0).alias("e"), F.lit(1).alias("a"))
    )
    sides = both.groupBy(name).agg(F.max("e").alias("e"), F.max("a").alias("a"))
    return sides.filter(F.col("e") != F.col("a")).select(
        name, F.when(F.col("e") == 1, "missing").otherwise("extra").alias("side")
    )

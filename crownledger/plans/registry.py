"""Named queries. Each takes a :class:`Lake` and returns a DataFrame; the driver entry binds them to a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from crownledger.bindings import Lake
from crownledger.functions.exprs import edge

QUERIES: dict[str, Callable[[Lake], DataFrame]] = {}


def query(name: str) -> Callable[[Callable[[Lake], DataFrame]], Callable[[Lake], DataFrame]]:
    """Register a query. Its result leaves the engine with DOUBLE money and BIGINT counts."""

    def add(fn: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda t: edge(fn(t))
        return fn

    return add


def load_all() -> dict[str, Callable[[Lake], DataFrame]]:
    from crownledger.plans import layers, quality, relational, retrieval, rules, semantic, storage  # noqa: F401

    return QUERIES


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return load_all()[name](Lake(spark, folder))

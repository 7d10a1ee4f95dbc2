"""Join operators. Joins carry no broadcast hints: adaptive execution picks a broadcast by measured size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAIR_CELLS = 64


def lines_with_service_date(lines: DataFrame, invoices: DataFrame) -> DataFrame:
    """Each line with the service date of its invoice."""
    return lines.join(invoices.select("invoice_id", "service_date"), "invoice_id")


def with_dim(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows with the columns of a dimension; the key appears once."""
    return fact.join(dim, key)


def parent_with_children(
    parent: DataFrame, key: str, children: Sequence[DataFrame], keep_null: Sequence[str] = ()
) -> DataFrame:
    """One row per parent with the columns of children that are already aggregated to the key.

    Aggregating first is what keeps several one-to-many children from multiplying each other, and
    it also means that only one row per key and child is shuffled. Measures of absent children are 0.
    """
    out = reduce(lambda left, child: left.join(child, key, "left"), children, parent)
    measures = {c for child in children for c in child.columns} - {key, *keep_null}
    return out.select(
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) if c in measures else F.col(c) for c in out.columns]
    )


def count_children(
    parent: DataFrame, child: DataFrame, key: str, aggs: Mapping[str, Column], zeros: Sequence[str]
) -> DataFrame:
    """Parent rows with child aggregates; a parent without children keeps NULL except in ``zeros``.

    Same rows as joining the raw child and grouping afterwards, but few hot parents never receive
    the raw child rows: the child is reduced in the map tasks first.
    """
    per_key = child.groupBy(key).agg(*[c.alias(n) for n, c in aggs.items()])
    out = parent.join(per_key, key, "left")
    return out.withColumns({z: F.coalesce(z, F.lit(0)) for z in zeros})


def fanout_report(
    children: Mapping[str, tuple[DataFrame, Mapping[str, Column]]], key: str, parent: DataFrame
) -> DataFrame:
    """How a plain join of several children would inflate their measures: (measure, before, after).

    The inflated value is computed, not materialised: a child row of a key would be repeated once
    per combination of the other children's rows, so the factor is the product of their row counts.
    """
    counted = {
        name: df.groupBy(key).agg(
            F.count(F.lit(1)).alias(f"_{name}_rows"), *[m.alias(f"{name}.{label}") for label, m in ms.items()]
        )
        for name, (df, ms) in children.items()
    }
    wide = reduce(lambda left, right: left.join(right, key, "left"), counted.values(), parent.select(key))
    rows = {name: F.col(f"_{name}_rows").cast("decimal(18,0)") for name in children}  # a product may pass 2^63
    aggs, labels = [], []
    for name, (_, ms) in children.items():
        others = [F.greatest(F.coalesce(rows[o], F.lit(0)), F.lit(1)) for o in children if o != name]
        factor = reduce(lambda a, b: a * b, others)
        for label in ms:
            value = F.coalesce(F.col(f"`{name}.{label}`"), F.lit(0))
            aggs += [
                F.sum(value).cast("double").alias(f"b{len(labels)}"),
                F.sum(value * factor).cast("double").alias(f"a{len(labels)}"),
            ]
            labels.append(f"{name}.{label}")
    one = wide.agg(*aggs)
    pairs = F.array(
        *[
            F.struct(F.lit(label).alias("measure"), F.col(f"b{i}").alias("before"), F.col(f"a{i}").alias("after"))
            for i, label in enumerate(labels)
        ]
    )
    return one.select(F.explode(pairs).alias("r")).select("r.*")


def match_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two (table_name, row_count) relations side by side with a match flag."""
    return a.withColumnRenamed("row_count", "bronze_rows").join(
        b.withColumnRenamed("row_count", "silver_rows"), "table_name"
    ).withColumn("match", F.col("bronze_rows") == F.col("silver_rows"))


def orphans(child: DataFrame, ccol: str, parent: DataFrame, pcol: str) -> DataFrame:
    """Distinct non-null child keys without a parent, with their number of rows."""
    keys = child.filter(F.col(ccol).isNotNull()).groupBy(F.col(ccol).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return keys.join(parent.select(F.col(pcol).alias("key")), "key", "left_anti")


def all_pairs(left: DataFrame, lkey: str, right: DataFrame, rkey: str, carried: Sequence[str] = ()) -> DataFrame:
    """Every (left key, right key) pair of two parents with unique keys, for relations defined on all pairs.

    The pairs are the result itself. They are made by an equi-join on a cell number: a left key
    lies in one cell and each right key is copied to all cells, so the work is spread over the
    cells and neither side has to fit into one task. The left keys are dealt out first, to a fixed number of
    tasks: by their own size they would be one small partition, which then makes all pairs. ``carried`` are
    columns of the left side that the pairs keep.
    """
    dealt = left.select(lkey, *carried).repartition(PAIR_CELLS, lkey)
    cells = dealt.withColumn("_cell", F.pmod(F.xxhash64(lkey), F.lit(PAIR_CELLS)))
    copies = right.select(rkey).withColumn(
        "_cell", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(PAIR_CELLS - 1).cast("bigint")))
    )
    return cells.join(copies, "_cell").drop("_cell")


def shared_network(office_nets: DataFrame, company_nets: DataFrame) -> DataFrame:
    """Smallest network that an office and a company both belong to, for pairs that share one."""
    offices = office_nets.select("office_id", "network_id").distinct()
    companies = company_nets.select("insurance_company_id", "network_id").distinct()
    return (
        offices.join(companies, "network_id")
        .groupBy("office_id", "insurance_company_id")
        .agg(F.min("network_id").alias("shared_network_id"))
    )


def compare_on(a: DataFrame, b: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Rows of ``a`` with the value that ``b`` has for the same keys, and whether they agree."""
    ref = b.select(*keys, F.col(col).alias(f"{col}_ref"))
    return a.join(ref, list(keys)).withColumn("agrees", F.col(col) == F.col(f"{col}_ref"))


def with_line_totals(invoices: DataFrame, lines: DataFrame) -> DataFrame:
    """Invoices with the sums of their lines; NULL sums where an invoice has no line."""
    sums = lines.groupBy("invoice_id").agg(
        F.sum("unit_price").alias("line_gross"), F.sum("allowed_amount").alias("line_allowed")
    )
    return invoices.join(sums, "invoice_id", "left")


def patient_policy(subscribers: DataFrame, dependents: DataFrame) -> DataFrame:
    """Policy of every insured patient; dependents inherit the policy of their subscriber."""
    own = subscribers.select("patient_id", "policy_id")
    inherited = dependents.select("patient_id", "subscriber_id").join(
        subscribers.select("subscriber_id", "policy_id"), "subscriber_id"
    )
    return own.unionByName(inherited.select("patient_id", "policy_id"))


def with_rule(lines: DataFrame, rules: DataFrame) -> DataFrame:
    """Lines with the coverage rule of their policy and billing code."""
    return lines.join(rules, ["policy_id", "billing_code_id"])


def star(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Fact left-joined to its dimensions; dimension columns are prefixed with the dimension's name."""
    out = fact
    for name, (dim, key) in dims.items():
        renamed = dim.select(
            F.col(key).alias(f"_{name}_key"), *[F.col(c).alias(f"{name}_{c}") for c in dim.columns if c != key]
        )
        out = out.join(renamed, F.col(key) == F.col(f"_{name}_key"), "left").drop(f"_{name}_key")
    return out


def set_compare(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys only in ``a`` and only in ``b``, as one row, found by one shared aggregation."""
    both = a.select(key, F.lit(1).alias("in_a"), F.lit(0).alias("in_b")).unionByName(
        b.select(key, F.lit(0).alias("in_a"), F.lit(1).alias("in_b"))
    )
    sides = both.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max("in_a").alias("a"), F.max("in_b").alias("b"))
    return sides.agg(
        F.count_if((F.col("a") == 1) & (F.col("b") == 0)).alias("only_a"),
        F.count_if((F.col("a") == 0) & (F.col("b") == 1)).alias("only_b"),
        F.count_if((F.col("a") == 1) & (F.col("b") == 1)).alias("in_both"),
    )

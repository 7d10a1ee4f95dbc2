"""The pipeline's stages against brute force, each on its own input."""

from collections import Counter, defaultdict

import pytest
from test_decontam import plain as likeness
from test_mixing import n_words, plain_mix
from test_cascade import plain as judged
from test_simhash import plain_likeness

import __spark_entry__ as entry
import corpus_pipeline as C
from crownledger.llm import queries, sharding
from crownledger.session import ARROW_BYTES, BATCH_BYTES
from crownledger.sources.scratch import written

FOLDER = "/root/testdata/sf0.001"


def expected(stage, rows, items):
    """The rows that a stage should keep, as a counter of (doc_id, text, source)."""
    if stage == 0:
        return Counter(r for r in rows if judged(r[1])[-1])
    if stage == 1:
        groups = plain_likeness([t for _, t, _ in rows])
        least = defaultdict(list)
        for r, g in zip(rows, groups, strict=True):
            least[g].append((r[0] is None, r[0] or 0, r))
        assert all(len({x[:2] for x in v}) == len(v) for v in least.values())
        return Counter(min(v, key=lambda x: x[:2])[2] for v in least.values())
    if stage == 2:
        return Counter(r for r in rows if not any(likeness(r[1], x) >= 0.8 for x in items))
    if stage == 3:
        _, taken = plain_mix([(i, s, n_words(t)) for i, t, s in rows])
        return Counter({r: taken[r[0], r[2], n_words(r[1])] for r in rows if taken[r[0], r[2], n_words(r[1])]})
    return Counter(rows)


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    columns = docs.columns
    for n, (_, stage) in enumerate(C.STAGES):
        rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        docs = written(stage(spark, docs, FOLDER))
        got = Counter((r.doc_id, r.text, r.source) for r in docs.collect())
        assert got == expected(n, rows, items), n
        assert docs.columns == columns + ["slot", "shard"] * (n == 4)
    owners = sharding.filled(sharding.SHARDS)
    assert all(r.shard == sharding.SHARDS[owners[r.slot]] for r in docs.collect())
    assert sorted(r.doc_id for r in C.run(spark, FOLDER).collect()) == sorted(r.doc_id for r in docs.collect())


def test_stages_on_odd_rows(spark, messy, nothing):
    for docs in (messy, nothing):
        for name, stage in C.STAGES:
            out = stage(spark, docs, FOLDER)
            assert [c for c in out.columns if c not in ("slot", "shard")] == [c for c in docs.columns if c not in ("slot", "shard")], name
            assert out.count() <= 2 * docs.count()


def test_registered_queries():
    named = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in named) == 1
    assert "pipeline" in named and set(queries.oracle_sql()) <= set(named)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_equal_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = queries.queries()[name](spark, FOLDER)
    found = con.execute(queries.oracle_sql()[name])
    at = [[d[0] for d in found.description].index(c) for c in df.columns]
    want = [tuple(r[i] for i in at) for r in found.fetchall()]
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, want))


def test_stages_bound_the_arrow_batches_and_keep_smaller_ones(spark, messy):
    before = spark.conf.get(ARROW_BYTES)
    try:
        for given, wanted in (("64m", str(BATCH_BYTES)), ("67108864b", str(BATCH_BYTES)), ("1m", "1m")):
            spark.conf.set(ARROW_BYTES, given)
            C.good_quality(spark, messy, FOLDER)
            assert spark.conf.get(ARROW_BYTES) in (wanted, f"{wanted}b")
    finally:
        spark.conf.set(ARROW_BYTES, before)

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from crownledger.llm import mixing as M


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes, weights=(5, 2, 1), share=1.5):
    """Reshare the excess until no target is above twice its source's size."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, open_, target = sum(sizes.values()) * share, set(names), {}
    while open_:
        left = total - sum(target.values())
        level = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if level[s] > 2 * sizes[s]}
        target |= {s: 2.0 * sizes[s] for s in over} if over else level
        open_ = open_ - over if over else set()
    return {s: target[s] for s in names}


def plain_mix(rows, weights=(5, 2, 1), share=1.5):
    """Times that each (id, source, size) is taken: one queue of all documents and rounds by virtual finish time."""
    sizes = defaultdict(int)
    for _, s, n in rows:
        sizes[s] += n
    target, queue = plain_targets(sizes, weights, share), []

    def key(i, turn):
        return int(hashlib.md5(f"{'' if i is None else i}:{turn}".encode()).hexdigest()[:15], 16)

    for rank, s in enumerate(target):
        for turn in range(2 if target[s] > sizes[s] else 1):
            done = turn * sizes[s]
            for k, known, i, n in sorted((key(i, turn), i is not None, i or 0, n) for i, x, n in rows if x == s):
                done += n
                if target[s]:
                    queue.append((done / target[s], rank, k, i, n, (i if known else None, s, n)))
    taken, used = defaultdict(int), 0
    for *_, n, row in sorted(queue, key=lambda q: q[:5]):
        used += n
        if used > sum(target.values()):
            break
        taken[row] += 1
    return target, taken


@pytest.mark.parametrize("table", ["messy", "small"])
def test_contract_equals_one_queue(request, table):
    docs = request.getfixturevalue(table).dropDuplicates()
    rows = [(r.doc_id, r.source, n_words(r.text)) for r in docs.collect()]
    assert len(set(rows)) == len(rows)
    target, taken = plain_mix(rows)
    got = M.op6_mixing(docs)
    by = {(r.doc_id, r.size, r.source_size): r for r in got.collect()}
    sizes = defaultdict(int)
    for _, s, n in rows:
        sizes[s] += n
    assert len(by) == len(rows)
    for row in rows:
        r = by[row[0], row[2], sizes[row[1]]]
        assert r.target == pytest.approx(target[row[1]])
        assert r.taken == taken[row] * row[2], row
    near = defaultdict(int)
    for row, n in taken.items():
        near[row[1]] += n * row[2]
    if table == "small":
        largest = max(n for *_, n in rows)
        assert all(abs(near[s] - target[s]) <= largest for s in target)


@pytest.mark.parametrize(
    ("sizes", "weights", "share"),
    [
        ({"a": 10, "b": 10, "c": 10}, (5, 2, 1), 1.5),
        ({"a": 1, "b": 1000, "c": 10, "d": 5, "e": 0, None: 7}, (5, 2, 1), 1.5),
        ({"a": 0, "b": 0}, (5, 2, 1), 1.5),
        ({"a": 3}, (1,), 0.5),
        ({chr(65 + i): 7 * i % 31 + 1 for i in range(26)}, (9, 1), 1.9),
    ],
)
def test_targets_equal_repeated_resharing(spark, sizes, weights, share):
    sized = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in M.targets(sized, weights, share).collect()}
    want = plain_targets(sizes, weights, share)
    assert got == {s: pytest.approx(t) for s, t in want.items()}


def test_mixture_has_the_rows_that_the_query_takes(small):
    taken = {r.doc_id: r.taken // r.size for r in M.op6_mixing(small).collect() if r.size}
    mixed = M.mix(small)
    assert mixed.schema == small.schema
    got = {r.doc_id: r["count"] for r in mixed.filter(M.words() > 0).groupBy("doc_id").count().collect()}
    assert got == {i: n for i, n in taken.items() if n}
    assert sorted(r.doc_id for r in M.mix(small.repartition(5)).collect()) == sorted(r.doc_id for r in mixed.collect())


def test_odd_tables(spark, messy, nothing):
    assert M.mix(messy).schema == messy.schema and M.op6_mixing(messy).count() == messy.count()
    assert M.mix(nothing).count() == 0 and M.op6_mixing(nothing).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert {tuple(r) for r in M.op6_mixing(blank).collect()} == {(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)}


def test_one_hot_source_is_spread_over_blocks(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("hot").alias("source"), (F.col("id") % 7).alias("size"))
    shares = M.targets(docs)
    queued = M.queue(docs, shares)
    assert queued.count() == 40_000
    finish = [r.finish for r in queued.orderBy("finish").collect()]
    assert finish[-1] == pytest.approx(2 * 59_998 / (1.5 * 59_998), rel=1e-3)


def test_main_path_runs_no_python(small):
    for df in (M.mix(small), M.op6_mixing(small)):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "NestedLoop" not in plan

"""Ranked search against scores written out plainly."""

import math
import random
import re
from collections import Counter

import duckdb
import pytest

from crownledger.llm import lexical
from crownledger.sources.scratch import written

FOLDER = "/root/testdata/sf0.001"


def split(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain(docs, items, k=10):
    """Rows (item_id, rank, doc_id, score); docs and items are (id, text)."""
    held = [(i, Counter(split(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, counts in held:
            m = 25 + (75 * counts.total() * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * counts[t]) // (1000 * counts[t] + 8 * m))
                for t in split(text)
                if counts[t]
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k], 1)]
    return Counter(out)


def got(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string")
    return Counter(tuple(r) for r in lexical.search(written(lexical.index(d)), q, **more).collect())


@pytest.fixture
def little(monkeypatch):
    """Shards, batches and intervals so small that all of the search is walked through."""
    for name, value in {"SHARD_DOCS": 40, "LEAF": 2, "BATCH": 3, "PROBE": 2}.items():
        monkeypatch.setattr(lexical, name, value)


def corpus(seed, n=300):
    rng = random.Random(seed)
    word = lambda: f"w{int(rng.paretovariate(0.6)) % 400}"
    docs = [(i, " ".join(word() for _ in range(rng.randrange(1, 60)))) for i in range(n)]
    docs += [(n + i, docs[7][1]) for i in range(60)]  # copies that tie
    docs += [(None, docs[7][1]), (None, "w1 w2"), (5, None), (6, ""), (9, docs[9][1]), (9, docs[9][1])]
    items = [(i, " ".join(word() for _ in range(rng.randrange(1, 30)))) for i in range(25)]
    items += [(100, docs[7][1]), (101, None), (102, ""), (103, "absent"), (100, docs[7][1]), (None, "w1 w1 W1")]
    return docs, items


@pytest.mark.parametrize("seed", range(3))
def test_search_equals_plain_scores(little, seed):
    """In process: every shard's search, with floors and without, against all scores of its documents."""
    docs, items = corpus(seed)
    docs = [d for d in docs if d[0] is not None]
    builder = lexical.Builder()
    for i, t in docs:
        if tokens := lexical.terms((t or "").encode()):
            builder.add(i, tokens)
    row = builder.shard()
    asked = lexical.Questions([(i, (t or "").encode()) for i, t in items])
    df = Counter(t for _, x in docs for t in set(split(x)))
    asked.weigh(row["n_docs"], row["n_terms"], {n: df[t.decode()] for t, n in asked.numbers.items()})
    shard = lexical.Shard(row, asked)
    want = plain(docs, items)
    for floor in (1, None):
        found = []
        for n, (item, _) in enumerate(items):
            least = min((s for i, _, _, s in want if i == item), default=1) if floor is None else floor
            hits = shard.search(asked.asked[n], asked.weights, least)
            found += [(item, rank, row["ids"][doc], -low) for rank, (low, doc) in enumerate(hits, 1)]
        assert Counter(found) == want


def test_many_shards(spark):
    docs, items = corpus(7)
    assert got(spark, docs, items) == plain(docs, items)
    assert got(spark, docs, items, limit=300, k=3) == plain(docs, items, 3)  # several blocks of items


def test_search_passes_over_documents(monkeypatch):
    """Bounds save work: with a rare term only few documents of many are scored."""
    monkeypatch.setattr(lexical, "LEAF", 1)
    monkeypatch.setattr(lexical, "BATCH", 1)
    builder = lexical.Builder()
    for i in range(5000):
        builder.add(i, [b"a"] * (1 + i % 7) + [b"b"] * 9 + ([b"rare"] if i % 500 == 3 else []))
    row = builder.shard()
    asked = lexical.Questions([(0, b"rare a")])
    asked.weigh(row["n_docs"], row["n_terms"], {asked.numbers[b"rare"]: 10, asked.numbers[b"a"]: 5000})
    shard = lexical.Shard(row, asked)
    steps = []
    heappop = lexical.heappop
    monkeypatch.setattr(lexical, "heappop", lambda q: steps.append(1) or heappop(q))
    hits = shard.search(asked.asked[0], asked.weights, 1)
    assert {d % 500 for _, d in hits} == {3} and len(steps) < 100


def test_odd_tables(spark, messy, nothing):
    items = spark.createDataFrame([(1, "word3 WORD4", "x"), (2, None, None)], "item_id long, text string, rank string")
    docs = [(r.doc_id, r.text) for r in messy.collect()]
    rows = Counter(tuple(r) for r in lexical.op13_lexical(messy, items).collect())
    assert rows == plain(docs, [(1, "word3 WORD4"), (2, None)])
    assert lexical.op13_lexical(nothing, items).collect() == []
    assert lexical.op13_lexical(messy, items.limit(0)).collect() == []


def test_wide_numbers():
    import numpy as np

    sizes = np.array([1, 10**9], np.int64)
    assert lexical.lengths(sizes, 10**11, 10**14).tolist() == [25 + 75 * 10**11 * n // 10**14 for n in (1, 10**9)]


def test_query_equals_plain(spark):
    con = duckdb.connect()
    docs, items = (con.execute(f"SELECT {c}, text FROM '{FOLDER}/{t}.parquet'").fetchall() for c, t in (("doc_id", "documents"), ("item_id", "benchmark")))
    read = spark.read.parquet
    out = lexical.op13_lexical(read(f"{FOLDER}/documents.parquet"), read(f"{FOLDER}/benchmark.parquet"))
    assert Counter(tuple(r) for r in out.collect()) == plain(docs, items)

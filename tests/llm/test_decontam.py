import random
import re
from collections import Counter

import numpy as np
import pytest

from crownledger.llm import decontam as D


def plain_words(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())


def shingles(words):
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def plain(text, item):
    """The best similarity of the text's windows of the item's number of words."""
    mine, own = plain_words(text), plain_words(item)
    if len(own) < 5 or len(mine) < 5:
        return 0.0
    want, best = shingles(own), 0.0
    if not want.keys() & shingles(mine).keys():
        return 0.0
    for i in range(len(mine) - 4):
        window = shingles(mine[i : i + len(own)])
        shared = (want & window).total()
        best = max(best, shared / (want.total() + window.total() - shared))
    return best


def prose(rng, n):
    return [f"w{rng.randrange(400)}" for _ in range(n)]


@pytest.fixture(scope="module")
def planted():
    """Items, and texts that hold them whole, changed a little or much, at the start, inside and at the end."""
    rng = random.Random(3)
    items = [(i, " ".join(prose(rng, rng.randrange(15, 70)))) for i in range(30)]
    docs = []
    for i, (_, text) in enumerate(items):
        words = text.split()
        for changes in (0, 1, 2, 4):
            own = list(words)
            for at in rng.sample(range(len(own)), changes):
                own[at] = rng.choice(["changed", own[at].upper() + ",", "new words"])
            before, after = prose(rng, rng.choice([0, 0, 40])), prose(rng, rng.choice([0, 0, 40]))
            docs.append((len(docs), " ".join(before + own + after)))
        docs.append((len(docs), " ".join(prose(rng, 200) + words[: len(words) // 2])))
        docs.append((len(docs), " ".join(words[: max(5, len(words) * 9 // 10)])))
    return docs, items


def test_matches_equal_brute_force(spark, planted):
    docs, items = planted
    want = {(d, i) for d, t in docs for i, x in items if plain(t, x) >= 0.8}
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = D.matches(table, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want) and len(want) > 50
    texts, wanted = dict(docs), dict(items)
    for r in got:
        assert r.similarity == pytest.approx(plain(texts[r.doc_id], wanted[r.item_id]))
        assert 0 < r.end_word - r.first_word <= len(plain_words(wanted[r.item_id]))
    kept = {r.doc_id for r in D.clean(table, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in want}


def test_several_indexes_find_the_same(spark, planted, monkeypatch):
    docs, items = planted
    table, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(tuple, D.matches(table, bench).collect()))
    parts = list(D.indexes(table, bench, limit=1000))
    assert len(parts) > 3
    monkeypatch.setattr(D, "indexes", lambda *_: iter(parts))
    assert sorted(map(tuple, D.matches(table, bench).collect())) == one


def test_index_lists_every_item_within_the_radius():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    near = prints[rng.integers(0, 60, 300)]
    for n, x in enumerate(near):
        near[n] = x ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, n % 24, replace=False)))
    for radius in (0, 7, 20):
        size = D.Size(9, np.arange(60), prints, [D._near(prints, b, radius) for b in range(D.BLOCKS)])
        got = set(zip(*(x.tolist() for x in size.candidates(near, radius)), strict=True))
        assert got == {(i, j) for i, x in enumerate(near) for j, y in enumerate(prints) if np.bitwise_count(x ^ y) <= radius}


def test_running_windows_equal_single_ones():
    rng = np.random.default_rng(2)
    hashes = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    starts = np.unique(rng.integers(0, 500, 200))
    assert D.window_simhashes(hashes, starts, 40).tolist() == [D.simhash(hashes[s : s + 40]) for s in starts]


def test_odd_rows(spark, messy, nothing):
    items = [(1, None), (2, ""), (3, "one"), (None, " ".join(f"word{i}" for i in range(20, 60))), (5, "Word520 word521, word522. word523 word524 word525")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in D.matches(messy, bench).collect()}
    assert got == {(1, None), (2, None), (3, None), (None, None), (9, 5)}
    assert D.clean(messy, bench).schema == messy.schema and D.clean(messy, bench).count() == messy.count() - 5
    assert D.matches(messy, bench.limit(0)).count() == 0 and D.clean(messy, bench.limit(0)).count() == messy.count()
    assert D.matches(nothing, bench).count() == 0

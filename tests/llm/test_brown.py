import random
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from crownledger.llm import brown as B

SIZES = {"size": 60, "frequent": 20, "n_classes": 8, "rounds": 4}


def tokens(text):
    return (text or "").encode().lower().split()


def is_held_out(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


@pytest.mark.parametrize("table", ["messy", "small"])
def test_contract_equals_counting(request, table):
    docs = request.getfixturevalue(table)
    rows = docs.select("doc_id", "text").collect()
    count = Counter()
    for r in rows:
        if not is_held_out(r.doc_id):
            count.update([*tokens(r.text), None])
    total, distinct = sum(count.values()), len(count)
    want = []
    for r in rows:
        own = [*tokens(r.text), None]
        base = sum(log10((count[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in own)
        want.append((r.doc_id, is_held_out(r.doc_id), len(own), sum(count[w] > 0 for w in own), total, round(base, 6)))
    got = B.op4_brown(docs, **SIZES).collect()
    assert sorted(((*r[:5], round(r.base_score, 6)) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.score < 0 and r.perplexity > 1 for r in got)


def plain_score(text, model, counts):
    """Class bigram probability of a text, token by token."""
    units = {w: int(u) for w, u in zip(model.known.words, model.known.units, strict=True)}
    before, total = B.END, 0.0
    for w in tokens(text):
        c = int(model.classes[units.get(w, B.suffix_unit(w))])
        total += model.log_step[before, c] + log10(counts.get(w, 0) + 0.5) - model.log_mass[c]
        before = c
    return total + model.log_step[before, B.END]


def test_scores_and_model_equal_plain_sums(small):
    training = small.filter(~B.held_out()).select(F.col("text").cast("binary").alias("text"))
    model, table = B.train(training, **SIZES)
    counts = Counter(w for r in training.collect() for w in bytes(r.text).lower().split())
    assert {bytes(r.word): r.n for r in table.collect()} == counts
    units = {w: int(u) for w, u in zip(model.known.words, model.known.units, strict=True)}
    of = {w: int(model.classes[units.get(w, B.suffix_unit(w))]) for w in counts}
    steps = np.zeros((8, 8))
    for r in training.collect():
        own = [0, *(of[w] for w in bytes(r.text).lower().split()), 0]
        np.add.at(steps, (own[:-1], own[1:]), 1)
    assert np.allclose(model.log_step, np.log10((steps + 0.5) / (steps.sum(axis=1, keepdims=True) + 4)))
    for c in range(1, 8):
        words = [w for w in counts if of[w] == c]
        assert model.log_mass[c] == pytest.approx(log10(sum(counts[w] for w in words) + 0.5 * (len(words) + 1)))
        # emissions of a class and one unseen word sum to one
        assert sum(counts[w] + 0.5 for w in words) + 0.5 == pytest.approx(10 ** model.log_mass[c])
    assert model.classes[B.END] == B.END and (model.classes[1:] != B.END).all()
    got = {r.key: r.score for r in B.scored(small, model, table).collect()}
    for r in small.collect():
        assert got[r.doc_id] == pytest.approx(plain_score(r.text, model, counts), rel=1e-9)


def test_gain_is_the_change_of_the_likelihood():
    rng = np.random.default_rng(4)
    n, k = 12, 4
    pairs = rng.integers(0, 9, (n, n)).astype(float)
    classes = np.concatenate(([0], 1 + rng.integers(0, k - 1, n - 1)))

    def table(own):
        out = np.zeros((k, k))
        np.add.at(out, (own[:, None].repeat(n, 1), own[None, :].repeat(n, 0)), pairs)
        return out

    def likelihood(own):
        t = table(own)
        return B._xlogx(t).sum() - B._xlogx(t.sum(0)).sum() - B._xlogx(t.sum(1)).sum()

    for unit in range(1, n):
        after = np.bincount(classes, weights=pairs[unit], minlength=k)
        before = np.bincount(classes, weights=pairs[:, unit], minlength=k)
        best, gain = B.best_class(table(classes), after, before, pairs[unit, unit], classes[unit])
        change = []
        for c in range(1, k):
            moved = classes.copy()
            moved[unit] = c
            change.append(likelihood(moved) - likelihood(classes))
        assert gain == pytest.approx(max(change), abs=1e-6)
        assert change[best - 1] == pytest.approx(max(change), abs=1e-6)


def test_exchange_finds_the_kinds_of_words(spark):
    """Two kinds of words that take turns: classes must not mix them, and held-out texts become likelier."""
    rng = random.Random(6)
    kinds = [[f"{k}{i}" for i in range(10)] for k in "xy"]
    texts = [" ".join(rng.choice(kinds[j % 2]) for j in range(40)) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    training = docs.filter(~B.held_out()).select(F.col("text").cast("binary").alias("text"))
    model, counts = B.train(training, size=100, frequent=100, n_classes=3, rounds=12)
    units = dict(zip(model.known.words, model.known.units.tolist(), strict=True))
    assert len({int(model.classes[units[w.encode()]]) for w in kinds[0]}) == 1
    assert len({int(model.classes[units[w.encode()]]) for w in kinds[0] + kinds[1]}) == 2
    rows = B.scored(docs.filter(B.held_out()), model, counts).collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) + 5 * len(rows)


def test_no_training_texts(spark, nothing):
    assert B.op4_brown(nothing, **SIZES).count() == 0
    only = next(i for i in range(20) if is_held_out(i))
    docs = spark.createDataFrame([(only, "never seen")], "doc_id long, text string")
    row = B.op4_brown(docs, **SIZES).first()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and row.base_score == pytest.approx(0.0)


def test_lexicon_is_bounded(spark):
    rows = [(f"w{i}".encode(), 1 + i % 50) for i in range(1000)] + [(b"x" * 100, 10_000)]
    known = B.lexicon(spark.createDataFrame(rows, "word binary, n long"), 300, 40)
    assert 200 <= len(known.words) <= 300 and b"x" * 100 not in known.words and known.n_units <= 1 + B.SUFFIXES + 40
    assert min(known.counts) > max(n for w, n in rows if w not in set(known.words) and len(w) < 64)

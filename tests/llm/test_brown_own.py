"""Every word has a class by its own contexts."""

import random
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from crownledger.llm import brown as B

FEW = {"size": 60, "n_classes": 8, "rounds": 4}


def of_docs(docs):
    return docs.filter(~B.held_out()).select(F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))


def words(text):
    return bytes(text or b"").lower().split()


def test_scores_equal_plain_sums(small):
    training = of_docs(small)
    model, table = B.train(training, **FEW)
    texts = [words(r.text) for r in training.collect()]
    counts = Counter(w for t in texts for w in t)
    rows = table.collect()
    of = {bytes(r.word): r["class"] for r in rows}
    assert {bytes(r.word): r.n for r in rows} == counts and len(rows) == len(counts)
    steps = np.zeros((8, 8))
    for t in texts:
        own = [0, *(of[w] for w in t), 0]
        np.add.at(steps, (own[:-1], own[1:]), 1)
    assert np.allclose(model.log_step, np.log10((steps + 0.5) / (steps.sum(axis=1, keepdims=True) + 4)))
    for c in range(1, 8):
        mine = [w for w in counts if of[w] == c]
        assert sum(counts[w] + 0.5 for w in mine) + 0.5 == pytest.approx(10 ** model.log_mass[c])
    assert all(c != B.END for c in of.values())
    got = {r.key: r for r in B.scored(small, model, table).collect()}
    whole = {r.doc_id: r for r in B.op4_brown(small, **FEW).collect()}
    for r in small.collect():
        before, score = B.END, 0.0
        for w in words((r.text or "").encode()):
            c = of.get(w, int(model.classes[B.suffix_unit(w)]))
            score += model.log_step[before, c] + log10(counts.get(w, 0) + 0.5) - model.log_mass[c]
            before = c
        score += model.log_step[before, B.END]
        assert got[r.doc_id].score == pytest.approx(score, rel=1e-9)
        assert whole[r.doc_id].score == pytest.approx(score, rel=1e-9)
        assert whole[r.doc_id].base_score == pytest.approx(got[r.doc_id].base_score, rel=1e-9)


@pytest.fixture(scope="module")
def kinds(spark):
    """Two kinds of words that take turns; their last two bytes say nothing, and most are too rare to be units."""
    rng = random.Random(6)
    names = [[f"{k}{i:03d}zz" for i in range(160)] for k in "xy"]
    word = lambda kind: rng.choice(kind[:10] if rng.random() < 0.6 else kind[10:])
    texts = [" ".join(word(names[j % 2]) for j in range(40)) for _ in range(200)]
    return names, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_rare_words_leave_their_group(kinds, monkeypatch):
    names, docs = kinds
    monkeypatch.setattr(B, "FREQUENT", 24)
    training = of_docs(docs)
    sizes = {"size": 100, "n_classes": 3, "rounds": 12}
    model, table = B.train(training, **sizes)
    of = {bytes(r.word).decode(): r["class"] for r in table.collect()}
    shares = [Counter(of[w] for w in kind if w in of).most_common(1)[0] for kind in names]
    assert shares[0][0] != shares[1][0] and all(n >= 150 for _, n in shares)
    # the group holds all rare words, so that it stays in one class
    grouped, counts = B.train(training, frequent=24, **sizes)
    assert B.likelihood(model.steps) > B.likelihood(grouped.steps)
    held = docs.filter(B.held_out())
    better, worse = (sum(r.score for r in B.scored(held, m, t).collect()) for m, t in ((model, table), (grouped, counts)))
    assert better > worse + held.count()


def test_fewer_words_change_if_all_of_them_make_the_texts_less_likely(kinds, monkeypatch):
    names, docs = kinds
    monkeypatch.setattr(B, "FREQUENT", 24)
    training = of_docs(docs)
    sizes = {"size": 100, "n_classes": 3, "rounds": 12}
    plain, step = B.own_classes, B.class_steps
    tried = []

    def falls(found, n_classes):
        steps = step(found, n_classes)
        tried.append(steps)
        return np.full_like(steps, steps.sum() / steps.size) if len(tried) == 1 else steps

    monkeypatch.setattr(B, "class_steps", falls)
    model, table = B.train(training, **sizes)
    assert B.own_classes is plain and len(tried) >= 2
    grouped, _ = B.train(training, frequent=24, **sizes)
    assert B.likelihood(model.steps) >= B.likelihood(grouped.steps)
    group = {bytes(r.word): int(grouped.classes[B.suffix_unit(bytes(r.word))]) for r in table.collect()}
    units = {w for w, u in zip(model.known.words, model.known.units, strict=True) if u > B.SUFFIXES}
    assert all(r["class"] == group[bytes(r.word)] for r in table.collect() if zlib.crc32(bytes(r.word)) % 2 and bytes(r.word) not in units)

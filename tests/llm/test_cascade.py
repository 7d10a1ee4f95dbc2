import re
from collections import Counter

import pytest

from crownledger.llm import quality


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(windows)
    inside = {j for i, w in enumerate(windows) if many[w] > 1 for j in range(i, i + 3)}
    n, chars = len(words), sum(map(len, words))
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    dups = sum(x in lines[:i] for i, x in enumerate(lines))
    lettered = sum(bool(re.search(r"[A-Za-z]|[^\x00-\x7f]", w)) for w in words)
    failed = n < 50 or 100 * len(inside) > 50 * n
    kept = not failed and 10 * symbols <= n and 2 * n <= chars <= 15 * n and 100 * dups <= 50 * len(lines) and 10 * lettered >= 7 * n
    return n, chars, symbols, dups, len(inside), failed, kept


@pytest.mark.parametrize("table", ["messy", "small"])
def test_contract_equals_plain_rules(request, table):
    docs = request.getfixturevalue(table)
    want = sorted(((r.doc_id, *plain(r.text)) for r in docs.collect()), key=repr)
    assert sorted((tuple(r) for r in quality.op9_quality(docs).collect()), key=repr) == want


def test_stage_keeps_the_same_rows(small):
    want = sorted(r.doc_id for r in small.collect() if plain(r.text)[-1])
    assert sorted(r.doc_id for r in quality.keep_good(small).collect()) == want


def test_columns_and_empty_tables(messy, nothing):
    assert quality.keep_good(messy).schema == messy.schema
    assert sorted(r.doc_id or 0 for r in quality.keep_good(messy).collect()) == sorted(
        r.doc_id or 0 for r in messy.collect() if plain(r.text)[-1]
    )
    assert quality.keep_good(nothing).count() == 0 and quality.op9_quality(nothing).count() == 0


def test_order_is_by_rejections_per_cost(spark):
    def slow(t):
        return sum(i * i for i in range(20_000)) < 0

    rules = (quality.Rule("slow_never", slow), quality.Rule("cheap_always", lambda t: t.data.startswith(b"x")))
    docs = spark.createDataFrame([("x" if i % 2 else "y",) for i in range(200)], "text string")
    assert [r.name for r in quality.ordered(docs, rules)] == ["cheap_always", "slow_never"]
    assert quality.keep_good(docs, rules).count() == quality.keep_good(docs, rules[::-1]).count() == 100


def test_measures_are_lazy_and_shared():
    text = quality.Text(b"a b c")
    assert quality.first_rejection(text, quality.RULES[:1]) == "too_short"
    assert "n_repeat_words" not in vars(text) and "n_words" in vars(text)

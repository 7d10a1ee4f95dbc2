"""Quality rules as a short-circuit cascade.

Every rule looks at one document and may reject it; a document is kept if no rule does. The verdict does not
depend on the order of the rules, but the work does: each rule's cost and share of rejections are
measured on a bounded random sample, and the rules run by rejections per second, the best first. A rejected
document skips the rest. Measures that rules share are computed once per document, when first asked for.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crownledger.llm.text import as_bytes, kind_of, schema, whole_row

SAMPLE = 2000  # rows on which cost and selectivity are estimated; it changes the order of rules, never a verdict
SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))
LETTER = re.compile(rb"[A-Za-z\x80-\xff]")


class Text:
    """Measures of one text, each computed on first use."""

    def __init__(self, data: bytes):
        self.data = data

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(b"".join(self.words).translate(None, CONTINUATION))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.data) - len(self.data.translate(None, SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.data.split(b"\n") if line and not line.isspace()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_lettered(self) -> int:
        return sum(LETTER.search(w) is not None for w in self.words)

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside a window of three words that occurs at least twice; each word counts once."""
        if self.n_words < 4:
            return 0
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in self.words), np.int64, self.n_words)
        pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
        _, window, count = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
        repeated = np.concatenate((count[window] > 1, [False, False]))
        return int((repeated | np.roll(repeated, 1) | np.roll(repeated, 2)).sum())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


#: Both base rules and the method's own; whole numbers only, so that the same rule in SQL agrees exactly.
RULES = (
    Rule("too_short", lambda t: t.n_words < 50),
    Rule("repeated_words", lambda t: 100 * t.n_repeat_words > 50 * t.n_words),
    Rule("symbols", lambda t: 10 * t.n_symbols > t.n_words),
    Rule("word_length", lambda t: not 2 * t.n_words <= t.word_chars <= 15 * t.n_words),
    Rule("repeated_lines", lambda t: 100 * t.n_dup_lines > 50 * len(t.lines)),
    Rule("few_letters", lambda t: 10 * t.n_lettered < 7 * t.n_words),
)


def first_rejection(text: Text, rules: Iterable[Rule]) -> str | None:
    return next((rule.name for rule in rules if rule.rejects(text)), None)


def ordered(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", sample: int = SAMPLE) -> tuple[Rule, ...]:
    """The rules by rejections per second on a random sample of about ``sample`` rows, the best first."""
    total = docs.count()
    if not total:
        return rules
    picked = docs.select(as_bytes(text).alias("text")).sample(min(1.0, sample / total), seed=1).limit(2 * sample)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seconds, rejected = [0.0] * len(rules), [0] * len(rules)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for i, rule in enumerate(rules):
                start = time.thread_time()
                rejected[i] += sum(rule.rejects(Text(t)) for t in texts)
                seconds[i] += time.thread_time() - start
        yield pa.RecordBatch.from_arrays([pa.array([r.name for r in rules]), pa.array(seconds), pa.array(rejected)], ["rule", "seconds", "rejected"])

    found = picked.mapInArrow(measure, schema(rule="string", seconds="double", rejected="long"))
    rate = {
        r["rule"]: r["rejected"] / max(r["seconds"], 1e-9)
        for r in found.groupBy("rule").agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected")).collect()
    }
    return tuple(sorted(rules, key=lambda rule: -rate.get(rule.name, 0.0)))


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns.

    A null text is an empty one, which ``too_short`` rejects. Repeated rows are judged alike; a document
    is judged on its whole text. An empty table stays empty. No shuffle.
    """
    cascade = ordered(docs, rules, text, sample)
    judged = docs.select(as_bytes(text).alias("text"), whole_row(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [first_rejection(Text(t.as_py()), cascade) is None for t in batch.column(0)]
            yield batch.select([1]).filter(pa.array(good, pa.bool_()))

    return judged.mapInArrow(run, schema(row=kind_of(judged, "row"))).select("row.*")


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def op9_quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The contract's measures per document, base_failed, and kept: no rule of the cascade rejects it."""
    cascade = ordered(docs, rules)
    rows = docs.select("doc_id", as_bytes().alias("text"))
    out = schema(doc_id=kind_of(rows, "doc_id"), **dict.fromkeys(MEASURES, "long"), base_failed="boolean", kept="boolean")
    kinds = [pa.int64()] * len(MEASURES) + [pa.bool_()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in out.names[1:]]
            for value in batch.column(1):
                text = Text(value.as_py())  # one text's words at a time
                base_failed = text.n_words < 50 or 100 * text.n_repeat_words > 50 * text.n_words
                kept = not base_failed and first_rejection(text, cascade) is None
                for column, x in zip(columns, (*(getattr(text, m) for m in MEASURES), base_failed, kept), strict=True):
                    column.append(x)
            arrays = [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], out.names)

    return rows.mapInArrow(run, out)


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS n
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - 2)) AS i FROM d WHERE len(w) > 2)
), repeats AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE n > 1) GROUP BY r
), m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS n_lettered
  FROM d LEFT JOIN lines USING (r) LEFT JOIN repeats USING (r)
), b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 10 * n_symbols <= n_words AND word_chars BETWEEN 2 * n_words AND 15 * n_words
         AND 100 * n_dup_lines <= 50 * n_lines AND 10 * n_lettered >= 7 * n_words AS kept
FROM b
"""

"""Ranked lexical search with range-maximum sparse tables on posting lists.

The index holds shards of documents: one row per shard, with the posting lists of all its terms. A shard is searched
alone. Every posting list that an item touches gets a sparse table of range maxima of its impacts, so that the
largest impact of a term in any interval of documents is two look-ups. The sum of a document interval's maxima bounds every score in
it. The intervals are taken best first; each is split at the document with its largest single impact, which is scored, and both
sides come back with bounds of their own, until no bound reaches the k-th score found. An interval of at most
``LEAF`` documents is scored outright.

Shards are searched twice: the first time for a few steps only, which gives a score that k documents of the whole corpus reach;
the second time to the end, where all that stay below it are passed over. So most shards of a large corpus end at
their first bound. Documents are shuffled never, and of each shard and item only the best ``k`` rows are.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crownledger.llm.text import as_bytes, kind_of, schema
from crownledger.sources.scratch import written

TOP = 10
SHARD_DOCS = 1 << 16  # documents of a shard, at most
SHARD_POSTINGS = 1 << 20  # a shard ends with the document that brings it here
SHARD_TERM_BYTES = 8 << 20
ITEM_BYTES = 4 << 20  # of item texts that are searched for at once
BATCH = 256  # intervals that are split together
LEAF = 128  # documents of an interval that is scored outright
PROBE = 6  # batches of the first search of a shard

#: Bytes that are no part of a term become spaces, A-Z become a-z.
LETTERS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """The terms of a text, in order: runs of digits, letters and all characters beyond ASCII."""
    return text.translate(LETTERS).split()


def _packed(values: np.ndarray | bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values if isinstance(values, bytes) else values.tobytes())


def _unpacked(packed: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), kind)


class Builder:
    """Takes documents and gives a shard: posting lists by term, documents by ascending id (nulls last)."""

    def __init__(self) -> None:
        self.numbers: defaultdict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.ids: list[object] = []
        self.sizes, self.held = array("q"), array("q")
        self.term, self.tf = array("I"), array("I")
        self.bytes = 0

    def add(self, key: object, tokens: list[bytes]) -> None:
        counts = Counter(tokens)
        self.bytes += sum(len(t) for t in counts if t not in self.numbers)
        self.term.extend(map(self.numbers.__getitem__, counts))
        self.tf.extend(counts.values())
        self.ids.append(key)
        self.sizes.append(len(tokens))
        self.held.append(len(counts))

    @property
    def full(self) -> bool:
        return len(self.ids) >= SHARD_DOCS or len(self.term) >= SHARD_POSTINGS or self.bytes >= SHARD_TERM_BYTES

    def shard(self) -> dict[str, object]:
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, 0 if self.ids[i] is None else self.ids[i]))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        doc = np.repeat(place, np.frombuffer(self.held, np.int64))
        term, tf = np.frombuffer(self.term, np.uint32), np.frombuffer(self.tf, np.uint32)
        by_term = np.lexsort((doc, term))
        sizes = np.frombuffer(self.sizes, np.int64)[order]
        return {
            "ids": [self.ids[i] for i in order],
            "n_docs": len(order),
            "n_terms": int(sizes.sum()),
            "sizes": _packed(sizes),
            "terms": _packed(b" ".join(self.numbers)),
            "df": _packed(np.bincount(term, minlength=len(self.numbers)).astype(np.uint32)),
            "docs": _packed(doc[by_term].astype(np.uint16)),
            "tf": _packed(tf[by_term]),
        }


def index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per shard of documents that have a term; no shuffle. Every row of ``docs`` is a document of its own."""
    rows = docs.select(F.col(doc_id).alias("key"), as_bytes(text).alias("text"))
    kind = kind_of(rows, "key")
    packed = dict.fromkeys(("sizes", "terms", "df", "docs", "tf"), "binary")
    out = schema(ids=f"array<{kind.simpleString()}>", n_docs="long", n_terms="long", **packed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def closed(builder: Builder, key_type: pa.DataType) -> pa.RecordBatch:
            row = builder.shard()
            types = {"ids": pa.list_(key_type), "n_docs": pa.int64(), "n_terms": pa.int64()}
            return pa.RecordBatch.from_arrays([pa.array([row[n]], types.get(n, pa.binary())) for n in out.names], out.names)

        builder, key_type = Builder(), None
        for batch in batches:
            key_type = batch.column(0).type
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if tokens := terms(value.as_py()):
                    builder.add(key, tokens)
                    if builder.full:
                        yield closed(builder, key_type)
                        builder = Builder()
        if builder.ids:
            yield closed(builder, key_type)

    return rows.mapInArrow(run, out)


class Questions:
    """A block of items: their terms with repeats, and per term its weight once the corpus is known."""

    def __init__(self, items: Iterable[tuple[object, bytes]]):
        self.ids, self.asked, numbers = [], [], {}
        for key, text in items:
            counts = Counter(terms(text))
            self.ids.append(key)
            self.asked.append([(numbers.setdefault(t, len(numbers)), n) for t, n in counts.items()])
        self.numbers = numbers
        self.n_docs = self.n_terms = 0
        self.weights: list[int] = []
        self.floors: list[int] = [1] * len(self.ids)

    def weigh(self, n_docs: int, n_terms: int, df: dict[int, int]) -> None:
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(self.numbers))]


def lengths(sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Every document's m, in whole numbers; by Python's where 64 bits could be too few."""
    if int(sizes.max()) * 75 * n_docs < 1 << 62:
        return 25 + (75 * n_docs * sizes) // n_terms
    return np.array([25 + (75 * n_docs * n) // n_terms for n in sizes.tolist()], np.int64)


class Shard:
    """The posting lists of a shard that a block of items touches, ready to be searched."""

    def __init__(self, row: dict[str, object], asked: Questions):
        vocabulary = zstandard.ZstdDecompressor().decompress(row["terms"]).split(b" ")
        touched = [(n, asked.numbers[t]) for n, t in enumerate(vocabulary) if t in asked.numbers]
        self.n_docs = row["n_docs"]
        if not touched:
            self.lists = {}
            return
        ends = np.cumsum(_unpacked(row["df"], np.uint32).astype(np.int64))
        begins = np.concatenate(([0], ends[:-1]))
        own = np.array([n for n, _ in touched])
        size = (ends - begins)[own]
        self.ends = np.cumsum(size)
        self.begins = self.ends - size
        at = np.repeat(begins[own] - self.begins, size) + np.arange(self.ends[-1])
        self.docs = _unpacked(row["docs"], np.uint16)[at].astype(np.int64)
        tf = _unpacked(row["tf"], np.uint32)[at].astype(np.int64)
        m = lengths(_unpacked(row["sizes"], np.int64), asked.n_docs, asked.n_terms)[self.docs]
        self.impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m)
        self.keys = np.repeat(np.arange(len(own)), size) * self.n_docs + self.docs
        self.lists = {term: n for n, (_, term) in enumerate(touched)}
        self.best = self.maxima(int(size.max()))

    def maxima(self, longest: int) -> np.ndarray:
        """Level k: the place of the first largest impact among 2**k postings from each place on.

        All lists lie behind one another; only look-ups inside one list are made.
        """
        levels = [np.arange(len(self.impact), dtype=np.int32)]
        step = 1
        while 2 * step <= longest:
            last, width = levels[-1], len(self.impact) - 2 * step + 1
            left, right = last[:width], last[step : step + width]
            level = last.copy()
            level[:width] = np.where(self.impact[left] >= self.impact[right], left, right)
            levels.append(level)
            step *= 2
        return np.stack(levels)

    def largest(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Places of the first largest impact in [begin, end), which must not be empty."""
        level = np.frexp(end - begin)[1] - 1
        left, right = self.best[level, begin], self.best[level, end - (1 << level)]
        return np.where(self.impact[left] >= self.impact[right], left, right)

    def search(self, asked: list[tuple[int, int]], weights: list[int], floor: int, k: int = TOP, batches: int | None = None) -> list[tuple[int, int]]:
        """(-score, document) of the best ``k`` documents whose score reaches ``floor``, equal ones by place; all searched if ``batches`` is None."""
        own = [(self.lists[t], weights[t] * n) for t, n in asked if t in self.lists and weights[t] > 0]
        if not own:
            return []
        lists, weight = (np.array(x, np.int64) for x in zip(*own, strict=True))
        base = lists * self.n_docs
        found: list[tuple[int, int]] = []
        worst = (1 - floor, -1)  # what a bound has to beat: the floor, later the k-th row

        def keep(scores: np.ndarray, docs: np.ndarray) -> None:
            nonlocal found, worst
            good = scores >= max(1, -worst[0])
            if good.any():
                found = sorted(found + list(zip((-scores[good]).tolist(), docs[good].tolist(), strict=True)))[:k]
                if len(found) == k:
                    worst = min(worst, found[-1])

        def bounds(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Contribution of each list's largest impact, and its place; nothing where a list has no posting."""
            held = end > begin
            place = np.zeros(begin.shape, np.int64)
            place[held] = self.largest(begin[held], end[held])
            return np.where(held, self.impact[place], 0) * weight, place

        queue: list[tuple[int, int, int]] = []
        first, _ = bounds(self.begins[lists][None, :], self.ends[lists][None, :])
        heappush(queue, (-int(first.sum()), 0, self.n_docs))
        while queue and (batches is None or batches > 0):
            taken = []
            while queue and len(taken) < BATCH and (queue[0][0], queue[0][1]) <= worst:
                taken.append(heappop(queue))
            if not taken:
                break
            batches = None if batches is None else batches - 1
            lo, hi = np.array([t[1] for t in taken]), np.array([t[2] for t in taken])
            begin = np.searchsorted(self.keys, base + lo[:, None])
            end = np.searchsorted(self.keys, base + hi[:, None])
            small = hi - lo <= LEAF
            if small.any():
                width = hi[small] - lo[small]
                offset = np.cumsum(width) - width
                size = (end[small] - begin[small]).ravel()
                at = np.repeat(begin[small].ravel() - (np.cumsum(size) - size), size) + np.arange(size.sum())
                row = np.repeat(np.repeat(np.arange(len(width)), len(lists)), size)
                scores = np.zeros(int(width.sum()), np.int64)
                np.add.at(scores, offset[row] + self.docs[at] - lo[small][row], self.impact[at] * np.repeat(np.tile(weight, len(width)), size))
                keep(scores, np.repeat(lo[small] - offset, width) + np.arange(len(scores)))
            if small.all():
                continue
            lo, hi, begin, end = lo[~small], hi[~small], begin[~small], end[~small]
            share, place = bounds(begin, end)
            split = self.docs[place[np.arange(len(lo)), share.argmax(axis=1)]]
            at = np.searchsorted(self.keys, base + split[:, None])
            inside = np.minimum(at, len(self.keys) - 1)
            met = (at < end) & (self.docs[inside] == split[:, None])
            keep((np.where(met, self.impact[inside], 0) * weight).sum(axis=1), split)
            for low, high, b, e in ((lo, split, begin, at), (split + 1, hi, at + met, end)):
                bound = bounds(b, e)[0].sum(axis=1)
                for top, x, y in zip((-bound).tolist(), low.tolist(), high.tolist(), strict=True):
                    if top < 0 and x < y and (top, x) <= worst:
                        heappush(queue, (top, x, y))
        return found


def _best(shards: DataFrame, asked: Broadcast, k: int, batches: int | None) -> DataFrame:
    """(item, doc_id, score) of every shard's best rows for every item of the block."""
    kind = shards.schema["ids"].dataType.elementType
    out = schema(item="long", doc_id=kind, score="long")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for i in range(batch.num_rows):
                row = {c: batch.column(n)[i].as_py() for n, c in enumerate(batch.schema.names) if c != "ids"}
                block = asked.value
                shard = Shard(row, block)
                items, docs, scores = [], [], []
                if shard.lists:
                    for item, wanted in enumerate(block.asked):
                        for low, doc in shard.search(wanted, block.weights, block.floors[item], k, batches):
                            items.append(item)
                            docs.append(doc)
                            scores.append(-low)
                ids = batch.column("ids")[i].values.take(pa.array(docs, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), ids, pa.array(scores, pa.int64())], out.names)

    return shards.select("ids", "n_docs", "n_terms", "sizes", "terms", "df", "docs", "tf").mapInArrow(run, out)


def _counts(shards: DataFrame, asked: Broadcast) -> dict[int, int]:
    """How many documents hold each term of the block."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[int] = Counter()
        numbers = asked.value.numbers
        for batch in parts:
            for names, sizes in zip(batch.column(0), batch.column(1), strict=True):
                df = _unpacked(sizes.as_py(), np.uint32)
                for n, t in enumerate(zstandard.ZstdDecompressor().decompress(names.as_py()).split(b" ")):
                    if t in numbers:
                        total[numbers[t]] += int(df[n])
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["term", "n"])

    found = shards.select("terms", "df").mapInArrow(run, schema(term="long", n="long"))
    return {r.term: r.n for r in found.groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator()}


def blocks(items: DataFrame, item_id: str, text: str, limit: int = ITEM_BYTES) -> Iterator[Questions]:
    """The items in blocks of at most ``limit`` bytes of text, one at a time in the driver."""
    part, size = [], 0
    for row in items.select(F.col(item_id), as_bytes(text)).toLocalIterator():
        if part and size + len(row[1]) > limit:
            yield Questions(part)
            part, size = [], 0
        part.append((row[0], bytes(row[1])))
        size += len(row[1]) + 64
    if part:
        yield Questions(part)


def search(shards: DataFrame, items: DataFrame, k: int = TOP, item_id: str = "item_id", text: str = "text", limit: int = ITEM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``k`` best documents per row of ``items``, scores above 0; equal scores by doc_id, nulls last.

    ``shards`` is a stored :func:`index`. Items without terms find nothing; items that repeat are answered each.
    A block of items reads the index three times, whatever their number.
    """
    spark = shards.sparkSession
    out = schema(item_id=kind_of(items, item_id), rank="int", doc_id=shards.schema["ids"].dataType.elementType, score="long")
    whole = shards.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    total = spark.createDataFrame([], out)
    if not whole[0]:
        return total
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    best = Window.partitionBy("item").orderBy(*order)
    for block in blocks(items, item_id, text, limit):
        asked = spark.sparkContext.broadcast(block)
        block.weigh(*whole, _counts(shards, asked))
        asked.unpersist()
        asked = spark.sparkContext.broadcast(block)
        probed = _best(shards, asked, k, PROBE).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") == k)
        for row in probed.select("item", "score").toLocalIterator():
            block.floors[row.item] = row.score
        asked.unpersist()
        asked = spark.sparkContext.broadcast(block)
        ids = spark.createDataFrame([(n, i) for n, i in enumerate(block.ids)], schema(item="long", item_id=kind_of(items, item_id)))
        found = written(_best(shards, asked, k, None).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k))
        asked.unpersist()
        total = total.union(found.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score"))
    return total


def op13_lexical(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's rows: the ten best documents per benchmark item.

    Null and empty texts have no terms: such documents are not counted and such items find nothing. Every row is a document or an item of
    its own, repeated ones too. Null document ids come last among equal scores. Without documents or items there are no rows.
    """
    return search(written(index(docs)), benchmark)


ORACLE_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row_no, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), tokens AS (
    SELECT row_no, unnest(terms) AS term FROM docs
), tf AS (
    SELECT row_no, term, count(*) AS tf FROM tokens GROUP BY ALL
), df AS (
    SELECT term, count(*) AS df FROM tf GROUP BY term
), whole AS (
    SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM docs WHERE len(terms) > 0
), asked AS (
    SELECT item_no, item_id, unnest(terms) AS term FROM (
        SELECT row_number() OVER () AS item_no, item_id,
            regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM benchmark)
), weighed AS (
    SELECT item_no, item_id, term, count(*) AS n, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
    FROM asked JOIN df USING (term) CROSS JOIN whole GROUP BY item_no, item_id, term, n_docs, df
), sized AS (
    SELECT row_no, doc_id, 25 + (75 * len(terms) * n_docs) // n_terms AS m FROM docs CROSS JOIN whole WHERE len(terms) > 0
), scored AS (
    SELECT item_no, item_id, row_no, doc_id, sum(n * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM weighed JOIN tf USING (term) JOIN sized USING (row_no) GROUP BY ALL
)
SELECT item_id, (row_number() OVER (PARTITION BY item_no ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
"""

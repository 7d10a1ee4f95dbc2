"""Pairs of texts that are alike by their shingles, found by shared rare shingles.

Two texts alike by ``similarity`` share a feature (a shingle, its n-th repeat a feature of its own) among the first of each, if both
are put in one order: at most the share that may differ comes before it. Rare features come first, counted over all
tasks. Of each text these first features are sent, with the feature's place and the text's size; texts that share one are held against
one another, if their sizes and the places allow for enough shared features, and then if their bitmaps do: a text of n features has a
parity bitmap of about n bits, and each differing bit is a feature that is not shared. Only pairs that pass all this are compared
in full, so few texts travel.

Who is held against whom goes by rounds of leaders. The leaders of a feature are the texts where it comes first, that is those
with the fewest features of their own; one in the first round, eight times as many in each later one. A feature is done once all its
texts are connected or no text is left that could lead: in every pair that is alike, the smaller text has the first shared feature
among its first ninth. So a large group of copies costs its size, and no pair is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crownledger.llm.components import components, merged, rooted
from crownledger.llm.text import as_bytes, schema
from crownledger.sources.scratch import written

SEED = 42
WIDTH = 5  # words of a shingle
CELLS = 1 << 22  # counters of features in a task
FREQUENT_CELLS = 1 << 18  # cells that are broadcast, at most
BITMAP_BITS = (64, 1 << 14)  # of a text's bitmap, least and most
SHARD_BYTES = 8 << 20  # of text, whose entries are one shuffle partition
HELD = 1 << 17  # entries that a task holds before it sends them
MORE_LEADERS = 8  # times as many leaders in each round
ENTRY = np.dtype([("feature", "<u8"), ("text_id", "<i8"), ("n", "<u4"), ("at", "<u4")])


def features(text: bytes, width: int = WIDTH) -> np.ndarray:
    """A hash per shingle; the n-th repeat of a shingle is a feature of its own. A text shorter than a shingle is one."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashed = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in words), np.uint64, len(words))
    k = min(width, len(words))
    n = len(words) - k + 1
    own = np.full(n, k, np.uint64)
    for i in range(k):
        own = (own ^ hashed[i : i + n]) * np.uint64(0xBF58476D1CE4E5B9)
        own ^= own >> np.uint64(29)
    own.sort()
    begins = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
    nth = np.arange(n) - np.repeat(begins, np.diff(np.append(begins, n)))
    own = (own ^ (nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0x94D049BB133111EB)
    return own ^ (own >> np.uint64(31))


def similarity_of(a: np.ndarray, b: np.ndarray) -> float:
    """Shared over all features; two texts without words are equal."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    total = len(a) + len(b) - shared
    return shared / total if total else 1.0


def similar(a: bytes, b: bytes, width: int = WIDTH) -> float:
    return similarity_of(features(a, width), features(b, width))


def bitmap(own: np.ndarray) -> bytes:
    """Parities of the features by their low bits, about one bit per feature."""
    size = min(max(BITMAP_BITS[0], 1 << max(0, len(own) - 1).bit_length()), BITMAP_BITS[1])
    return np.packbits(np.bincount((own % np.uint64(size)).astype(np.int64), minlength=size) & 1).tobytes()


def most_shared(n_a: int, a: bytes, n_b: int, b: bytes) -> int:
    """How many features two texts may share at most; the larger bitmap is folded to the smaller one's size."""
    x, y = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return (n_a + n_b - int(np.bitwise_count(x ^ y).sum())) // 2


def frequent_cells(docs: DataFrame, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Cells of features that are frequent in the corpus, and how frequent they are; bounded, in order of cells.

    They only order the features, see :func:`prefix`; any order finds the same pairs, and a good one few others. A task leaves
    out cells that it met once or that are no more frequent than most of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.uint32)
        for batch in batches:
            for value in batch.column(0):
                cells, n = np.unique(features(value.as_py()) % np.uint64(CELLS), return_counts=True)
                total[cells] += n.astype(np.uint32)
        often = np.flatnonzero(total >= max(2, 4 * total.mean()))
        for i in range(0, len(often), 1 << 16):
            part = often[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part].astype(np.int64))], ["cell", "n"])

    counted = docs.select(as_bytes(text).alias("text")).mapInArrow(run, schema(cell="long", n="long"))
    table = counted.groupBy("cell").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "cell").limit(FREQUENT_CELLS).toArrow()
    cells, n = (table[c].to_numpy().astype(np.int64) for c in ("cell", "n"))
    order = np.argsort(cells)
    return cells[order], n[order]


def prefix(own: np.ndarray, cells: np.ndarray, n: np.ndarray, similarity: float) -> np.ndarray:
    """The first features of a text, rare ones first: so many that two texts as alike as ``similarity`` share one.

    Such texts share at least ``similarity`` times the features of either, so at most the others can come before the
    first that they share.
    """
    most = len(own) - ceil(similarity * len(own) - 1e-9) + 1
    if len(cells):
        cell = (own % np.uint64(CELLS)).astype(np.int64)
        at = np.minimum(np.searchsorted(cells, cell), len(cells) - 1)
        weight = np.where(cells[at] == cell, n[at], 0)
    else:
        weight = np.zeros(len(own), np.int64)
    return own[np.lexsort((own, weight))[:most]]


def needed(similarity: float, n_a: Column, n_b: Column) -> Column:
    """How many features two texts of these sizes share at least if they are alike."""
    return F.ceil((n_a + n_b) * (similarity / (1 + similarity)) - 1e-6)


def shared_features(docs: DataFrame, text: str, similarity: float) -> DataFrame:
    """(feature, text_id, n, at): the features that the prefixes of several distinct texts have in common, the texts' sizes and the features' places."""
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_cells(docs, text))
    rows = docs.select(F.xxhash64(as_bytes(text)).alias("text_id"), as_bytes(text).alias("text"))
    size = docs.select(F.sum(F.octet_length(as_bytes(text)))).first()[0] or 0
    shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), ceil(size / SHARD_BYTES))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, counts = frequent.value
        seen: set[int] = set()  # copies in one task are sent once
        held: list[np.ndarray] = []

        def packed() -> pa.RecordBatch:
            entry = np.concatenate(held) if held else np.empty(0, ENTRY)
            held.clear()
            shard = entry["feature"] % np.uint64(shards)
            order = np.argsort(shard, kind="stable")
            entry = entry[order]
            found, begin = np.unique(shard[order], return_index=True)
            parts = [part.tobytes() for part in np.split(entry, begin[1:])] if len(found) else []
            return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(parts, pa.binary())], ["shard", "entries"])

        waiting = 0
        for batch in batches:
            for text_id, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if text_id in seen:
                    continue
                seen = seen if len(seen) < HELD else set()
                seen.add(text_id)
                own = features(value.as_py())
                first = prefix(own, cells, counts, similarity)
                entry = np.empty(len(first), ENTRY)
                entry["feature"], entry["text_id"], entry["n"], entry["at"] = first, text_id, len(own), np.arange(len(first))
                held.append(entry)
                waiting += len(first)
                if waiting >= HELD:
                    yield packed()
                    waiting = 0
        yield packed()

    names = ["feature", "text_id", "n", "at"]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.frombuffer(x.as_py(), ENTRY) for b in batches for x in b.column(0)]
        entry = np.concatenate(parts) if parts else np.empty(0, ENTRY)
        entry = entry[np.lexsort((entry["text_id"], entry["feature"]))]
        feature, text_id = entry["feature"], entry["text_id"]
        fresh = np.ones(len(entry), bool)  # the same text comes from several tasks
        fresh[1:] = (feature[1:] != feature[:-1]) | (text_id[1:] != text_id[:-1])
        entry = entry[fresh]
        same = entry["feature"][1:] == entry["feature"][:-1]
        met = entry[np.append(same, False) | np.insert(same, 0, False)] if len(entry) else entry
        for i in range(0, len(met), 1 << 16):
            part = met[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part[c].astype(np.int64)) for c in names], names)

    emitted = rows.mapInArrow(emit, schema(shard="long", entries="binary"))
    return emitted.repartitionById(shards, F.col("shard").cast("int")).select("entries").mapInArrow(meet, schema(**dict.fromkeys(names, "long")))


def possible(pairs: DataFrame, bits: DataFrame, similarity: float) -> DataFrame:
    """The rows (a, b, n_a, n_b, fp_a, fp_b) whose bitmaps allow for enough shared features, with the most that they allow."""
    names = ["a", "b", "fp_a", "fp_b"]
    both = pairs.join(bits.withColumnsRenamed({"text_id": "a", "bits": "bits_a"}), "a").join(bits.withColumnsRenamed({"text_id": "b", "bits": "bits_b"}), "b")
    least = needed(similarity, F.col("n_a"), F.col("n_b")).cast("long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b, least, a, b = (batch.column(i).to_pylist() for i in range(4, 9))
            most = [most_shared(*x) for x in zip(n_a, a, n_b, b, strict=True)]
            share = pa.array([m / (x + y - m) if x + y > m else 1.0 for m, x, y in zip(most, n_a, n_b, strict=True)], pa.float64())
            passed = pa.array([m >= x for m, x in zip(most, least, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], share], [*names, "share"]).filter(passed)

    return both.select(*names, "n_a", "n_b", least.alias("least"), "bits_a", "bits_b").mapInArrow(run, schema(**dict.fromkeys(names, "long"), share="double"))


def verified(pairs: DataFrame, docs: DataFrame, text: str, similarity: float) -> DataFrame:
    """The rows (a, b, fp_a, fp_b) of ``pairs`` whose texts a and b are alike. Each text is fetched once and packed."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("text_id")).distinct()
    texts = docs.select(F.xxhash64(as_bytes(text)).alias("text_id"), as_bytes(text).alias("text"))
    texts = texts.join(ids, "text_id", "left_semi").select("text_id", "text")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([packer.compress(t.as_py()) for t in batch.column(1)], pa.binary())], batch.schema.names)

    texts = written(texts.mapInArrow(pack, schema(text_id="long", text="binary")).dropDuplicates(["text_id"]))
    both = pairs.join(texts.withColumnsRenamed({"text_id": "a", "text": "text_a"}), "a").join(
        texts.withColumnsRenamed({"text_id": "b", "text": "text_b"}), "b"
    )
    names = ["a", "b", "fp_a", "fp_b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        last: dict[int, np.ndarray] = {}  # leaders come again and again
        for batch in batches:
            alike = []
            for b, x, y in zip(batch.column(1).to_pylist(), batch.column(4), batch.column(5), strict=True):
                if b not in last:
                    last = {} if len(last) >= 64 else last
                    last[b] = features(unpack(y.as_py()))
                alike.append(similarity_of(features(unpack(x.as_py())), last[b]) >= similarity)
            yield batch.select(names).filter(pa.array(alike, pa.bool_()))

    return both.select(*names, "text_a", "text_b").mapInArrow(run, schema(**dict.fromkeys(names, "long")))


def alike_roots(docs: DataFrame, found: DataFrame, distinct: DataFrame, text: str, similarity: float) -> DataFrame:
    """(node, root) of the fingerprints that the links ``found`` and all texts alike by ``similarity`` connect, as of :func:`components`.

    ``distinct``: (text_id, fp, bits) of all distinct texts. Texts without words are left to their common fingerprint.
    """
    roots = components(found)
    member = written(shared_features(docs, text, similarity).join(distinct.select("text_id", "fp"), "text_id"))
    bits = distinct.select("text_id", "bits")
    # the smaller of two alike texts has the first shared feature here
    heads = F.col("at") <= F.col("n") * (1 - 2 * similarity / (1 + similarity)) + 1e-6
    low, high = 0, 1
    tested: DataFrame | None = None
    while True:
        member = rooted(member.withColumn("root", F.col("fp")), roots, "root")
        counts = member.groupBy("feature").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count_if(heads).alias("heads"))
        still = counts.filter((F.col("least") != F.col("most")) & (F.col("heads") > low)).select("feature")
        member = written(member.join(still, "feature", "left_semi"))
        if not member.head(1):
            return roots
        first = Window.partitionBy("feature").orderBy(F.col("at"), F.col("text_id"))
        leaders = member.filter(heads).withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= high).filter(F.col("rank") > low).drop("rank")
        a, b = (x.select("feature", *[F.col(c).alias(f"{c}_{end}") for c in ("text_id", "n", "at", "fp", "root")]) for x, end in ((member, "a"), (leaders, "b")))
        fits = F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * (similarity - 1e-9)
        fits &= 1 + F.least(F.col("n_a") - F.col("at_a") - 1, F.col("n_b") - F.col("at_b") - 1) >= needed(similarity, F.col("n_a"), F.col("n_b"))
        met = a.join(b, "feature").filter((F.col("root_a") != F.col("root_b")) & fits)
        pairs = met.select(F.col("text_id_a").alias("a"), F.col("text_id_b").alias("b"), "n_a", "n_b", "fp_a", "fp_b", "root_a", "root_b").distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs)
        if not pairs.head(1):
            low, high = high, high * MORE_LEADERS
            continue
        tested = pairs.select("a", "b") if tested is None else tested.union(pairs.select("a", "b"))
        passed = written(possible(pairs, bits, similarity))
        # first every text against the leader that its bitmap is nearest to, then what is still apart
        nearest = written(passed.groupBy("a").agg(F.max_by(F.struct("b", "fp_a", "fp_b"), F.struct("share", "b")).alias("to")).select("a", "to.*"))
        alike = written(verified(nearest, docs, text, similarity)).select(F.col("fp_a").alias("a"), F.col("fp_b").alias("b"))
        roots = merged(roots, alike)
        rest = passed.join(nearest.select("a", "b"), ["a", "b"], "left_anti")
        rest = rooted(rest.withColumns({"root_a": F.col("fp_a"), "root_b": F.col("fp_b")}), roots, "root_a", "root_b")
        rest = written(rest.filter("root_a != root_b").select("a", "b", "fp_a", "fp_b"))
        if rest.head(1):
            roots = merged(roots, written(verified(rest, docs, text, similarity)).select(F.col("fp_a").alias("a"), F.col("fp_b").alias("b")))
        low, high = high, high * MORE_LEADERS

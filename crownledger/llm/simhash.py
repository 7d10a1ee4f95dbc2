"""Near-duplicates by SimHash and meet-in-the-middle ball hashing.

Two fingerprints at most ``2 * half`` bits apart have a common variant at most ``half`` bits from either. So every
distinct fingerprint emits all its variants within half the radius, and those that meet in a variant are
linked. The variants are emitted in two steps: flips in the leading bits before the shuffle, whose key they
change, and flips in the rest after it. Both together are the whole ball, but a fingerprint
travels only once per key (137 times for radius 4 and 16 leading bits, instead of 2,081). Keys under which too many variants
would meet are counted first; there the next 16 bits are flipped before the shuffle, too, and the 16 after these if need be.

All that meet in one variant lie within the radius of one another, so that links to the smallest of them keep
components whole without pairs; each link is verified by its bits.

A fingerprint of shingles is within 4 bits for few pairs that are only four fifths alike. To deduplicate, documents are
therefore also held against one another by their shingles, see :mod:`crownledger.llm.likeness`.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil, comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crownledger.llm.components import components
from crownledger.llm.likeness import alike_roots, bitmap, features
from crownledger.llm.text import as_bytes, kind_of, schema, whole_row
from crownledger.sources.scratch import written

SEED = 42
DEPTHS = (16, 32, 48)  # leading bits that are a shuffle key, at first and where too many would meet
HOT_VARIANTS = 1 << 20  # more than these under one key are split
HOT_KEYS = 1 << 17  # keys of one depth that are split, at most; they are broadcast
SHARD_BYTES = 4 << 20  # of (key, fingerprint) entries in one shuffle partition
CHUNK = 1 << 18  # variants that a task holds at once, and those of one key
SLICE = 1 << 14  # variants that are looked up at once
EMITTED = 1 << 10  # fingerprints that are put under their keys at once
SIMILARITY = 0.8  # of five-word shingles


def fingerprint(text: bytes, width: int) -> int:
    """64 bits: a bit is set if it is set in over half of the hashes of the text's ``width``-word shingles."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - width + 1)
    last = ends[width - 1 :] if len(words) >= width else ends[-1:]
    hashed = (xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True))
    bits = np.unpackbits(np.fromiter(hashed, ">u8", n).view(np.uint8).reshape(n, 8), axis=1)
    return int.from_bytes(np.packbits(bits.sum(axis=0, dtype=np.int64) * 2 > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, key: Column, text: str = "text", width: int = 4, bitmaps: bool = False) -> DataFrame:
    """(key, text_id, fp) for every row; fp is the fingerprint as a signed long, zero for a text without words.

    With ``bitmaps`` also ``bits``, the :func:`~crownledger.llm.likeness.bitmap` of the text's five-word shingles.
    """
    rows = docs.select(key.alias("key"), as_bytes(text).alias("text"), F.xxhash64(as_bytes(text)).alias("text_id"))
    out = schema(key=kind_of(rows, "key"), text_id="long", fp="long", **({"bits": "binary"} if bitmaps else {}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(0), batch.column(2), pa.array([fingerprint(t.as_py(), width) for t in batch.column(1)], pa.int64())]
            if bitmaps:
                columns.append(pa.array([bitmap(features(t.as_py())) for t in batch.column(1)], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, out.names)

    return rows.mapInArrow(run, out)


def flips(first: int, bits: int, most: int) -> dict[int, np.ndarray]:
    """Masks that flip 0, 1, ... ``most`` of the ``bits`` bits from ``first`` on, by number of flips."""
    return {
        n: np.array([sum(1 << b for b in c) for c in combinations(range(first, first + bits), n)], np.uint64)
        for n in range(most + 1)
    }


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node it is connected with) that connect what the links (a, b) connect."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    left, right, root = ends[: len(a)], ends[len(a) :], np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        for side in (left, right):
            np.minimum.at(new, root[side], low)
            np.minimum.at(new, side, low)
        new = new[new]
        if np.array_equal(new, root):
            own = root != np.arange(len(nodes))
            return nodes[own], nodes[root[own]]
        root = new


def ball(bits: int, most: int) -> int:
    """Number of masks of so many bits with at most ``most`` of them set."""
    return sum(comb(bits, i) for i in range(most + 1))


def meetings(keys: np.ndarray, fps: np.ndarray, depth: int, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) of the fingerprints that have a variant with one of ``keys`` as its ``depth`` leading bits in common; b is the smallest."""
    rest = flips(0, 64 - depth, half)
    low = np.uint64((1 << (64 - depth)) - 1)
    used = np.bitwise_count((keys ^ fps) & ~low)
    own, rank = np.unique(fps, return_inverse=True)  # a smaller rank is a smaller fingerprint
    rank = rank.astype(np.uint32)
    spheres = []  # ranks of owners, their flipped heads, masks for the rest; in slices, so that only the variants are ever held whole
    for spent in range(half + 1):
        at = np.flatnonzero(used == spent)
        base = (keys[at] & ~low) | (fps[at] & low)
        for masks in (rest[n] for n in range(half - spent + 1)):
            step = max(1, SLICE // len(masks))
            spheres += [(rank[at[i : i + step]], base[i : i + step], masks) for i in range(0, len(at), step)]
    variants, filled = np.empty(sum(len(base) * len(masks) for _, base, masks in spheres), np.uint64), 0
    for _, base, masks in spheres:
        part = variants[filled : filled + len(base) * len(masks)]
        np.bitwise_xor(base[:, None], masks[None, :], out=part.reshape(len(base), len(masks)))
        filled += len(part)
    variants.sort()
    met = np.unique(variants[1:][variants[1:] == variants[:-1]])
    del variants
    if not len(met):
        return met, met
    least, found = np.full(len(met), len(own), np.uint32), []
    for owner, base, masks in spheres:  # made once more, so that owners need not be kept for all of them
        variant = (base[:, None] ^ masks[None, :]).ravel()
        at = np.minimum(np.searchsorted(met, variant), len(met) - 1)
        hit = np.flatnonzero(met[at] == variant)
        at, owner = at[hit].astype(np.uint32), owner[hit // len(masks)]
        np.minimum.at(least, at, owner)
        found.append((at, owner))
    n = np.uint64(len(own))
    pairs = np.unique(np.concatenate([np.unique(owner * n + least[at]) for at, owner in found]))
    a, b = own[pairs // n], own[pairs % n]
    near = (a != b) & (np.bitwise_count(a ^ b) <= 2 * half)
    return a[near], b[near]


def keyed(own: np.ndarray, half: int, hot: dict[int, np.ndarray], upto: int = DEPTHS[-1]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(depth, keys, fingerprints): every fingerprint under all keys that its variants have, at the first depth where they are not hot.

    Keys are the leading bits of a variant, in their place. ``upto`` ends the splitting.
    """
    step = DEPTHS[0]
    keys, fps, spent = own, own, np.zeros(len(own), np.int64)
    for depth in DEPTHS:
        low = np.uint64((1 << (64 - depth)) - 1)
        made = []
        for n, masks in flips(64 - depth, step, half).items():
            at = np.flatnonzero(spent + n <= half)
            made.append(((keys[at][:, None] ^ masks[None, :]).ravel(), np.repeat(fps[at], len(masks)), np.repeat(spent[at] + n, len(masks))))
        keys, fps, spent = (np.concatenate(x) for x in zip(*made, strict=True))
        split = np.zeros(len(keys), bool) if depth == upto or not len(hot.get(depth, ())) else np.isin(keys & ~low, hot[depth])
        yield depth, keys[~split] & ~low, fps[~split]
        keys, fps, spent = keys[split], fps[split], spent[split]
        if not len(keys):
            return


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each key. Keys differ in their leading bits, which are mixed into all others: any number of shards gets equal shares."""
    mixed = keys
    for _ in range(2):
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed ^ (mixed >> np.uint64(32))) % np.uint64(shards)


def hot_keys(fps: DataFrame, half: int) -> dict[int, np.ndarray]:
    """The keys of each depth under which more than ``HOT_VARIANTS`` variants meet: counted over all fingerprints, and bounded in number."""
    hot: dict[int, np.ndarray] = {}
    for depth in DEPTHS[:-1]:
        known = dict(hot)
        sizes = np.array([ball(64 - depth, half - n) for n in range(half + 1)])
        low = np.uint64((1 << (64 - depth)) - 1)

        def count(batches: Iterator[pa.RecordBatch], known=known, depth=depth, sizes=sizes, low=low) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                for i in range(0, len(own), 4096):
                    for found, keys, fp in keyed(own[i : i + 4096], half, known, depth):
                        if found == depth and len(keys):
                            kinds, at = np.unique(keys, return_inverse=True)
                            n = np.bincount(at, sizes[np.bitwise_count((keys ^ fp) & ~low)])
                            yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(n.astype(np.int64))], ["key", "n"])

        counted = fps.select("fp").mapInArrow(count, schema(key="long", n="long")).groupBy("key").agg(F.sum("n").alias("n"))
        many = counted.filter(F.col("n") > HOT_VARIANTS).orderBy(F.desc("n"), "key").limit(HOT_KEYS).select("key").toArrow()["key"].to_numpy()
        if not len(many):
            break
        hot[depth] = np.sort(many.astype(np.int64).view(np.uint64))
    return hot


def links(fps: DataFrame, radius: int = 4) -> DataFrame:
    """Links (a, b) that connect all distinct ``fp`` at most ``radius`` bits apart.

    Not every such pair is a row, but its two ends are always connected. An odd
    radius is refused, since each end takes half of the flips; ``radius`` 0 has no links.
    """
    if radius % 2 or radius < 0:
        raise ValueError("the radius must be even: each end takes half of the flips")
    half = radius // 2
    shards = ceil(fps.count() * ball(DEPTHS[0], half) * 16 / SHARD_BYTES)
    shards = max(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), shards)
    hot = fps.sparkSession.sparkContext.broadcast(hot_keys(fps, half))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for i in range(0, len(own), EMITTED):
                for depth, key, fp in keyed(own[i : i + EMITTED], half, hot.value):
                    shard = shard_of(key | np.uint64(depth), shards)
                    order = np.argsort(shard, kind="stable")
                    shard, entry = shard[order], np.stack((key | np.uint64(depth), fp), axis=1)[order]  # the key's low bits are free
                    found, begin = np.unique(shard, return_index=True)
                    packed = [part.tobytes() for part in np.split(entry, begin[1:])] if len(found) else []
                    yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(packed, pa.binary())], ["shard", "entries"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.frombuffer(x.as_py(), np.uint64).reshape(-1, 2) for b in batches for x in b.column(0)]
        entries = np.concatenate(parts) if parts else np.empty((0, 2), np.uint64)
        del parts
        tags = entries[:, 0] & np.uint64((1 << (64 - DEPTHS[-1])) - 1)
        for depth in DEPTHS:
            entry = entries[tags == depth]
            entry = entry[np.argsort(entry[:, 0], kind="stable")]
            key, fp = entry[:, 0] ^ np.uint64(depth), entry[:, 1]
            # whole keys per chunk, of about CHUNK variants; a fingerprint's own key has the most
            sizes = np.array([ball(64 - depth, half - n) for n in range(half + 1)])
            made = np.cumsum(sizes[np.bitwise_count((key ^ fp) & ~np.uint64((1 << (64 - depth)) - 1))]) if len(key) else key
            cuts = [0]
            for s in (np.flatnonzero(key[1:] != key[:-1]) + 1).tolist():
                if made[s - 1] - (made[cuts[-1] - 1] if cuts[-1] else 0) >= CHUNK:
                    cuts.append(s)
            for i, j in zip(cuts, [*cuts[1:], len(key)], strict=True):
                a, b = forest(*meetings(key[i:j], fp[i:j], depth, half))
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    emitted = fps.select("fp").mapInArrow(emit, schema(shard="long", entries="binary"))
    dealt = emitted.repartitionById(shards, F.col("shard").cast("int")).select("entries")
    return dealt.mapInArrow(meet, schema(a="long", b="long"))


def near_duplicates(
    docs: DataFrame, key: Column, text: str = "text", width: int = 4, radius: int = 4,
    similarity: float | None = None,
) -> DataFrame:
    """(key, fp, component) for every row of ``docs``: the smallest key of its group of near-duplicates.

    Groups are the connected components of "at most ``radius`` bits apart"; with ``similarity`` also of documents that are
    at least so alike by five-word shingles. Null and empty texts have the
    fingerprint zero and are linked like any other. A row without a key gets its group's smallest
    key, or null if the group has none. Repeated rows give repeated results; an empty table gives none.

    A large group of copies is one distinct fingerprint with its smallest key, made by a partial aggregate; only
    the last join meets its rows, on narrow rows whose hot key adaptive execution splits.
    """
    marked = written(fingerprints(docs, key, text, width, bool(similarity)))
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key")).alias("first")
    distinct = written(marked.groupBy("fp").agg(first).select("fp", F.col("first.key").alias("first")))
    found = links(distinct, radius)
    if similarity:
        texts = written(marked.groupBy("text_id").agg(F.first("fp").alias("fp"), F.first("bits").alias("bits")))
        roots = alike_roots(docs, written(found), texts, text, similarity)
    else:
        roots = components(found)
    placed = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("first").alias("component"))
    grouped = written(placed.join(least, "root").select("fp", "component"))
    return marked.select("key", "fp").join(grouped, "fp").select("key", "fp", "component")


def op10_simhash(docs: DataFrame) -> DataFrame:
    """The contract's columns: doc_id, fingerprint in hex, component_id."""
    return near_duplicates(docs, F.col("doc_id")).select(
        F.col("key").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def dedup(docs: DataFrame, width: int = 4, radius: int = 4, similarity: float | None = SIMILARITY) -> DataFrame:
    """One document of each group of near-duplicates, with all its columns: the one with the smallest doc_id.

    Groups are those of :func:`near_duplicates`, by fingerprint and, unless ``similarity`` is None, by likeness. Rows are
    told apart by doc_id and text; null ids come last, and of rows that agree in both one stays.
    """
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("hash"))
    groups = near_duplicates(docs, own, width=width, radius=radius, similarity=similarity)
    keep = groups.filter(F.col("key") == F.col("component")).select(F.col("key").alias("__row")).distinct()
    rows = docs.select(own.alias("__row"), whole_row(docs))
    return rows.join(keep, "__row", "left_semi").dropDuplicates(["__row"]).select("row.*")

"""Benchmark decontamination: SimHash of item-sized windows, a multi-index of blocks, exact verification.

A document holds a benchmark item if one of its windows of as many words as the item is alike in five-word shingles,
counted with repeats: shared over all at least 0.8. Words are runs of letters, digits and non-ASCII
bytes, A-Z lower-cased, so that case, punctuation and line breaks do not hide a passage.

* A window that is so alike shares a shingle with the item. Windows without a shingle of any item of their size are
  passed over; that drops no match and saves the windows of clean text.
* All other windows get a 64-bit SimHash of their shingles, by running sums of bits over the document.
* Fingerprints within ``RADIUS`` bits of an item's agree with it up to ``RADIUS // BLOCKS`` bits in one of ``BLOCKS``
  blocks. A table per block lists the items for every value that near; no window within the radius is lost.
* Candidates are verified with the words themselves.

At a similarity of 0.8 about 10 of 64 bits differ (standard deviation 2.9); the radius of 20 leaves out
fewer than one such window in a thousand, and neighbouring windows get chances of their own.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crownledger.llm.text import as_bytes, kind_of, schema, whole_row

WIDTH = 5  # words in a shingle
SIMILARITY = 0.8
RADIUS = 20
BLOCKS = 7
ITEM_BYTES = 4 << 20  # benchmark text that one index holds; more items make more indexes
WINDOWS = 1 << 16  # windows that a task fingerprints at once

_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers, so that each bit of the result depends on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, as many as the longest text needed so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            step = np.full(size, _BASE)
            step[0] = 1
            self.up = np.cumprod(step)
            step[1:] = _BACK
            self.down = np.cumprod(step)
        return self.up[:n], self.down[:n]


def shingles(text: bytes, powers: Powers) -> np.ndarray:
    """The hash of every five-word shingle of a text, by its first word; none if there are fewer words."""
    data = np.frombuffer(text.translate(_FOLD), np.uint8)
    inside = np.concatenate(([False], data != 32, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if len(starts) < WIDTH:
        return np.empty(0, np.uint64)
    up, down = powers.of(len(data))
    total = np.concatenate(([np.uint64(0)], np.cumsum(data * up)))
    word = _mixed((total[ends] - total[starts]) * down[starts])
    n = len(word) - WIDTH + 1
    out = np.zeros(n, np.uint64)
    for i in range(WIDTH):
        out = out * _BASE + word[i : i + n]
    return _mixed(out)


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


def simhash(hashes: np.ndarray) -> int:
    return int(np.packbits(_bits(hashes).sum(axis=0, dtype=np.int64) * 2 > len(hashes)).view(">u8")[0])


def window_simhashes(hashes: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """The fingerprint of the ``n`` shingles from each of ``starts`` on, fewer at the end of the text."""
    out = []
    for i in range(0, len(starts), WINDOWS):
        own = starts[i : i + WINDOWS]
        first, last = int(own[0]), min(int(own[-1]) + n, len(hashes))
        sums = np.zeros((last - first + 1, 64), np.int32)
        np.cumsum(_bits(hashes[first:last]), axis=0, out=sums[1:])
        stop = np.minimum(own + n, len(hashes))
        over = (sums[stop - first] - sums[own - first]) * 2 > (stop - own)[:, None]
        out.append(np.packbits(over, axis=1).view(">u8").ravel().astype(np.uint64))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


@dataclass
class Size:
    """The items of one number of words: their fingerprints, and per block the items near each value."""

    n_words: int
    items: np.ndarray
    prints: np.ndarray
    near: list[tuple[np.ndarray, np.ndarray]]

    def candidates(self, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) positions of all pairs within the radius."""
        found = []
        for block, (offset, listed) in enumerate(self.near):
            value = _block(prints, block)
            count = offset[value + 1] - offset[value]
            window = np.repeat(np.arange(len(prints)), count)
            at = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count) + offset[value][window]
            item = listed[at]
            close = np.bitwise_count(prints[window] ^ self.prints[item]) <= radius
            found.append(np.stack((window[close], item[close])))
        pairs = np.unique(np.concatenate(found, axis=1), axis=1)
        return pairs[0], pairs[1]


def _block(prints: np.ndarray, block: int) -> np.ndarray:
    """The value of one of ``BLOCKS`` runs of bits, about equally long."""
    first, last = 64 * block // BLOCKS, 64 * (block + 1) // BLOCKS
    return ((prints >> np.uint64(first)) & np.uint64((1 << (last - first)) - 1)).astype(np.int64)


def _near(prints: np.ndarray, block: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Per value of a block, the items within the block's share of the radius: (offsets, items)."""
    width = 64 * (block + 1) // BLOCKS - 64 * block // BLOCKS
    masks = np.array([sum(1 << b for b in c) for k in range(radius // BLOCKS + 1) for c in combinations(range(width), k)])
    values = (_block(prints, block)[:, None] ^ masks[None, :]).ravel()
    items = np.repeat(np.arange(len(prints)), len(masks))
    order = np.argsort(values, kind="stable")
    return np.searchsorted(values[order], np.arange((1 << width) + 1)), items[order].astype(np.int32)


class Index:
    """The items of a benchmark, ready to search texts for them. Items under five words are not evidence and match nothing."""

    def __init__(self, items: Iterable[tuple[object, bytes]], similarity: float = SIMILARITY, radius: int = RADIUS):
        self.similarity, self.radius = similarity, radius
        self.powers = Powers()
        self.ids, self.counts, sizes = [], [], {}
        known = []
        for key, text in items:
            tokens = words(text)
            if len(tokens) >= WIDTH:
                hashes = shingles(text, self.powers)
                known.append(hashes)
                sizes.setdefault(len(tokens), []).append((len(self.ids), simhash(hashes)))
                self.ids.append(key)
                self.counts.append(Counter(zip(*(tokens[i:] for i in range(WIDTH)), strict=False)))
        self.sizes: list[Size] = []
        pairs = []  # shingle, position in sizes
        for n, rows in sorted(sizes.items()):
            pairs += [(h, len(self.sizes)) for i, _ in rows for h in set(known[i].tolist())]
            prints = np.array([p for _, p in rows], np.uint64)
            near = [_near(prints, b, radius) for b in range(BLOCKS)]
            self.sizes.append(Size(n, np.array([i for i, _ in rows]), prints, near))
        pairs = sorted(set(pairs))
        self.shingle = np.array([h for h, _ in pairs], np.uint64)
        self.size_of = np.array([n for _, n in pairs], np.int64)

    def search(self, text: bytes) -> list[tuple[object, int, int, float]]:
        """(item id, first word, last word + 1, similarity) of the best window per item in the text."""
        hashes = shingles(text, self.powers)
        first = np.searchsorted(self.shingle, hashes, "left")
        count = np.searchsorted(self.shingle, hashes, "right") - first
        hits = np.flatnonzero(count)
        if not len(hits):
            return []
        count, first = count[hits], first[hits]
        hit = np.repeat(hits, count)
        size_of = self.size_of[np.repeat(first - np.cumsum(count) + count, count) + np.arange(len(hit))]
        tokens = words(text)
        best: dict[int, tuple[float, int, int]] = {}
        for number in np.unique(size_of).tolist():
            size = self.sizes[number]
            n = size.n_words - WIDTH + 1
            # windows that cover a hit; each covers the n shingles from its start on
            own = hit[size_of == number]
            edges = np.bincount(np.maximum(own - n + 1, 0), minlength=len(hashes) + 1) - np.bincount(own + 1, minlength=len(hashes) + 1)
            starts = np.flatnonzero(np.cumsum(edges)[:-1])
            window, item = size.candidates(window_simhashes(hashes, starts, n), self.radius)
            for w, i in zip(starts[window].tolist(), size.items[item].tolist(), strict=True):
                stop = min(w + size.n_words, len(tokens))
                mine, own = Counter(zip(*(tokens[w + k : stop] for k in range(WIDTH)), strict=False)), self.counts[i]
                shared = sum((mine & own).values())
                score = shared / (mine.total() + own.total() - shared)
                if score >= self.similarity and (i not in best or (score, -w) > (best[i][0], -best[i][1])):
                    best[i] = (score, w, stop)
        return [(self.ids[i], w, stop, score) for i, (score, w, stop) in sorted(best.items())]


def indexes(docs: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text", limit: int = ITEM_BYTES) -> Iterator[Broadcast]:
    """One broadcast index per at most ``limit`` bytes of items; a benchmark beyond that takes several passes."""
    part, size = [], 0
    context = docs.sparkSession.sparkContext
    for row in items.select(F.col(item_id), as_bytes(text)).toLocalIterator():
        if part and size + len(row[1]) > limit:
            yield context.broadcast(Index(part))
            part, size = [], 0
        part.append((row[0], bytes(row[1])))
        size += len(row[1])
    if part:
        yield context.broadcast(Index(part))


def matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, first_word, end_word, similarity) of the best window per row of ``docs`` and item.

    Null and empty texts match nothing. Repeated rows match alike; items that repeat match each. Without items
    or documents there are no rows.
    """
    rows = docs.select("doc_id", as_bytes().alias("text"))
    out = schema(doc_id=kind_of(rows, "doc_id"), item_id=kind_of(items, "item_id"), first_word="long", end_word="long", similarity="double")

    def searched(index: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [(n, *hit) for n, text in enumerate(batch.column(1)) for hit in index.value.search(text.as_py())]
                if found:
                    at, *columns = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *map(pa.array, columns)], out.names)

        return rows.mapInArrow(run, out)

    found = [searched(index) for index in indexes(docs, items)]
    if not found:
        return docs.sparkSession.createDataFrame([], out)
    total = found[0]
    for more in found[1:]:
        total = total.union(more)
    return total


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns. No shuffle."""
    def filtered(rows: DataFrame, index: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not index.value.search(t.as_py()) for t in batch.column(0)], pa.bool_()))

        return rows.mapInArrow(run, rows.schema)

    rows = docs.select(as_bytes().alias("text"), whole_row(docs))
    for index in indexes(docs, items):
        rows = filtered(rows, index)
    return rows.select("row.*")


def op1_decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return matches(docs, benchmark)

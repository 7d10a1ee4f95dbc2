"""Language-model scoring with a class-based bigram model: exchange clustering, transitions, emissions.

The probability of a word is that of its class after the class of the word before it, times that of the word in
its class; both are smoothed by half a count. The text's end is a word with a class of its own, and stands before
the first word, too.

The classes come in two steps. Units of the first are the frequent words, one each, and groups of all others by the hash of
their last two bytes. Exchange clustering moves units between classes while that
raises the likelihood of all training bigrams: a round is one Spark job that finds each unit's
best class with the others' fixed, and every other unit may move (all at once would swap back and forth).
Then every word of a group leaves it for the class that its own contexts, the classes before and after it in all training
texts, make likeliest. All class bigrams are counted anew; if they were less likely than before, fewer words would
leave. Only words that no training text has stay with their group.

All counts cover all training texts. Sizes: bigrams of units and class tables are bounded by the model's
parameters. The frequent words that are broadcast are those above a count that at most ``LEXICON`` words reach, of 64
bytes at most. Counts of all other words stay in a table, which the texts' other words are joined to.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property
from math import log10

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crownledger.llm.text import as_bytes, kind_of, schema
from crownledger.sources.scratch import written

LEXICON = 1 << 17  # words that are broadcast, at most
LEXICON_BYTES = 64  # the longest of them
FREQUENT = 1024  # words that are units of the exchange, at most
SUFFIXES = 255  # groups of all other words
CLASSES = 64
MOST_CLASSES = 128  # a class and a side are one byte
SHARES = (1, 2, 4, 8)  # all words leave their groups, every other one, ...
ROUNDS = 8
STEPS = 32  # count bands per power of two, from which thresholds are chosen
DISTINCT = 1 << 18  # words that a task counts before it passes them on
TOKENS = 1 << 20  # bigrams that a task holds before it counts them
END = 0  # the unit and the class of a text's end


def held_out(key: str = "doc_id") -> Column:
    """Whether a document is kept from training: CRC-32 of its id as text modulo 5 is 1. A null id is the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 1


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) of all words of the column ``text``, counted per task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def passed_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], ["word", "n"])
            seen.clear()
            return out

        for batch in batches:
            for text in batch.column(0):
                seen.update(text.as_py().lower().split())
                if len(seen) >= DISTINCT:
                    yield passed_on()
        yield passed_on()

    return texts.select("text").mapInArrow(run, schema(word="binary", n="long")).groupBy("word").agg(F.sum("n").alias("n"))


def _band(n: Column) -> Column:
    return F.floor(F.log2(n) * STEPS)


def _least_band(bands: list[tuple[int, int]], most: int) -> int:
    """The lowest band such that it and those above hold at most ``most`` words."""
    least, total = 1 << 40, 0
    for band, n in sorted(bands, reverse=True):
        total += n
        if total > most:
            break
        least = band
    return least


def suffix_unit(word: bytes) -> int:
    return 1 + zlib.crc32(word[-2:]) % SUFFIXES


@dataclass
class Lexicon:
    """The broadcast words with their counts and units; ``n_units`` counts all units."""

    words: list[bytes]
    counts: np.ndarray
    units: np.ndarray
    n_units: int

    @cached_property
    def at(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(self.words)}

    def read(self, text: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The text's words, their places here or -1, and their units."""
        words = text.lower().split()
        find = self.at.get
        places = np.fromiter((find(w, -1) for w in words), np.int64, len(words))
        units = self.units[places] if len(self.units) else np.zeros(len(words), np.int64)
        for i in np.flatnonzero(places < 0).tolist():
            units[i] = suffix_unit(words[i])
        return words, places, units


def lexicon(counts: DataFrame, size: int = LEXICON, frequent: int = FREQUENT) -> Lexicon:
    """The most frequent words of ``counts``, in bounded number and length; the most frequent of them are units of their own."""
    short = counts.filter(F.octet_length("word") <= LEXICON_BYTES).withColumn("band", _band(F.col("n")))
    bands = [(r["band"], r["count"]) for r in short.groupBy("band").count().collect()]
    table = short.filter(F.col("band") >= _least_band(bands, size)).select("word", "n", "band").toArrow()
    own = _least_band(bands, frequent)
    rows = sorted(zip(table["word"].to_pylist(), table["n"].to_pylist(), table["band"].to_pylist(), strict=True), key=lambda r: (-r[1], r[0]))
    first = SUFFIXES + 1
    units = [first + i if band >= own else suffix_unit(w) for i, (w, _, band) in enumerate(rows)]
    n_units = first + sum(band >= own for _, _, band in rows)
    return Lexicon([w for w, _, _ in rows], np.array([n for _, n, _ in rows], np.float64), np.array(units, np.int64), n_units)


def unit_bigrams(texts: DataFrame, known: Lexicon) -> DataFrame:
    """(a, b, n): how often unit b follows unit a, ends before and after each text included; at most units squared rows."""
    shared, n_units = texts.sparkSession.sparkContext.broadcast(known), known.n_units

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, codes, held = np.zeros(n_units * n_units, np.int64), [], 0
        for batch in batches:
            for text in batch.column(0):
                units = np.concatenate(([END], shared.value.read(text.as_py())[2], [END]))
                codes.append(units[:-1] * n_units + units[1:])
                held += len(units)
                if held >= TOKENS:
                    total += np.bincount(np.concatenate(codes), minlength=len(total))
                    codes, held = [], 0
        if codes:
            total += np.bincount(np.concatenate(codes), minlength=len(total))
        cells = np.flatnonzero(total)
        for i in range(0, len(cells), 1 << 16):
            part = cells[i : i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array((part // n_units).astype(np.int32)), pa.array((part % n_units).astype(np.int32)), pa.array(total[part])], ["a", "b", "n"])

    pairs = texts.select("text").mapInArrow(run, schema(a="int", b="int", n="long"))
    return pairs.groupBy("a", "b").agg(F.sum("n").alias("n"))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def best_class(table: np.ndarray, after: np.ndarray, before: np.ndarray, own: float, now: int) -> tuple[int, float]:
    """The class to which a unit should move, and the gain in log-likelihood (0 to stay).

    ``table``: bigrams of classes. ``after`` and ``before``: the unit's bigrams by the other's class; ``own``: with itself.
    """
    after, before = after.copy(), before.copy()
    after[now] -= own
    before[now] -= own
    rest = table.copy()
    rest[now, :] -= after
    rest[:, now] -= before
    rest[now, now] -= own
    rows, columns = rest.sum(axis=1) + before, rest.sum(axis=0) + after  # of the others, the unit back in some class
    diagonal = np.diagonal(rest)
    gain = (
        (_xlogx(rest + after[None, :]) - _xlogx(rest)).sum(axis=1)
        + (_xlogx(rest + before[:, None]) - _xlogx(rest)).sum(axis=0)
        - (_xlogx(diagonal + after) - _xlogx(diagonal))
        - (_xlogx(diagonal + before) - _xlogx(diagonal))
        + (_xlogx(diagonal + after + before + own) - _xlogx(diagonal))
        - (_xlogx(rows + after.sum() + own) - _xlogx(rows))
        - (_xlogx(columns + before.sum() + own) - _xlogx(columns))
    )
    gain[END] = -np.inf  # the end stays alone
    best = int(np.argmax(gain))
    return (best, float(gain[best] - gain[now])) if gain[best] > gain[now] + 1e-6 else (now, 0.0)


def class_table(bigrams: DataFrame, classes: np.ndarray, n_classes: int) -> np.ndarray:
    """Bigrams of classes, a bounded matrix."""
    of = F.array(*map(F.lit, classes.tolist()))
    cells = bigrams.select(of[F.col("a")].alias("x"), of[F.col("b")].alias("y"), "n").groupBy("x", "y").agg(F.sum("n").alias("n")).collect()
    table = np.zeros((n_classes, n_classes))
    for r in cells:
        table[r["x"], r["y"]] = r["n"]
    return table


def exchange(bigrams: DataFrame, n_units: int, n_classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """The class of every unit. Units are dealt to the classes in turn first, the frequent words by rank."""
    classes = np.concatenate(([END], 1 + np.arange(n_units - 1) % (n_classes - 1)))
    sides = bigrams.select(
        F.inline(
            F.array(
                F.struct(F.col("a").alias("unit"), F.col("b").alias("other"), F.lit(True).alias("first"), "n"),
                F.struct(F.col("b").alias("unit"), F.col("a").alias("other"), F.lit(False).alias("first"), "n"),
            )
        )
    ).filter(f"unit != {END}")
    out = schema(unit="int", best="int", gain="double")
    still = 0
    for turn in range(rounds):
        table = class_table(bigrams, classes, n_classes)
        of = F.array(*map(F.lit, classes.tolist()))
        contexts = (
            sides.filter(F.col("unit") % 2 == turn % 2)
            .groupBy("unit", "first", of[F.col("other")].alias("class"))
            .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("unit") == F.col("other"), F.col("n")).otherwise(0)).alias("own"))
            .groupBy("unit")
            .agg(F.collect_list(F.struct("first", "class", "n", "own")).alias("context"))  # 2 * classes entries at most
        )

        def moved(batches: Iterator[pa.RecordBatch], table: np.ndarray = table, classes: np.ndarray = classes) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = []
                for unit, context in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    sides, own = np.zeros((2, n_classes)), 0.0
                    for c in context:
                        sides[0 if c["first"] else 1, c["class"]] = c["n"]
                        own += c["own"] if c["first"] else 0
                    rows.append((unit, *best_class(table, sides[0], sides[1], own, int(classes[unit]))))
                yield pa.RecordBatch.from_pylist([dict(zip(out.names, r, strict=True)) for r in rows], pa.schema([("unit", pa.int32()), ("best", pa.int32()), ("gain", pa.float64())]))

        moves = contexts.mapInArrow(moved, out).filter("gain > 0").collect()
        classes = classes.copy()
        for r in moves:
            classes[r["unit"]] = r["best"]
        still = 0 if moves else still + 1
        if still == 2:
            break
    return classes


@dataclass
class Model:
    """All that scoring needs besides the counts and classes of words outside the lexicon."""

    known: Lexicon
    classes: np.ndarray  # of units
    own: np.ndarray  # of the lexicon's words
    steps: np.ndarray  # bigrams of classes
    log_step: np.ndarray  # class after class
    log_mass: np.ndarray  # of the smoothed counts of a class's words
    n_tokens: int
    n_types: int
    n_texts: int

    @cached_property
    def log_counts(self) -> np.ndarray:
        return np.log10(self.known.counts + 0.5)

    def read(self, text: bytes) -> tuple[int, int, float, bytes, dict[bytes, bytes]]:
        """Tokens, known ones, log10 of smoothed counts of the tokens at hand, the words' classes, the other words' places (32 bits each).

        The end is a token; the other words' counts, and their classes if they are not their groups', are added by a join.
        """
        words, places, units = self.known.read(text)
        inside = places >= 0
        classes = self.classes[units]
        classes[inside] = self.own[places[inside]]
        counts = self.log_counts[places[inside]].sum() + log10(self.n_texts + 0.5)
        outside = np.flatnonzero(~inside)
        others = _per_word(words, outside, outside.astype(np.int32), {})
        return len(words) + 1, int(inside.sum()) + (self.n_texts > 0), float(counts), classes.astype(np.uint8).tobytes(), others


def _per_word(words: list[bytes], at: np.ndarray, values: np.ndarray, into: dict[bytes, bytes]) -> dict[bytes, bytes]:
    """Adds the bytes of each of the values to those of the word at its place."""
    size, packed, get = values.nbytes // max(len(values), 1), values.tobytes(), into.get
    for j, i in enumerate(at.tolist()):
        into[words[i]] = get(words[i], b"") + packed[j * size : (j + 1) * size]
    return into


def likelihood(steps: np.ndarray) -> float:
    """The log-likelihood of the training texts, but for the words' own counts, which no class changes."""
    return float(_xlogx(steps).sum() - _xlogx(steps.sum(0)).sum() - _xlogx(steps.sum(1)).sum())


def _smoothed(steps: np.ndarray, types: np.ndarray) -> dict[str, np.ndarray]:
    """The model's tables from the bigrams of classes and each class's number of distinct words."""
    return {
        "steps": steps,
        "log_step": np.log10((steps + 0.5) / (steps.sum(axis=1, keepdims=True) + 0.5 * len(steps))),
        "log_mass": np.log10(steps.sum(axis=0) + 0.5 * (types + 1)),
    }


def grouped(texts: DataFrame, size: int, frequent: int, n_classes: int, rounds: int) -> tuple[Model, DataFrame]:
    """The model in which all but the frequent words have their group's class, and the table (word, n) of all words."""
    counts = written(word_counts(texts))
    known = lexicon(counts, size, frequent)
    total = counts.agg(F.count(F.lit(1)).alias("types"), F.sum("n").alias("tokens")).first()
    bigrams = written(unit_bigrams(texts, known))
    classes = exchange(bigrams, known.n_units, n_classes, rounds)
    table = class_table(bigrams, classes, n_classes)
    n_texts = int(table[END].sum())
    # distinct words per class: frequent words count one each, the others by group
    own = known.n_units - SUFFIXES - 1
    others = counts.groupBy((1 + F.crc32(F.expr("substring(word, -2, 2)")) % SUFFIXES).cast("int").alias("unit")).count().collect()
    types = np.zeros(known.n_units)
    for r in others:
        types[r["unit"]] = r["count"]
    for w in known.words[:own]:
        types[suffix_unit(w)] -= 1
    types[SUFFIXES + 1 :] = 1
    tables = _smoothed(table, np.bincount(classes, weights=types, minlength=n_classes))
    n_types = total["types"] + (n_texts > 0)
    return Model(known, classes, classes[known.units], n_tokens=(total["tokens"] or 0) + n_texts, n_types=n_types, n_texts=n_texts, **tables), counts


def contexts(texts: DataFrame, model: Model) -> DataFrame:
    """(word, slots, ns) of all words that are no units: the classes before (slot: class) and after them (class and number of classes).

    A word of the lexicon is one row per task with the counts of its slots, another has a slot per neighbour and no counts.
    """
    shared, k = texts.sparkSession.sparkContext.broadcast(model), len(model.steps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, classes = shared.value.known, shared.value.classes
        total, codes, held, seen, n_seen = np.zeros(len(known.words) * 2 * k, np.int32), [], 0, {}, 0

        def counted() -> None:
            nonlocal codes, held
            cells, n = np.unique(np.concatenate(codes), return_counts=True)
            total[cells] += n.astype(np.int32)
            codes, held = [], 0

        def rows(words: pa.Array, slots: pa.Array, ns: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([words, slots, ns], ["word", "slots", "ns"])

        def others() -> pa.RecordBatch:
            return rows(pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.binary()), pa.nulls(len(seen), pa.binary()))

        for batch in batches:
            for text in batch.column(0):
                words, places, units = known.read(text.as_py())
                beside = np.concatenate(([END], classes[units], [END]))
                before, after = beside[:-2], beside[2:] + k
                inside = (places >= 0) & (units <= SUFFIXES)
                at = places[inside] * (2 * k)
                codes += [at + before[inside], at + after[inside]]
                held += 2 * len(at)
                if held >= TOKENS:
                    counted()
                outside = np.flatnonzero(places < 0)
                _per_word(words, outside, np.stack((before[outside], after[outside]), axis=1).astype(np.uint8), seen)
                n_seen += len(outside)
                if n_seen >= DISTINCT:
                    yield others()
                    seen, n_seen = {}, 0
        yield others()
        if codes:
            counted()
        names, step = pa.array(known.words, pa.binary()), 1 << 13
        for i in range(0, len(names), step):
            cells = np.flatnonzero(total[i * 2 * k : (i + step) * 2 * k])
            used, first = np.unique(cells // (2 * k), return_index=True)
            offsets = np.append(first, len(cells)).astype(np.int32)
            slots, ns = (cells % (2 * k)).astype(np.uint8), total[i * 2 * k + cells]
            yield rows(names.take(pa.array(i + used)), _binary(offsets, slots), _binary(4 * offsets, ns))

    return texts.select("text").mapInArrow(run, schema(word="binary", slots="binary", ns="binary"))


def _binary(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(values.tobytes())])


def _lengths(of: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(of), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _joined(of: pa.Array, kind: type) -> np.ndarray:
    """The bytes of all values as one array of numbers."""
    return np.frombuffer(b"".join(x for x in of.to_pylist() if x), kind)


def likeliest(before: np.ndarray, after: np.ndarray, now: np.ndarray, model: Model) -> np.ndarray:
    """The class of each word that makes its contexts likeliest, all else being as it is; rows are words, columns classes."""
    n = before.sum(axis=1)
    mass = np.broadcast_to(model.steps.sum(axis=0), before.shape).copy()
    mass[np.arange(len(now)), now] -= n  # of the others; the word comes with its own tokens
    likely = after @ model.log_step.T + before @ model.log_step - n[:, None] * np.log10(np.maximum(mass, 0) + n[:, None] + 0.5)
    likely[np.arange(len(now)), now] += 1e-9  # a tie changes nothing
    likely[:, END] = -np.inf
    return likely.argmax(axis=1)


def own_classes(texts: DataFrame, model: Model) -> DataFrame:
    """(word, n, place, class, group): the class of every word that is no unit by its own contexts; ``group`` is its group's class."""
    shared, k = texts.sparkSession.sparkContext.broadcast(model), len(model.steps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, classes = shared.value.known.at.get, shared.value.classes
        for batch in batches:
            words = batch.column(0).to_pylist()
            parts = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = batch.column(1).flatten()
            slots, ns = pc.struct_field(flat, "slots"), pc.struct_field(flat, "ns")
            lengths = _lengths(slots)
            of = np.repeat(np.repeat(np.arange(len(words)), parts), lengths)
            weights = np.ones(len(of))
            weights[np.repeat(ns.is_valid().to_numpy(zero_copy_only=False), lengths)] = _joined(ns, np.int32)
            sides = np.bincount(of * (2 * k) + _joined(slots, np.uint8), weights, len(words) * 2 * k).reshape(len(words), 2, k)
            now = classes[[suffix_unit(w) for w in words]]
            best = likeliest(sides[:, 0], sides[:, 1], now, shared.value)
            columns = [pa.array(words, pa.binary()), pa.array(sides[:, 0].sum(axis=1).astype(np.int64)), [find(w, -1) for w in words], best, now]
            yield pa.RecordBatch.from_arrays([*columns[:2], *(pa.array(x, pa.int32()) for x in columns[2:])], ["word", "n", "place", "class", "group"])

    listed = contexts(texts, model).groupBy("word").agg(F.collect_list(F.struct("slots", "ns")).alias("parts"))
    return written(listed.mapInArrow(run, schema(**{"word": "binary", "n": "long", "place": "int", "class": "int", "group": "int"})))


def sequences(docs: DataFrame, model: Model, counts: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, n_known, counts, classes) for every row: log10 of the words' smoothed counts, and a byte per word for its class.

    ``counts``: (word, n), with a column ``class`` if words outside the lexicon have other classes than their groups.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), as_bytes().alias("text"))
    others = "array<struct<word:binary,at:binary>>"
    out = schema(row="long", key=kind_of(rows, "key"), n_tokens="long", n_known="long", counts="double", classes="binary", others=others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 1024):
                part = batch.slice(i, 1024)
                columns = list(zip(*(shared.value.read(t.as_py()) for t in part.column(2)), strict=True))
                flat = [pa.array([x for c in columns[4] for x in of(c)], pa.binary()) for of in (dict.keys, dict.values)]
                ends = np.cumsum([0, *map(len, columns[4])]).astype(np.int32)
                words = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(flat, ["word", "at"]))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *map(pa.array, columns[:4]), words], out.names)

    found = written(rows.mapInArrow(run, out))
    of = F.col("class").cast("int") if "class" in counts.columns else F.lit(None).cast("int")
    listed = found.select("row", F.inline("others")).join(counts.select("word", "n", of.alias("class")), "word", "left")
    rest = listed.groupBy("row").agg(F.collect_list(F.struct("at", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("class", F.lit(-1)).alias("class"))).alias("rest"))

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, flat = len(batch), batch.column("rest").flatten()
            entries = pc.fill_null(pc.list_value_length(batch.column("rest")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            times = _lengths(pc.struct_field(flat, "at")) // 4
            n, new = (pc.struct_field(flat, x).to_numpy(zero_copy_only=False) for x in ("n", "class"))
            text = np.repeat(np.arange(size), entries)
            lengths = _lengths(batch.column("classes"))
            classes = _joined(batch.column("classes"), np.uint8).copy()
            at = _joined(pc.struct_field(flat, "at"), np.int32) + np.repeat((np.cumsum(lengths) - lengths)[text], times)
            to = np.repeat(new, times)
            classes[at[to >= 0]] = to[to >= 0]
            known = batch.column("n_known").to_numpy() + np.bincount(text, times * (n > 0), size).astype(np.int64)
            more = batch.column("counts").to_numpy() + np.bincount(text, times * np.log10(n + 0.5), size)
            ends = np.cumsum(lengths)
            texts = [classes[a:b].tobytes() for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True)]
            columns = [batch.column("key"), batch.column("n_tokens"), pa.array(known), pa.array(more), pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, done.names)

    done = schema(key=kind_of(rows, "key"), n_tokens="long", n_known="long", counts="double", classes="binary")
    return written(found.drop("others").join(rest, "row", "left").mapInArrow(filled, done))


def _steps_of(classes: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The classes of all texts with an end before each and after the last, and the place of each text's first step."""
    lengths = _lengths(classes)
    first = np.cumsum(lengths) - lengths + np.arange(len(lengths))
    line = np.full(int(lengths.sum()) + len(lengths) + 1, END, np.int64)
    inside = np.ones(len(line), bool)
    inside[np.append(first, len(line) - 1)] = False
    line[inside] = _joined(classes, np.uint8)
    return line, first


def class_steps(found: DataFrame, n_classes: int) -> np.ndarray:
    """Bigrams of classes of all texts of :func:`sequences`, a bounded matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_classes * n_classes, np.int64)
        for batch in batches:
            line, _ = _steps_of(batch.column(0))
            total += np.bincount(line[:-1] * n_classes + line[1:], minlength=len(total))
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(total[cells])], ["cell", "n"])

    table = np.zeros(n_classes * n_classes)
    for r in found.select("classes").mapInArrow(run, schema(cell="int", n="long")).groupBy("cell").agg(F.sum("n").alias("n")).collect():
        table[r["cell"]] = r["n"]
    return table.reshape(n_classes, n_classes)


def settled(texts: DataFrame, model: Model, counts: DataFrame, docs: DataFrame, trained: Column, key: str = "doc_id") -> tuple[Model, DataFrame, DataFrame]:
    """The model in which every word of ``texts`` has a class by its own contexts, the table (word, n, class), and the sequences of ``docs``.

    ``trained`` tells the texts among the sequences. The new classes are no less likely than the groups': else fewer words change.
    """
    n_classes, known = len(model.steps), model.known
    words = own_classes(texts, model)
    units = np.flatnonzero(known.units > SUFFIXES).tolist()
    of_units = [(known.words[i], int(known.counts[i]), int(model.own[i])) for i in units]
    for share in SHARES:
        chosen = words.withColumn("class", F.when(F.crc32("word") % share == 0, F.col("class")).otherwise(F.col("group")))
        own = model.own.copy()
        for r in chosen.filter("place >= 0").select("place", "class").collect():  # the lexicon at most
            own[r["place"]] = r["class"]
        types = np.bincount(model.classes[SUFFIXES + 1 :], minlength=n_classes).astype(float)
        for r in chosen.groupBy("class").count().collect():
            types[r["class"]] += r["count"]
        tried = replace(model, own=own)
        found = sequences(docs, tried, chosen, key)
        steps = class_steps(found.filter(trained), n_classes)
        if likelihood(steps) >= likelihood(model.steps):
            listed = texts.sparkSession.createDataFrame(of_units, "word binary, n long, class int")
            return replace(tried, **_smoothed(steps, types)), chosen.select("word", "n", "class").unionByName(listed), found
    return model, counts, sequences(docs, model, counts, key)


def train(texts: DataFrame, size: int = LEXICON, frequent: int | None = None, n_classes: int = CLASSES, rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """The model of all texts of the column ``text`` (null: empty) and the table (word, n) of their words, with their classes.

    Every word has a class by its own contexts. If ``frequent`` is given, only so many words have; the others share their group's.
    """
    if n_classes > MOST_CLASSES:
        raise ValueError(f"at most {MOST_CLASSES} classes")
    model, counts = grouped(texts, size, FREQUENT if frequent is None else frequent, n_classes, rounds)
    if frequent is not None:
        return model, counts
    return settled(texts, model, counts, texts.select(F.lit(0).alias("doc_id"), "text"), F.lit(True))[:2]


def scored(docs: DataFrame, model: Model, counts: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, n_known, base_score, score) for every row: log10 probabilities of whole texts.

    ``base_score`` is that of a smoothed unigram model, ``score`` that of the class model. A null or empty text is
    one token, its end. Repeated rows and ids are scored row by row.
    """
    return scores(sequences(docs, model, counts, key), model)


def scores(found: DataFrame, model: Model) -> DataFrame:
    """The scores of the texts of :func:`sequences`."""
    shared = found.sparkSession.sparkContext.broadcast((model.log_step, model.log_mass, log10(model.n_texts + 0.5)))
    out = schema(key=kind_of(found, "key"), n_tokens="long", n_known="long", counts="double", model="double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_step, log_mass, end = shared.value
        for batch in batches:
            if len(batch):
                line, first = _steps_of(batch.column("classes"))
                mass = np.append(log_mass[line[1:]], 0.0)
                mass[np.append(first, len(line) - 1) - 1] = end  # of each text's end
                parts = log_step[line[:-1], line[1:]] - mass[:-1]
                model = np.add.reduceat(parts, first)
                yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in ("key", "n_tokens", "n_known", "counts")), pa.array(model)], out.names)

    all_counts = F.col("counts")
    return found.mapInArrow(run, out).select(
        "key",
        "n_tokens",
        "n_known",
        (all_counts - F.col("n_tokens") * log10(model.n_tokens + 0.5 * (model.n_types + 1))).alias("base_score"),
        (all_counts + F.col("model")).alias("score"),
    )


def op4_brown(docs: DataFrame, **sizes: int) -> DataFrame:
    """The contract's columns, and the perplexity of a token under the class model."""
    training = docs.filter(~held_out()).select(as_bytes().alias("text"))
    if sizes.get("frequent") is None:
        model, counts = grouped(training, **{"size": LEXICON, "frequent": FREQUENT, "n_classes": CLASSES, "rounds": ROUNDS} | {k: v for k, v in sizes.items() if v is not None})
        model, _, read = settled(training, model, counts, docs, ~held_out("key"))
        found = scores(read, model)
    else:
        model, counts = train(training, **sizes)
        found = scored(docs, model, counts)
    return found.select(
        F.col("key").alias("doc_id"),
        held_out("key").alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )

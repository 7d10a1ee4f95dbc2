"""Secret scans: Aho-Corasick keyword prefilter, anchored patterns at the hits, embedded checksums.

An automaton finds the keywords of all kinds in one pass over the lower-cased text; only at a hit a pattern is
tried, anchored there. Kinds that no keyword announces (runs of hex digits) have as hits the aligned
blocks of 12 bytes that are all hex digits, one of which lies in every run of 24. Tokens that carry a
checksum are reported only if it is right.

Texts are scanned as bytes, with one character per byte; offsets are turned into code points at the end.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from crownledger.llm.text import as_bytes, kind_of, schema

BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
HEX_RUN, HEX_BLOCK = 24, 12
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True
_NOT_HEX = re.compile(rb"[^0-9a-f]")


def crc_token(token: bytes) -> bool:
    """Whether a token ends in the CRC-32 of its random part, as six base-62 digits."""
    body, check = token[token.index(b"_") + 1 : -6], token[-6:]
    value = 0
    for c in check.decode("ascii"):
        value = value * 62 + BASE62.index(c)
    return value == zlib.crc32(body)


@dataclass(frozen=True)
class Kind:
    """``pattern`` is tried at every keyword; a match that ``passes`` refuses is dropped, and its text is used up."""

    name: str
    keywords: tuple[str, ...]
    pattern: re.Pattern[bytes]
    passes: Callable[[re.Match[bytes]], bool]


#: In the order in which spans that start together are listed; hex is listed between them.
KINDS = (
    Kind(
        "assign",
        ("password", "passwd", "secret", "token", "api_key", "apikey"),
        re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I),
        lambda m: len(m[2]) >= 6,
    ),
    Kind("access", ("akia",), re.compile(rb"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    Kind(
        "forge",  # access tokens of a code forge: prefix, 30 random characters, CRC-32
        ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
        re.compile(rb"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
        lambda m: crc_token(m[0]),
    ),
    Kind("registry", ("npm_",), re.compile(rb"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), lambda m: crc_token(m[0])),
    Kind(
        "private_key",
        ("-----begin",),
        re.compile(rb"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----(?:[\sA-Za-z0-9+/=:,]|-(?!----))+-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
        lambda m: True,
    ),
)
ORDER = {name: n for n, name in enumerate(["assign", "access", "hex", "forge", "registry", "private_key"])}
BASE = ("assign", "access", "hex")


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for n, kind in enumerate(KINDS):
        for word in kind.keywords:
            found.add_word(word, (n, len(word)))
    found.make_automaton()
    return found


def hex_runs(data: bytes) -> Iterator[tuple[int, int]]:
    """Maximal runs of at least 24 lower-case hex digits."""
    usable = len(data) - len(data) % HEX_BLOCK
    blocks = _HEX[np.frombuffer(data, np.uint8, usable)].reshape(-1, HEX_BLOCK).all(axis=1)
    done = 0
    for at in (np.flatnonzero(blocks) * HEX_BLOCK).tolist():
        if at >= done:
            start = at
            while start > done and _HEX[data[start - 1]]:
                start -= 1
            stop = _NOT_HEX.search(data, at)
            done = stop.start() if stop else len(data)
            if done - start >= HEX_RUN:
                yield start, done


def spans(data: bytes, keywords: ahocorasick.Automaton) -> list[tuple[int, str, int]]:
    """(start, kind, end) of all secrets, in code points, by start and then kind; leftmost, not overlapping per kind."""
    done = [0] * len(KINDS)
    found = [(a, "hex", b) for a, b in hex_runs(data)]
    for last, (n, length) in keywords.iter(data.lower().decode("latin-1")):
        start = last - length + 1
        if start >= done[n] and (match := KINDS[n].pattern.match(data, start)):
            done[n] = match.end()
            if KINDS[n].passes(match):
                found.append((start, KINDS[n].name, match.end()))
    found.sort(key=lambda span: (span[0], ORDER[span[1]]))
    if found and not data.isascii():
        points = np.concatenate(([0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)))
        found = [(int(points[a]), kind, int(points[b])) for a, kind, b in found]
    return found


def listed(found: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, kind, b in found)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, spans array of start, kind, end) for every row; a null text has none."""
    rows = docs.select("doc_id", as_bytes().alias("text"))
    out = schema(doc_id=kind_of(rows, "doc_id"), spans="array<struct<start:bigint,kind:string,end:bigint>>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keywords = automaton()
        kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))
        for batch in batches:
            found = [[{"start": a, "kind": k, "end": b} for a, k, b in spans(t.as_py(), keywords)] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], out.names)

    return rows.mapInArrow(run, out)


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every secret in its text replaced by ``mark``; overlapping spans become one."""
    names = docs.columns
    row = docs.select(*[f"`{c}`" for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keywords = automaton()
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = []
            for value in batch.column(at).to_pylist():
                if value is not None:
                    kept, done = [], 0
                    for a, _, b in spans(value.encode(), keywords):
                        if a >= done:
                            kept += [value[done:a], mark]
                        done = max(done, b)
                    value = "".join((*kept, value[done:]))
                texts.append(value)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return row.mapInArrow(run, row.schema)


def op3_secrets(docs: DataFrame) -> DataFrame:
    """The contract's columns: base counts, a digest of the base spans, all spans."""
    rows = docs.select("doc_id", as_bytes().alias("text"))
    out = schema(
        doc_id=kind_of(rows, "doc_id"), n_assign="long", n_access="long", n_hex="long", base_sha256="string", spans="string"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keywords = automaton()
        for batch in batches:
            found = [spans(t.as_py(), keywords) for t in batch.column(1)]
            base = [[s for s in own if s[1] in BASE] for own in found]
            counts = [pa.array([sum(s[1] == kind for s in own) for own in base], pa.int64()) for kind in BASE]
            digests = [hashlib.sha256(listed(own).encode()).hexdigest() for own in base]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array(digests, pa.string()), pa.array(map(listed, found), pa.string())], out.names
            )

    return rows.mapInArrow(run, out)

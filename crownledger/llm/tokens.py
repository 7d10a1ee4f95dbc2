"""Token counts from flat token files: a separator scan over blocks, stitched by a prefix scan.

A flat file holds little-endian 16-bit token ids and nothing else; each document ends with a separator id.
It has no index, so that blocks of a file are scanned independently: a block finds its separators, which end
documents. The length of a document that begins in the block is known there. For the first separator of each
block it follows from the last separator of the blocks before, a running maximum over one row per block.

``trailer`` tokens before the separator can carry an id; a block reads so many tokens before its start, too.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crownledger.llm.files import Roller, opened
from crownledger.llm.text import schema
from crownledger.session import work_folder
from crownledger.sources.scratch import written

#: fixed values of the public vocabulary: its path (a parameter everywhere), its pattern, its first free id
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"  # ranks of a byte-level BPE
SEPARATOR = 50256
BLOCK = 1 << 21  # tokens
ID_DIGITS = 5  # an id as a trailer: 13 bits a token, the first of which is 4096 more for null
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def encoding(path: str = VOCABULARY) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def id_trailer(value: int | None) -> list[int]:
    own = (value or 0) & (1 << 64) - 1
    digits = [own >> 13 * (ID_DIGITS - 1 - i) & 0x1FFF for i in range(ID_DIGITS)]
    return [digits[0] + 4096 * (value is None), *digits[1:]]


def trailer_id(trailer: str = "trailer") -> Column:
    """The id in a trailer of :func:`id_trailer`."""
    value = F.lit(0).cast("long")
    for i in range(ID_DIGITS):
        digit = F.col(trailer)[i].cast("long")
        value = F.shiftleft(value, 13).bitwiseOR(digit.bitwiseAND(F.lit(4095 if i == 0 else 0x1FFF).cast("long")))
    return F.when(F.col(trailer)[0] < 4096, value)


def write_tokens(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """Write the tokens of (doc_id, text) to flat files under ``folder``, with the id as trailer: (uri, bytes, documents).

    A null text is empty. Texts of any length are one document each. The vocabulary is a path on the workers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, files = encoding(vocabulary), Roller(folder, ".tokens")
        for batch in batches:
            for key, text in zip(*batch.columns, strict=True):
                tokens = encoder.encode_to_numpy((text.as_py() or b"").decode("utf-8", "replace"))
                files.write(np.concatenate((tokens, [*id_trailer(key.as_py()), SEPARATOR])).astype("<u2").tobytes())
        files.close()
        columns = list(zip(*files.closed, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)], ["uri", "bytes", "documents"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return written(rows.mapInArrow(run, schema(uri="string", bytes="long", documents="long")))


def token_files(spark: SparkSession, paths: str) -> DataFrame:
    """(uri, bytes) of existing flat files; their content is not read."""
    return spark.read.format("binaryFile").load(paths).select(F.col("path").alias("uri"), F.col("length").alias("bytes"))


def count_tokens(files: DataFrame, separator: int = SEPARATOR, trailer: int = 0, block: int = BLOCK) -> DataFrame:
    """(uri, place, n_tokens, trailer, ended) per document of the files (uri, bytes), in the order of ``place``.

    ``place`` is the position of its separator, ``n_tokens`` leaves out separator and trailer. Two separators in a
    row hold an empty document. Tokens after the last separator are a document with ``ended`` false and
    no trailer; an empty file has no documents. A file of an odd number of bytes is refused.
    """
    if not 0 <= separator < 1 << 16:
        raise ValueError("the separator must be a 16-bit id")
    length = F.when(F.col("bytes") % 2 == 0, F.col("bytes") / 2).otherwise(F.raise_error(F.concat(F.lit("odd number of bytes: "), "uri")))
    sized = files.select("uri", length.cast("long").alias("length"))
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(block).cast("long"))
    blocks = sized.filter("length > 0").select("uri", "length", F.explode(starts).alias("start"))
    out = schema(uri="string", start="long", place="long", before="long", trailer="array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, path = opened(uri)
                lead = min(trailer, start)
                with system.open_input_file(path) as file:
                    data = file.read_at(2 * (lead + min(block, size - start)), 2 * (start - lead))
                ids = np.frombuffer(data, "<u2")
                ends = np.flatnonzero(ids[lead:] == separator) + lead
                if not len(ends):
                    continue
                # of a document shorter than its trailer, the separator before shows in it; such a file has another format
                at = ends[:, None] + np.arange(-trailer, 0)[None, :]
                marks = np.where(at >= 0, ids[np.maximum(at, 0)], 0).astype(np.int32)
                places = ends - lead + start
                before = pa.array(np.concatenate(([0], places[:-1])), pa.int64(), mask=np.arange(len(places)) == 0)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ends) + 1) * trailer, pa.int32()), pa.array(marks.ravel()))
                for i in range(0, len(ends), 1 << 16):
                    n = min(1 << 16, len(ends) - i)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([uri] * n), pa.array([start] * n), pa.array(places[i : i + n]), before.slice(i, n), lists.slice(i, n)], out.names
                    )

    tasks = max(1, min(ceil(blocks.count() / 4), 1 << 16))
    ends = written(blocks.repartition(tasks, "uri", "start").mapInArrow(run, out))
    order = W.partitionBy("uri").orderBy("start")
    carried = (
        ends.groupBy("uri", "start")
        .agg(F.max("place").alias("last"))
        .select("uri", "start", F.coalesce(F.max("last").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(-1)).alias("carried"))
    )
    inside = ends.filter("before is not null").select("uri", "place", "before", "trailer")
    first = ends.filter("before is null").join(carried, ["uri", "start"]).select("uri", "place", F.col("carried").alias("before"), "trailer")
    ended = inside.union(first).select(
        "uri", "place", (F.col("place") - F.col("before") - 1 - trailer).alias("n_tokens"), "trailer", F.lit(True).alias("ended")
    )
    rest = (
        sized.join(ends.groupBy("uri").agg(F.max("place").alias("last")), "uri", "left")
        .select("uri", F.col("length").alias("place"), (F.col("length") - 1 - F.coalesce("last", F.lit(-1))).alias("n_tokens"))
        .filter("n_tokens > 0")
        .select("uri", "place", "n_tokens", F.lit(None).cast("array<int>").alias("trailer"), F.lit(False).alias("ended"))
    )
    return ended.union(rest)


def op2_tokens(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens) of every document, counted in the flat files that its tokens were written to."""
    files = write_tokens(docs, work_folder(docs.sparkSession))
    return count_tokens(files, trailer=ID_DIGITS).select(trailer_id().alias("doc_id"), "n_tokens")

"""Words, readers and small column helpers that the corpus operators share.

Texts travel to Python as bytes: ``bytes.split()`` and ``bytes.lower()`` know exactly the ASCII white space
``[\\x20\\x09-\\x0D]`` and the letters A-Z, and a text that is not valid UTF-8 does not stop a job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def as_bytes(text: str | Column = "text") -> Column:
    """The text as UTF-8; null is the empty text."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.cast("binary"), F.lit(b""))


def schema(**fields: str | T.DataType) -> T.StructType:
    """``schema(doc_id="long", spans="array<string>")``; also takes types of an existing column."""
    out = T.StructType()
    for name, kind in fields.items():
        if isinstance(kind, str) and kind not in ("long", "double", "string", "binary", "boolean"):
            kind = T.DataType.fromDDL(kind)
        out = out.add(name, kind)
    return out


def kind_of(df: DataFrame, column: str) -> T.DataType:
    return df.schema[column].dataType


def whole_row(df: DataFrame, *without: str) -> Column:
    """The row as one column ``row``, so that none of its names meets those that an operator adds."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in without]).alias("row")

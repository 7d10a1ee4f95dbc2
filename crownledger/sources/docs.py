"""Binary document sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_docs(spark: SparkSession, folder: str, ext: str) -> DataFrame:
    """Documents as rows (path, modificationTime, length, content); the extension is matched in any case.

    Listing reads file names and sizes only, ``content`` is loaded when it is selected.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.filter(F.lower("path").endswith(ext.lower()))


def size_report(files: DataFrame, ext: str) -> DataFrame:
    """How many documents match the extension, and their size in MB."""
    matching = files.filter(F.lower("path").like(f"%{ext.lower()}"))
    return matching.agg(
        F.count(F.lit(1)).alias("documents"),
        F.round(F.coalesce(F.sum("length"), F.lit(0)).cast("double") / 1024.0 / 1024.0, 1).alias("total_mb"),
    )

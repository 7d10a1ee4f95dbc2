"""Working tables in the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from crownledger.session import released_shuffles, work_folder


def written(df: DataFrame, file_rows: int = 0) -> DataFrame:
    """The rows written once as a parquet table and read back.

    For an expensive result that a plan reads more than once: Spark would compute it once per use, and
    nested uses multiply. The table also cuts the lineage, so a lost executor costs only its own tasks;
    reads of it prune columns. ``file_rows`` bounds the rows of a file, for rows of megabytes: a file's writer and its
    readers hold up to a hundred rows at once, whatever their size. The shuffles behind the rows are gone once they are written.
    """
    path = work_folder(df.sparkSession)
    with released_shuffles(df.sparkSession):
        df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Keeps a chunk index in step with a stream of re-chunked documents.

Chunks carry the version of their document, a number that grows with every re-chunking. A document's live chunks are
those of its newest version: chunks of one version may arrive in any number of micro-batches, and what an
older version had and the newest has not is gone. A row without a chunk id says that the document is deleted.

The index is a change log in parquet, one folder per micro-batch and in it one per bucket of documents: (chunk_id, doc_uri,
content_hash, chunk_to_embed, op, version, batch, bucket). A batch writes only what it brings, into its own folder, so that a batch
that runs twice after a failure overwrites itself and is counted once; and it reads only the buckets of its own documents, so that its
cost goes by its size and not by the log's. ``compact`` folds the log into its live part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crownledger.schemas import struct

LOG_SCHEMA = struct(
    "chunk_id string, doc_uri string, content_hash string, chunk_to_embed string, op string, version bigint, batch bigint, bucket int"
)
BUCKETS = 64  # of documents; a log keeps the number it was begun with
ENTRY = ["content_hash", "chunk_to_embed", "op"]


def change_log(spark: SparkSession, index: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", "false").parquet(index)


def bucket(doc_uri: str = "doc_uri", buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(doc_uri), F.lit(buckets)).cast("int")


def by_bucket(rows: DataFrame) -> DataFrame:
    """The rows with their ``bucket``, those of one bucket in one partition."""
    return rows.withColumn("bucket", bucket()).repartition("bucket")


def put(entries: DataFrame, folder: str) -> None:
    """Write the entries of one batch, which lie by bucket, replacing what an earlier attempt left, one file per bucket."""
    entries.write.mode("overwrite").partitionBy("bucket").parquet(folder)


def current_index(log: DataFrame) -> DataFrame:
    """Live chunks: the latest entry per chunk of each document's newest version; no rows for deleted documents.

    Two partial aggregates over keys: the newest version per document, a deletion counting after chunks of its
    own version, and the latest entry per chunk and version.
    """
    newest = log.groupBy("doc_uri").agg(F.max(F.struct("version", F.col("chunk_id").isNull().alias("deleted"))).alias("newest"))
    alive = newest.filter("not newest.deleted").select("doc_uri", F.col("newest.version").alias("version"))
    latest = log.filter("chunk_id is not null").groupBy("chunk_id", "doc_uri", "version").agg(
        F.max_by(F.struct(*ENTRY), "batch").alias("e")
    )
    return latest.join(alive, ["doc_uri", "version"]).select("chunk_id", "doc_uri", "e.content_hash", "e.chunk_to_embed", "version")


def sync_batch(spark: SparkSession, batch: DataFrame, batch_id: int, index: str) -> None:
    """Append one batch (chunk_id, doc_uri, chunk_to_embed, version) to the log.

    Of rows that repeat a chunk of one version in a batch, that with the greatest text counts. ``op`` tells what the row did to
    the index before the batch: I for a new chunk, U for a changed text, K for a kept one, D for a deleted
    document. Only hashes of the batch's documents are read from the log, only from their buckets and only from earlier
    batches, so that a repeated batch sees the same state again. Texts are shuffled once, by bucket; what the index
    held before goes with them.
    """
    keys = ["chunk_id", "doc_uri", "version"]
    named = batch.select(*keys).distinct()
    own = [r["bucket"] for r in named.select(bucket().alias("bucket")).distinct().collect()]  # at most BUCKETS
    log = change_log(spark, index).filter((F.col("batch") < batch_id) & F.col("bucket").isin(own))
    touched = log.join(named.select("doc_uri").distinct(), "doc_uri", "left_semi").withColumn("chunk_to_embed", F.lit(None).cast("string"))
    before = current_index(touched).select("chunk_id", F.struct(F.col("content_hash").alias("hash")).alias("_before"))
    known = named.join(before, "chunk_id").withColumn("chunk_to_embed", F.lit(None).cast("string"))
    both = by_bucket(batch.select(*keys, "chunk_to_embed").unionByName(known, allowMissingColumns=True))
    given = both.groupBy("bucket", *keys).agg(F.max("chunk_to_embed").alias("chunk_to_embed"), F.collect_list("_before").alias("_before"))
    new = given.withColumns({"content_hash": F.sha2("chunk_to_embed", 256), "_before": F.explode_outer("_before")})
    op = (
        F.when(F.col("chunk_id").isNull(), "D")
        .when(F.col("_before.hash").isNull(), "I")
        .when(F.col("_before.hash") != F.col("content_hash"), "U")
        .otherwise("K")
    )
    put(new.select("chunk_id", "doc_uri", "content_hash", "chunk_to_embed", op.alias("op"), "version", "bucket"), f"{index}/batch={batch_id}")


def compact(spark: SparkSession, index: str, target: str) -> None:
    """Write the live part of a log as a new log: one entry per live chunk, and the last deletion of each deleted document."""
    log = change_log(spark, index)
    gone = log.filter("chunk_id is null").groupBy("doc_uri").agg(F.max("version").alias("version"))
    marks = gone.select(
        F.lit(None).cast("string").alias("chunk_id"), "doc_uri", F.lit(None).cast("string").alias("content_hash"),
        F.lit(None).cast("string").alias("chunk_to_embed"), F.lit("D").alias("op"), "version",
    )
    live = current_index(log).withColumn("op", F.lit("K"))
    put(by_bucket(live.select(*marks.columns).unionByName(marks)), f"{target}/batch=-1")


def begin(spark: SparkSession, index: str) -> None:
    """An empty log, unless there is one."""
    spark.createDataFrame([], LOG_SCHEMA).drop("batch", "bucket").write.mode("ignore").parquet(f"{index}/batch=-1/bucket=0")


def stream_sync(spark: SparkSession, chunks: str, schema: T.StructType, index: str, checkpoint: str) -> DataFrame:
    """Sync all chunk files that are available now and return the current index."""
    begin(spark, index)
    stream = spark.readStream.schema(schema).parquet(chunks)
    writer = stream.writeStream.foreachBatch(lambda df, i: sync_batch(spark, df, i, index))
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return current_index(change_log(spark, index))

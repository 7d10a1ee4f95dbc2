"""Load, export and stream queries. Each one writes the bound tables to a new work folder and loads them back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crownledger.operators import aggregates as A
from crownledger.operators import silver
from crownledger.plans.registry import query
from crownledger.schemas import TABLES, columns_of, schema_of
from crownledger.session import work_folder
from crownledger.sources import files
from crownledger.sources.tables import Store
from crownledger.streaming import ingest, sync


def _declared(t, names):
    return {n: t.bronze(n).select(*columns_of(n)) for n in names}


def _store(t):
    root = work_folder(t.spark)
    return Store(t.spark, root, f"t{root[-12:]}_")


def _result(t, rows, schema):
    return t.spark.createDataFrame(rows, schema)


@query("load_csv_ctas")
def load_csv_ctas(t):
    """All tables created from CSV; a second run leaves them as they are."""
    store = _store(t)
    paths = files.export_csv(_declared(t, TABLES), f"{store.root}/raw", packed=True)
    for _ in range(2):
        tables = {n: store.create_if_missing(files.load_csv(t.spark, p, schema_of(n)), n) for n, p in paths.items()}
    return A.table_counts(tables)


@query("load_csv_infer")
def load_csv_infer(t):
    """Rows, columns and inferred text columns per table; a zip code turns into a number here, which declared schemas avoid."""
    paths = files.export_csv(_declared(t, TABLES), f"{work_folder(t.spark)}/raw", packed=True)
    inferred = {n: files.load_csv(t.spark, p) for n, p in paths.items()}
    texts = _result(t, [(n, sum(k == "string" for _, k in df.dtypes)) for n, df in inferred.items()], "table_name string, text_columns bigint")
    return files.profile(inferred).drop("schema").join(texts, "table_name")


@query("copy_into")
def copy_into(t):
    """Rows added by a first load, by a rerun, and by a rerun after one more file arrived."""
    root = work_folder(t.spark)
    rows = []
    for name in TABLES:
        feed = ingest.Feed(f"{root}/raw/{name}", schema_of(name))
        data = _declared(t, [name])[name]
        files.write_csv(data, feed.folder, "append", packed=True)
        first, again = (ingest.copy_into(t.spark, feed, f"{root}/ledger/{name}", f"{root}/bronze/{name}") for _ in range(2))
        files.write_csv(data, feed.folder, "append", packed=True)
        more = ingest.copy_into(t.spark, feed, f"{root}/ledger/{name}", f"{root}/bronze/{name}")
        rows.append((name, first, again, more, t.spark.read.parquet(f"{root}/bronze/{name}").count()))
    return _result(t, rows, "table_name string, first bigint, rerun bigint, new_file bigint, total bigint")


@query("file_stream")
def file_stream(t):
    """Appointments streamed from CSV with their declared schema, one file at a time, and read back."""
    root, name = work_folder(t.spark), "appointments"
    paths = files.export_csv(_declared(t, [name]), f"{root}/raw")
    feed = ingest.Feed(paths[name], schema_of(name))
    ingest.ingest_stream(t.spark, feed, f"{root}/ckpt", f"{root}/bronze", max_files=1)
    return t.spark.read.schema(schema_of(name)).parquet(f"{root}/bronze")


@query("append_sink")
def append_sink(t):
    """Claims streamed twice through one checkpoint arrive once."""
    root, name = work_folder(t.spark), "claims_and_payments"
    paths = files.export_csv(_declared(t, [name]), f"{root}/raw")
    feed = ingest.Feed(paths[name], schema_of(name))
    for _ in range(2):
        ingest.append_stream(ingest.file_stream(t.spark, feed), f"{root}/bronze", f"{root}/ckpt").awaitTermination()
    return A.distinct_stats(t.spark.read.schema(schema_of(name)).parquet(f"{root}/bronze"), "claim_id")


@query("source_file_filter")
def source_file_filter(t):
    """Rows of one source file, out of a folder that holds two tables."""
    root = t.folder
    both = t.spark.read.schema("o_orderkey bigint, l_orderkey bigint").parquet(
        f"{root}/orders.parquet", f"{root}/lineitem.parquet"
    )
    return files.from_file(both, "orders.parquet").select("o_orderkey")


@query("bulk_load")
def bulk_load(t):
    """All tables from CSV by a manifest, with one result row per table."""
    store = _store(t)
    paths = files.export_csv(_declared(t, TABLES), f"{store.root}/raw", packed=True)
    return store.bulk_load({n: (p, schema_of(n)) for n, p in paths.items()}).select("table_name", "rows", "status")


@query("overwrite_schema")
def overwrite_schema(t):
    """A table overwritten by one with more columns."""
    store = _store(t)
    store.write_table(t.bronze("insurance_companies"), "payers")
    evolved = t.silver("insurance_companies").withColumn("is_public", F.col("payer_type") == "medicaid")
    return store.write_table(evolved, "payers", evolve=True)


@query("layer_ctas")
def layer_ctas(t):
    """A gold table written with comment and load time, read back without the time."""
    store = _store(t)
    out = store.write_layer(t.gold("gold_payer_performance"), "gold", "payer_performance", "Gold: payer performance")
    comment = t.spark.catalog.getTable(store.name("payer_performance", "gold")).description
    return out.select(
        "insurance_company_id",
        "total_claims",
        F.col("_gold_loaded_at").isNotNull().alias("is_stamped"),
        F.lit(comment).alias("comment"),
    )


@query("csv_export")
def csv_export(t):
    """All tables exported to CSV and read back with their declared schemas: rows, and rows that differ from what was written."""
    declared = _declared(t, TABLES)
    paths = files.export_csv(declared, f"{work_folder(t.spark)}/raw", packed=True)
    rows = [files.differences(declared[n], files.load_csv(t.spark, p, schema_of(n)), n) for n, p in paths.items()]
    return reduce(DataFrame.unionByName, rows)


@query("csv_export_patients")
def csv_export_patients(t):
    """Patients exported to CSV and read back with their declared schema."""
    paths = files.export_csv(_declared(t, ["patients"]), f"{work_folder(t.spark)}/raw")
    return files.load_csv(t.spark, paths["patients"], schema_of("patients"))


@query("table_preview")
def table_preview(t):
    """Rows, columns and the first three rows of every table."""
    return files.preview(_declared(t, TABLES))


# --- streams ---------------------------------------------------------------------------------


@query("stream_ingest")
def stream_ingest(t):
    """All tables ingested together, then again without new files."""
    root = work_folder(t.spark)
    paths = files.export_csv(_declared(t, TABLES), f"{root}/raw", packed=True)
    feeds = {n: ingest.Feed(p, schema_of(n)) for n, p in paths.items()}
    first = ingest.stream_ingest(t.spark, feeds, root)
    again = ingest.stream_ingest(t.spark, feeds, root).withColumnRenamed("rows", "rerun_rows")
    return first.select("table_name", "rows", "status").join(again.select("table_name", "rerun_rows"), "table_name")


@query("stream_schema_store")
def stream_schema_store(t):
    """Claims streamed as JSON; half of them come later and with one more field, which the stored schema takes up."""
    root = work_folder(t.spark)
    plain = columns_of("claims_and_payments")
    claims = t.silver("claims_and_payments").select(*plain, "is_denied")
    declared = claims.select(*plain).schema
    claims.filter("claim_id % 2 = 0").drop("is_denied").write.mode("append").json(f"{root}/raw")
    ingest.evolving_stream(t.spark, f"{root}/raw", declared, root)
    claims.filter("claim_id % 2 = 1").write.mode("append").json(f"{root}/raw")
    for _ in range(2):  # the second start already has the new column
        ingest.evolving_stream(t.spark, f"{root}/raw", declared, root)
    out = ingest.evolved(t.spark, root)
    return out.groupBy("is_denied").agg(F.count(F.lit(1)).alias("n")).withColumn("stored_columns", F.lit(len(out.columns)).cast("bigint"))


@query("stream_silver")
def stream_silver(t):
    """All tables through bronze and silver as streams: rows that arrive, and again none."""
    root = work_folder(t.spark)
    paths = files.export_csv(_declared(t, TABLES), f"{root}/raw", packed=True)
    ingest.stream_ingest(t.spark, {n: ingest.Feed(p, schema_of(n)) for n, p in paths.items()}, root)
    rows = []
    for name in TABLES:
        def run(name=name):
            tidy = lambda df: silver.to_silver(name, df, t.as_of)
            return ingest.stream_silver(t.spark, f"{root}/bronze/{name}", schema_of(name), tidy, f"{root}/ckpt/{name}", f"{root}/silver/{name}")

        first, again = run(), run()
        rows.append((name, first, again, len(t.spark.read.parquet(f"{root}/silver/{name}").columns) >= len(columns_of(name))))
    return _result(t, rows, "table_name string, first bigint, rerun bigint, is_complete boolean")


@query("stream_silver_visits")
def stream_silver_visits(t):
    """Appointments through bronze and silver as streams, read back."""
    root, name = work_folder(t.spark), "appointments"
    paths = files.export_csv(_declared(t, [name]), f"{root}/raw")
    ingest.ingest_stream(t.spark, ingest.Feed(paths[name], schema_of(name)), f"{root}/ckpt/bronze", f"{root}/bronze")
    ingest.stream_silver(
        t.spark, f"{root}/bronze", schema_of(name), silver.appointments, f"{root}/ckpt/silver", f"{root}/silver"
    )
    return t.spark.read.parquet(f"{root}/silver")


@query("stream_index_sync")
def stream_index_sync(t):
    """Chunks of all documents synced, then tidied texts as a new version: live chunks and log entries by operation."""
    root = work_folder(t.spark)
    chunks = t.chunks().select("chunk_id", "doc_uri", "chunk_to_embed", F.lit(1).cast("bigint").alias("version"))
    chunks.write.mode("append").parquet(f"{root}/chunks")
    sync.stream_sync(t.spark, f"{root}/chunks", chunks.schema, f"{root}/index", f"{root}/ckpt")
    tidied = chunks.withColumns({"chunk_to_embed": F.regexp_replace("chunk_to_embed", r"\n+", " "), "version": F.col("version") + 1})
    tidied.write.mode("append").parquet(f"{root}/chunks")
    live = sync.stream_sync(t.spark, f"{root}/chunks", chunks.schema, f"{root}/index", f"{root}/ckpt")
    log = sync.change_log(t.spark, f"{root}/index").groupBy("op").agg(F.count(F.lit(1)).alias("n"))
    return log.unionByName(live.agg(F.lit("live").alias("op"), F.count(F.lit(1)).alias("n")))

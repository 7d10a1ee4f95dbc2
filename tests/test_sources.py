import re

import pytest
from support import rows
from pyspark.sql import functions as F

from crownledger.operators import silver
from crownledger.schemas import schema_of
from crownledger.session import ship_package, shuffle_partitions, work_folder
from crownledger.sources import docs, files
from crownledger.sources.scratch import written
from crownledger.sources.tables import Store
from crownledger.streaming import ingest, sync

OFFICES = """office_id,office_name,city,state,zip_code,specialty_type,provider_count,opened_date
1,A,X,VA,07832,General Dentistry,7,2021-04-01
2,B,Y,md,12781,Orthodontics,3,2014-07-09
"""
NETWORKS = """association_id,office_id,insurance_company_id,shared_network_id,network_status
1,1,1,1.0,In-Network
2,1,2,,Out-of-Network
"""


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)
    return str(folder / name)


def test_zip_codes_keep_their_zero_and_float_keys_become_integers(spark, tmp_path):
    offices = files.load_csv(spark, put(tmp_path, "o.csv", OFFICES), schema_of("dental_offices"))
    assert rows(offices, "office_id", "zip_code")[0] == (1, "07832")
    inferred = files.load_csv(spark, str(tmp_path / "o.csv"))
    assert dict(inferred.dtypes)["zip_code"] == "int"
    networks = files.load_csv(spark, put(tmp_path, "n.csv", NETWORKS), schema_of("office_insurance_network"))
    assert rows(networks, "association_id", "shared_network_id") == [(1, 1), (2, None)]
    assert rows(silver.office_insurance_network(networks), "shared_network_id") == [(0,), (1,)]


def test_bad_cells_fail_or_are_kept_aside(spark, tmp_path):
    path = put(tmp_path, "o.csv", OFFICES + "x,C,Z,VA,1,a,b,c\n")
    with pytest.raises(Exception, match="MALFORMED"):
        files.load_csv(spark, path, schema_of("dental_offices")).collect()
    loose = files.load_csv(spark, path, schema_of("dental_offices"), strict=False)
    kept = rows(written(loose), "office_name", files.CORRUPT)
    assert [name for name, bad in kept if bad] == ["C"] and len(kept) == 3


def test_csv_round_trip(spark, lake, tmp_path):
    for name in ["appointments", "claims_and_payments"]:
        df = lake.bronze(name).select(*schema_of(name).fieldNames())
        paths = files.export_csv({name: df}, str(tmp_path))
        back = files.load_csv(spark, paths[name], schema_of(name))
        assert back.schema == schema_of(name)
        assert back.exceptAll(df.select([F.col(f.name).cast(f.dataType) for f in back.schema])).count() == 0
        assert back.count() == df.count()


def test_a_large_partition_is_written_to_several_files(spark, tmp_path, monkeypatch):
    """Cells may hold line breaks, so one task reads a whole file."""
    monkeypatch.setattr(files, "FILE_ROWS", 100)
    df = spark.range(0, 1000, 1, 1).selectExpr("id", "concat('a\n', id) AS word")
    path = files.export_csv({"w": df}, str(tmp_path))["w"]
    assert len(list((tmp_path / "w.csv").glob("*.csv"))) == 10
    assert rows(files.load_csv(spark, path, df.schema)) == rows(df)


def test_from_file_and_documents(spark, tmp_path):
    put(tmp_path / "raw", "a.csv", "x\n1\n")
    put(tmp_path / "raw", "b.csv", "x\n2\n")
    both = spark.read.option("header", "true").schema("x int").csv(str(tmp_path / "raw"))
    assert rows(files.from_file(both, "b.csv")) == [(2,)]
    put(tmp_path / "docs", "One (1).PDF", "x" * 10)
    put(tmp_path / "docs", "note.txt", "y")
    found = docs.scan_docs(spark, str(tmp_path / "docs"), ".pdf")
    assert [r["length"] for r in found.select("length").collect()] == [10]
    assert rows(docs.size_report(found, ".pdf")) == [(1, 0.0)]


def test_tables(spark, tmp_path):
    store = Store(spark, str(tmp_path), f"x{tmp_path.name.replace('-', '_')}_")
    assert store.create_if_missing(spark.range(3), "t").count() == 3
    assert store.create_if_missing(spark.range(9), "t").count() == 3
    with pytest.raises(ValueError, match="schema"):
        store.write_table(spark.range(2).withColumn("y", F.lit(1)), "t")
    assert store.write_table(spark.range(2).withColumn("y", F.lit(1)), "t", evolve=True).columns == ["id", "y"]
    layer = store.write_layer(spark.range(2), "silver", "t", "it's a layer")
    assert layer.columns == ["id", "_silver_loaded_at"]
    assert spark.catalog.getTable(store.name("t", "silver")).description == "it's a layer"


def test_bulk_load_reports_failures_and_goes_on(spark, tmp_path):
    store = Store(spark, str(tmp_path / "wh"), f"y{tmp_path.name.replace('-', '_')}_")
    good = put(tmp_path, "o.csv", OFFICES)
    out = store.bulk_load({"dental_offices": (good, schema_of("dental_offices")), "gone": (str(tmp_path / "no.csv"), None)})
    assert rows(out, "table_name", "rows", "status") == [("dental_offices", 2, "loaded"), ("gone", None, "failed")]
    assert out.filter("status = 'failed'").first()["error"]
    assert rows(files.preview({"o": store.read("dental_offices")}), "table_name", "row_count", "column_count", "sample_rows") == [("o", 2, 8, 2)]


def test_stream_restarts_add_only_new_files(spark, tmp_path):
    feed = ingest.Feed(str(tmp_path / "raw"), schema_of("dental_offices"), "offices*.csv")
    put(tmp_path / "raw", "offices_1.csv", OFFICES)
    put(tmp_path / "raw", "other.csv", "a\n1\n")
    args = (spark, feed, str(tmp_path / "ckpt"), str(tmp_path / "out"))
    assert ingest.copy_into(*args) == 2
    assert ingest.copy_into(*args) == 0
    put(tmp_path / "raw", "offices_2.csv", OFFICES)
    assert ingest.copy_into(*args) == 2
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 4 and back.filter("zip_code = '07832'").count() == 2
    assert ingest.stream_silver(
        spark, str(tmp_path / "out"), schema_of("dental_offices"), silver.dental_offices, str(tmp_path / "ck2"), str(tmp_path / "silver")
    ) == 4
    assert spark.read.parquet(str(tmp_path / "silver")).filter("state = 'MD'").count() == 2


def test_one_broken_stream_does_not_stop_the_others(spark, tmp_path):
    put(tmp_path / "good", "a.csv", OFFICES)
    put(tmp_path / "bad", "b.csv", OFFICES.replace("2,B", "oops,B"))
    feeds = {n: ingest.Feed(str(tmp_path / n), schema_of("dental_offices")) for n in ("good", "bad", "gone")}
    out = ingest.stream_ingest(spark, feeds, str(tmp_path / "root"))
    assert rows(out, "table_name", "rows", "status") == [("bad", None, "failed"), ("gone", None, "failed"), ("good", 2, "loaded")]


def test_stored_schema_evolves(spark, tmp_path):
    path = str(tmp_path / "schema")
    old = ingest.store_schema(spark, path, schema_of("insurance_networks"))
    assert ingest.stored_schema(spark, path) == old
    wider = spark.range(1).withColumn("network_id", F.col("id")).select("network_id", F.lit("x").alias("note")).schema
    assert ingest.evolve_schema(spark, path, wider).fieldNames() == [*old.fieldNames(), "note"]
    with pytest.raises(ValueError, match="type of network_id"):
        ingest.evolve_schema(spark, path, spark.createDataFrame([("a",)], "network_id string").schema)


CHUNKS = "chunk_id string, doc_uri string, chunk_to_embed string, version long"


def test_index_sync_is_incremental_and_repeatable(spark, tmp_path):
    src, index, ckpt = (str(tmp_path / n) for n in ("src", "index", "ckpt"))
    put_chunks = lambda *r: spark.createDataFrame(list(r), CHUNKS).coalesce(1).write.mode("append").parquet(src)
    put_chunks(("a0", "a", "x", 1), ("a1", "a", "y", 1), ("b0", "b", "z", 1))
    kind = spark.createDataFrame([], CHUNKS).schema
    assert sync.stream_sync(spark, src, kind, index, ckpt).count() == 3
    put_chunks(("a0", "a", "x2", 2), ("a2", "a", "new", 2), ("b0", "b", "z", 2))
    live = sync.stream_sync(spark, src, kind, index, ckpt)
    assert rows(live, "chunk_id", "chunk_to_embed") == [("a0", "x2"), ("a2", "new"), ("b0", "z")]
    log = rows(sync.change_log(spark, index).filter("batch = 1"), "chunk_id", "op")
    assert log == [("a0", "U"), ("a2", "I"), ("b0", "K")]
    again = spark.createDataFrame([("a0", "a", "x2", 2), ("a2", "a", "new", 2), ("b0", "b", "z", 2)], CHUNKS)
    sync.sync_batch(spark, again, 1, index)  # the batch runs once more after a failure
    assert rows(sync.change_log(spark, index).filter("batch = 1"), "chunk_id", "op") == log


def test_index_sync_takes_documents_in_parts_and_deletions(spark, tmp_path):
    index, part = str(tmp_path / "index"), iter(range(10))
    sync.begin(spark, index)
    put_batch = lambda *r: sync.sync_batch(spark, spark.createDataFrame(list(r), CHUNKS), next(part), index)
    live = lambda: rows(sync.current_index(sync.change_log(spark, index)), "chunk_id", "chunk_to_embed")
    put_batch(("c0", "d", "x", 1), ("c1", "d", "y", 1), ("e0", "e", "z", 1))
    put_batch(("c2", "d", "late", 1))  # a document over two batches keeps all its chunks
    assert live() == [("c0", "x"), ("c1", "y"), ("c2", "late"), ("e0", "z")]
    put_batch(("c0", "d", "b", 2), ("c0", "d", "a", 2))  # two rows for one chunk: the greater text
    assert live() == [("c0", "b"), ("e0", "z")]
    put_batch(("c9", "d", "stale", 1))  # an old version that comes late changes nothing
    assert live() == [("c0", "b"), ("e0", "z")]
    put_batch((None, "e", None, 2))
    assert live() == [("c0", "b")]
    sync.compact(spark, index, str(tmp_path / "small"))
    small = sync.change_log(spark, str(tmp_path / "small"))
    assert rows(sync.current_index(small), "chunk_id") == [("c0",)] and small.count() == 2
    put_batch(("e0", "e", "back", 3))
    assert live() == [("c0", "b"), ("e0", "back")]


def test_texts_of_a_batch_are_shuffled_once(spark, tmp_path, monkeypatch):
    index, src = str(tmp_path / "index"), str(tmp_path / "src")
    sync.begin(spark, index)
    spark.createDataFrame([("c0", "d", "x", 1), ("c1", "d", "y", 1)], CHUNKS).write.parquet(src)
    batch, put, plans = spark.read.parquet(src), sync.put, []
    sync.sync_batch(spark, batch, 0, index)
    monkeypatch.setattr(sync, "put", lambda entries, folder: plans.append(entries._jdf.queryExecution().executedPlan().toString()) or put(entries, folder))
    sync.sync_batch(spark, batch.withColumn("version", F.lit(2).cast("long")), 1, index)
    above, found = [], []
    for line in plans[0].splitlines():
        depth = re.search(r"[A-Za-z]", line).start() if re.search(r"[A-Za-z]", line) else 0
        above = [x for x in above if x[0] < depth] + [(depth, line)]
        if "FileScan" in line and "chunk_to_embed#" in line:
            found.append(sum("Exchange" in x for _, x in above))
    assert found == [1]
    assert rows(sync.change_log(spark, index).filter("batch = 1"), "chunk_id", "op") == [("c0", "K"), ("c1", "K")]


def test_a_batch_reads_only_the_buckets_of_its_documents(spark, tmp_path, monkeypatch):
    index = str(tmp_path / "index")
    sync.begin(spark, index)
    many = [(f"c{d}-{i}", f"doc{d}", f"text {i}", 1) for d in range(200) for i in range(3)]
    sync.sync_batch(spark, spark.createDataFrame(many, CHUNKS), 0, index)
    read = []
    plain = sync.change_log
    monkeypatch.setattr(sync, "current_index", lambda log, f=sync.current_index: read.append(log) or f(log))
    sync.sync_batch(spark, spark.createDataFrame([("c7-0", "doc7", "new", 2)], CHUNKS), 1, index)
    plan = read[0]._jdf.queryExecution().executedPlan().toString()
    own = plain(spark, index).filter("doc_uri = 'doc7'").select("bucket").distinct().collect()
    assert len(own) == 1 and f"bucket#" in plan and "PartitionFilters" in plan
    assert f"= {own[0][0]})" in plan or f"IN ({own[0][0]})" in plan
    assert rows(plain(spark, index).filter("batch = 1"), "chunk_id", "op") == [("c7-0", "U")]


def json_lines(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_a_stream_takes_up_new_fields(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "root")
    declared = spark.createDataFrame([], "id bigint, name string").schema
    load = lambda: ingest.evolving_stream(spark, str(raw), declared, root)
    json_lines(raw, "a.json", '{"id": 1, "name": "x"}', '{"id": 2}')
    assert load() == 2 and ingest.evolved(spark, root).columns == ["id", "name"]
    json_lines(raw, "b.json", '{"id": 3, "name": "y", "amount": 5, "seen": "2020-01-02"}', '{"id": 4, "amount": 7, "note": "n"}')
    assert load() == 2  # kept aside by the running stream, columns from now on
    out = ingest.evolved(spark, root)
    assert dict(out.dtypes) == {"id": "bigint", "name": "string", "amount": "bigint", "note": "string", "seen": "date"}
    assert rows(out, "id", "amount", "note") == [(1, None, None), (2, None, None), (3, 5, None), (4, 7, "n")]
    json_lines(raw, "c.json", '{"id": 5, "amount": 9}')
    assert load() == 1 and rows(ingest.evolved(spark, root), "id", "amount")[-1] == (5, 9) and load() == 0
    json_lines(raw, "d.json", '{"id": 6, "amount": "many"}')
    with pytest.raises(Exception, match="type of amount changed"):
        load()
    assert ingest.evolved(spark, root).count() == 5


def test_rows_that_differ_after_a_round_trip_are_counted(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, ""), (3, None)], "id long, t string")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, None), (4, "y")], "id long, t string")
    assert rows(files.differences(a, a, "t")) == [("t", 4, 0)] and rows(files.differences(a, b, "t")) == [("t", 4, 2)]


def test_a_table_that_came_back_whole_is_not_shuffled_by_row(spark, monkeypatch):
    """Its buckets agree; a swapped cell, a repeated and a missing row are found in any number of buckets."""
    df = spark.range(0, 3000, 1, 3).selectExpr("id", "concat('w', id % 7) AS word", "cast(id AS decimal(12,2)) AS money")
    same = files.differences(df, df.repartition(5), "t")
    assert rows(same) == [("t", 3000, 0)] and "sha2" not in same._jdf.queryExecution().analyzed().toString()
    changed = df.filter("id <> 11").selectExpr("id", "if(id = 5, '', word) AS word", "money").unionByName(df.filter("id = 8"))
    for buckets in (1, 1 << 16):
        monkeypatch.setattr(files, "DIFFERENCE_BUCKETS", buckets)
        assert rows(files.differences(df, changed, "t")) == [("t", 3000, 4)]
    assert rows(files.differences(df.limit(0), df.limit(0), "t")) == [("t", 0, 0)]


def test_quoted_cells_and_fractions(spark, tmp_path):
    schema = spark.createDataFrame([], "id bigint, note string").schema
    text = 'id,note\n1,"say ""hi"""\n2.0,"a ""b"" c, d"\n3,"two\nlines"\n,""\n'
    want = [(1, 'say "hi"'), (2, 'a "b" c, d'), (3, "two\nlines"), (None, "")]
    got = files.load_csv(spark, put(tmp_path, "q.csv", text), schema)
    assert sorted(rows(got), key=repr) == sorted([(i, n or None) for i, n in want], key=repr)
    path = files.export_csv({"q": got}, str(tmp_path / "out"))["q"]
    assert rows(files.load_csv(spark, path, schema)) == rows(got)
    half = put(tmp_path, "f.csv", "id,note\n1.55,x\n2,y\n")
    with pytest.raises(Exception, match="not a whole number"):
        files.load_csv(spark, half, schema).collect()
    loose = rows(written(files.load_csv(spark, half, schema, strict=False)))
    assert [(r[0], r[2] is not None) for r in loose] == [(2, False), (None, True)]


def test_the_package_is_shipped_once(spark):
    ship_package(spark)
    before = list(spark.sparkContext._python_includes)
    ship_package(spark)
    assert before == spark.sparkContext._python_includes and "crownledger.zip" in before


def test_session_helpers(spark):
    assert work_folder(spark) != work_folder(spark)
    assert shuffle_partitions(100 * 1024) > 500_000 and shuffle_partitions(0.01) == 8
    assert rows(written(spark.range(3))) == [(0,), (1,), (2,)]


def test_small_scans_are_spread_and_large_ones_pass(spark, lake):
    assert files.spread(lake.raw("pages"), "page_id").rdd.getNumPartitions() == 4
    many = spark.range(0, 100, 1, 9)
    assert files.spread(many, "id") is many

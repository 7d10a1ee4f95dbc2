"""Packed CSV files and shuffles that are gone with the job that made them."""

import time

import pytest
from pyspark.sql import functions as F
from support import rows

from crownledger.plans import registry, storage
from crownledger.sources import files
from crownledger.sources.scratch import written
from crownledger.streaming import ingest

PACKED = ["copy_into", "stream_silver", "csv_export", "bulk_load", "load_csv_ctas", "stream_ingest", "load_csv_infer"]


class Packed(Exception):
    pass


@pytest.mark.parametrize("name", PACKED)
def test_queries_pack_the_files_that_they_load(lake, monkeypatch, name):
    def write(df, path, mode, packed=False):
        raise Packed(packed)

    monkeypatch.setattr(files, "write_csv", write)
    with pytest.raises(Packed, match="True"):
        getattr(storage, name)(lake)


def test_packed_files_are_read_as_plain_ones(spark, tmp_path):
    df = spark.range(0, 3000, 1, 3).selectExpr("id", "concat('a ,\"b\"\n', id) AS word")
    plain, packed = (files.export_csv({"w": df}, str(tmp_path / x), packed=x == "packed")["w"] for x in ("plain", "packed"))
    assert rows(files.load_csv(spark, packed, df.schema)) == rows(files.load_csv(spark, plain, df.schema)) == rows(df)
    size = lambda x, ending: sum(p.stat().st_size for p in (tmp_path / x / "w.csv").glob(f"part-*{ending}"))
    assert 0 < 2 * size("packed", ".csv.gz") < size("plain", ".csv")
    feed = ingest.Feed(packed, df.schema)
    runs = [ingest.copy_into(spark, feed, str(tmp_path / "ledger"), str(tmp_path / "out")) for _ in range(2)]
    assert runs == [3000, 0] and rows(spark.read.parquet(str(tmp_path / "out"))) == rows(df)


def shuffles(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_a_write_leaves_no_shuffle_behind(spark, tmp_path):
    df = spark.range(0, 1000, 1, 4).groupBy((F.col("id") % 100).alias("k")).count()
    before = shuffles(spark)
    files.export_csv({"w": df}, str(tmp_path))
    assert written(df).count() == 100
    until = time.time() + 10
    while (left := shuffles(spark) - before) and time.time() < until:
        time.sleep(0.2)
    # the count of the rows that were read back has one of its own, of one row per task
    assert len({name.split("_")[1] for name in left}) <= 1
    assert df.count() == 100  # may be run again


def test_the_report_leaves_no_shuffle_behind(spark, lake):
    before = shuffles(spark)
    report = registry.load_all()["dq_report"](lake)
    until = time.time() + 10
    while (left := shuffles(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and report.count() == 74

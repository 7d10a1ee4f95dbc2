from support import rows

from crownledger.plans import storage
from crownledger.schemas import TABLES
from crownledger.sources import files


def test_preview_has_the_first_rows_of_a_table(spark):
    df = spark.createDataFrame([(10, "x"), (None, "b"), (2, None), (2, "a"), (30, "y")], "id long, word string").repartition(4)
    got = rows(files.preview({"t": df, "none": df.limit(0)}), "table_name", "row_count", "column_count", "sample_rows", "sample")
    assert got == [("none", 0, 2, 0, ""), ("t", 5, 2, 3, "NULL | b\n2 | NULL\n2 | a")]


def test_the_query_shows_the_rows_of_every_table(lake):
    got = {r["table_name"]: r for r in storage.table_preview(lake).collect()}
    assert list(got) == list(TABLES)
    assert all(len(r["sample"].split("\n")) == r["sample_rows"] == min(3, r["row_count"]) for r in got.values() if r["row_count"])

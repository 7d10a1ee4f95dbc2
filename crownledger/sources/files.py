"""Header CSV files in and out, with declared schemas."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crownledger.session import released_shuffles
from crownledger.sources import scratch

CORRUPT = "_corrupt_record"
_INTEGERS = (T.LongType, T.IntegerType, T.ShortType)


def text_schema(schema: T.StructType) -> T.StructType:
    """Schema to parse with: integers are read as DECIMAL, since a nullable one is often written ``1.0``.

    Read as an integer, such a cell would not parse and would turn into NULL. The scale is wide enough to
    see a fraction, which :func:`typed` does not let pass.
    """
    return T.StructType(
        [
            T.StructField(f.name, T.DecimalType(38, 18) if isinstance(f.dataType, _INTEGERS) else f.dataType)
            for f in schema.fields
        ]
    )


def typed(schema: T.StructType, strict: bool = True) -> list[Column]:
    """Columns in their declared types, after parsing with :func:`text_schema`.

    A fraction in an integer column fails a strict load; a tolerant one leaves the cell empty and names it in the
    column of bad rows, after the row's text if that did not parse either.
    """
    columns, bad = [], []
    for f in schema.fields:
        value = F.col(f.name)
        if isinstance(f.dataType, _INTEGERS):
            said = F.concat(F.lit(f"{f.name}: not a whole number: "), value.cast("string"))
            whole = F.when(value == F.floor(value), value)
            bad.append(F.when(value != F.floor(value), said))
            value = F.when(value.isNull() | (value == F.floor(value)), value).otherwise(F.raise_error(said)) if strict else whole
        columns.append(value.cast(f.dataType).alias(f.name))
    if not strict:
        found = F.concat_ws("; ", F.col(CORRUPT), *bad)
        columns.append(F.when(found != "", found).alias(CORRUPT))
    return columns


#: Rows of a file that is written, at most: one task reads a whole file if its cells may hold line breaks.
FILE_ROWS = 1 << 20
#: Quoted cells as in RFC 4180: a quote inside is doubled, and a cell may hold line breaks.
DIALECT = {"header": "true", "escape": '"', "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}


def csv_options(strict: bool, line_breaks: bool = True) -> dict[str, str]:
    """Header names are checked against the schema; strict reads fail on a bad cell instead of hiding it.

    A tolerant read keeps the text of a bad row aside. Spark only parses the columns that are selected, so
    write the whole rows to a table first, as the streams do, and look for bad rows there. Files whose cells
    may hold line breaks are read by one task each; without them, a large file is split.
    """
    mode = {"mode": "FAILFAST"} if strict else {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return {**DIALECT, "enforceSchema": "false", "multiLine": str(line_breaks).lower(), **mode}


def load_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, strict: bool = True, line_breaks: bool = True
) -> DataFrame:
    """CSV with a header. With a schema there is no inference pass and text keys keep leading zeros;
    without one the types are inferred, which reads the files twice."""
    if schema is None:
        return spark.read.options(**DIALECT, multiLine=str(line_breaks).lower(), inferSchema="true").csv(path)
    parse = text_schema(schema)
    if not strict:
        parse = parse.add(CORRUPT, T.StringType())
    df = spark.read.options(**csv_options(strict, line_breaks)).schema(parse).csv(path)
    return df.select(*typed(schema, strict))


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Rows of a scan over all cores, if it has fewer partitions than there are cores.

    A file with one row group is read by one task, and heavy work per row (parsing, tokenising, hashing)
    would stay there. Large inputs have more partitions than cores and pass through without a shuffle.
    The rows are placed by the hash of a key, so a recomputed task gets the same rows.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores, key)


def from_file(df: DataFrame, suffix: str) -> DataFrame:
    """Rows whose source file name ends with ``suffix``; for one table of a folder prefer a path glob,
    which never opens the other files."""
    return df.filter(F.col("_metadata.file_name").endswith(suffix))


#: A file whose cells may hold line breaks is read by one task, packed or not, so packing costs no parallelism.
PACKED = {"compression": "gzip"}


def export_csv(tables: Mapping[str, DataFrame], folder: str, packed: bool = False) -> dict[str, str]:
    """Every table as header CSV under ``folder/<name>.csv``; written in parallel, in files of at most ``FILE_ROWS`` rows.

    ``packed`` files are gzipped, which Spark reads as it reads plain ones. A table's shuffles are gone once it is written.
    """
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{folder}/{name}.csv"
        write_csv(df, paths[name], "overwrite", packed)
    return paths


def write_csv(df: DataFrame, path: str, mode: str, packed: bool = False) -> None:
    with released_shuffles(df.sparkSession):
        df.write.mode(mode).options(**DIALECT, maxRecordsPerFile=FILE_ROWS, **(PACKED if packed else {})).csv(path)


DIFFERENCE_BUCKETS = 1 << 16


def differences(written: DataFrame, read: DataFrame, name: str) -> DataFrame:
    """(table_name, row_count, different): rows of a table that was read back, and how many rows only one side has, repeats counted.

    Rows are dealt to buckets by their hash, and each side's tasks sum a bucket's rows and two 64-bit hashes of them. Buckets whose
    sums agree hold the same rows; only rows of the others are compared one by one, so that a table which came back whole is
    not shuffled. Runs a job. Empty texts count as null, as CSV does not tell them apart.
    """
    def rows(df: DataFrame, side: int) -> DataFrame:
        values = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in df.columns]
        row = F.to_json(F.struct(*[v.alias(c) for v, c in zip(values, df.columns)]))
        return df.select(row.alias("row"), F.lit(side).cast("bigint").alias("side"))

    both = rows(written, -1).unionByName(rows(read, 1))
    hashes = {"h": F.xxhash64("row"), "g": F.xxhash64(F.lit(1), "row")}
    # halves of the hashes, whose sums stay within 64 bits
    halves = {f"{x}{n}": part for x in hashes for n, part in enumerate((F.shiftright(x, 32), F.col(x).bitwiseAND(F.lit(0xFFFFFFFF))))}
    hashed = both.select("side", *[h.alias(x) for x, h in hashes.items()])
    per_bucket = hashed.groupBy(F.pmod("h", F.lit(DIFFERENCE_BUCKETS)).cast("int").alias("bucket")).agg(
        F.count_if(F.col("side") == 1).alias("n"), F.sum("side").alias("surplus"), *[F.sum(part * F.col("side")).alias(x) for x, part in halves.items()]
    )
    sums = scratch.written(per_bucket)
    unequal = sums.filter(" OR ".join(f"{c} <> 0" for c in ("surplus", *halves))).select("bucket")
    size = sums.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"))
    if unequal.isEmpty():
        return size.select(F.lit(name).alias("table_name"), "row_count", F.lit(0).cast("bigint").alias("different"))
    doubtful = both.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(DIFFERENCE_BUCKETS)).cast("int")).join(F.broadcast(unequal), "bucket", "left_semi")
    surplus = doubtful.groupBy(F.sha2("row", 256).alias("row")).agg(F.sum("side").alias("surplus"))
    different = surplus.agg(F.coalesce(F.sum(F.abs("surplus")), F.lit(0)).alias("different"))
    return size.crossJoin(different).select(F.lit(name).alias("table_name"), "row_count", "different")


def profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, columns and schema of each table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(len(df.columns)).cast("bigint").alias("column_count"),
            F.lit(", ".join(f"{c} {t}" for c, t in df.dtypes)).alias("schema"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _line(columns: Sequence[str]) -> Callable[[Column], Column]:
    """A row's cells as one text."""
    return lambda row: F.concat_ws(" | ", *[F.coalesce(row[c].cast("string"), F.lit("NULL")) for c in columns])


def preview(tables: Mapping[str, DataFrame], n: int = 3) -> DataFrame:
    """Rows and columns of each table with its first ``n`` rows in the order of its columns, nulls first.

    ``sample`` has a line of cells per row; a null is ``NULL``.
    """
    parts = []
    for name, df in tables.items():
        rows = F.sort_array(F.collect_list(F.struct(*df.columns)))
        sample = df.orderBy(*df.columns).limit(n).agg(F.transform(rows, _line(df.columns)).alias("sample"))
        size = df.agg(F.count(F.lit(1)).alias("row_count"))
        both = size.select("row_count", F.lit(None).cast("array<string>").alias("sample")).unionByName(
            sample.select(F.lit(None).cast("bigint").alias("row_count"), "sample")
        )
        parts.append(
            both.agg(F.max("row_count").alias("row_count"), F.max_by("sample", F.size("sample")).alias("sample")).select(
                F.lit(name).alias("table_name"),
                "row_count",
                F.lit(len(df.columns)).cast("bigint").alias("column_count"),
                F.size("sample").cast("bigint").alias("sample_rows"),
                F.array_join("sample", "\n").alias("sample"),
            )
        )
    return reduce(DataFrame.unionByName, parts)

"""Session defaults. Every setting can be overridden by the cluster; nothing here is machine specific."""

from __future__ import annotations

import math
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",  # also where it costs one more shuffle
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


PARTITION_MB = 192


def shuffle_partitions(data_gb: float) -> int:
    """Shuffle partitions so that one holds about ``PARTITION_MB`` of the data that is shuffled."""
    return max(8, math.ceil(data_gb * 1024 / PARTITION_MB))


def build_session(
    master: str | None = None, app: str = "crownledger", data_gb: float | None = None, **conf: str
) -> SparkSession:
    """A session with the engine's defaults; ``conf`` keys use ``__`` for dots.

    ``data_gb``, the size of the largest shuffle, sets the number of shuffle partitions. Adaptive
    execution merges small ones, but it cannot split an ordinary partition that is too large.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = {"spark.sql.shuffle.partitions": str(shuffle_partitions(data_gb))} if data_gb else {}
    for key, value in {**DEFAULTS, **sized, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


BATCH_BYTES = 8 << 20
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of ``BATCH_BYTES`` from now on, if the session allows larger ones.

    A task of whole texts or matrices holds some batches at once, in the JVM and in Python, and Spark's own bound is 64 MB.
    """
    digits, unit = re.match(r"(\d+)([kmgt]?)", spark.conf.get(ARROW_BYTES, "64m").lower()).groups()
    if int(digits) * 1024 ** " kmgt".index(unit or " ") > BATCH_BYTES:
        spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))


RELEASED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside remove their shuffle files as they end, not when the driver next collects its garbage.

    For jobs one after the other, such as the writes of many tables, whose shuffles would add up on disk. The DataFrames
    inside must be run once: another run would make its shuffles anew.
    """
    before = spark.conf.get(RELEASED, "false")
    spark.conf.set(RELEASED, "true")
    try:
        yield
    finally:
        spark.conf.set(RELEASED, before)


_local_roots: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and working tables: the cluster's ``spark.checkpoint.dir``.

    Only where it is unset on a local master (tests) a temporary folder is used, since on a cluster
    a machine-local folder would be lost together with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="crownledger-")
    return _local_roots[app]


def work_folder(spark: SparkSession) -> str:
    """A new folder name under :func:`checkpoint_root`, different for every call."""
    return f"{checkpoint_root(spark)}/crownledger/{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, once per application, so that functions that import it run there.

    A cluster where the package is installed does not need it; there the archive is only a copy.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="crownledger-ship-")
    archive = shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name)
    context.addPyFile(archive)
    _shipped.add(context.applicationId)

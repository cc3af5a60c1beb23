"""Session helpers: a builder for tests and benches, and lineage cutting."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cpus: int | str | None = None, app: str = "kindred") -> SparkSession:
    """Session for tests and benches on one machine; a cluster supplies its own."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("KINDRED_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and every executor see, without a trailing slash.

    It is the one the cluster names in ``spark.checkpoint.dir``, or else the one
    given to ``SparkContext.setCheckpointDir``.  A local session has one machine
    only and may fall back to a folder of its own, which is removed at exit; on a
    cluster a missing setting is an error, since executors would write to folders
    that nobody else can read.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_folder()


def fresh_folder(spark: SparkSession, kind: str) -> str:
    """Path of a new folder in the shared one, not made yet."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{kind}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    The written table outlives lost executors, and its known size lets Spark
    choose the next joins.
    """
    path = fresh_folder(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str, *order: str) -> DataFrame:
    """``df`` with a unique number ``name`` per row, written so that it never changes.

    With ``order`` the numbers follow it; rows are ranged, so no task sees them all.
    """
    if order:
        df = df.repartitionByRange(task_count(df.sparkSession), *order).sortWithinPartitions(*order)
    return cut_lineage(df.withColumn(name, F.monotonically_increasing_id()))


@cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="kindred-checkpoint-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` for a join that must not broadcast it, whatever size Spark guesses.

    Guesses come from files; derived texts and exploded rows can be a hundred times as large,
    and a broadcast passes whole through the driver.
    """
    return df.hint("merge")


def task_count(spark: SparkSession) -> int:
    """Tasks for heavy work: what the cluster sets for shuffles, one per core at least."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition by ``keys`` ahead of row-multiplying or heavy work.

    A fixed partition number keeps adaptive execution from merging small
    inputs into one task; a following aggregation on the same keys reuses it.
    """
    return df.repartition(task_count(df.sparkSession), *keys)

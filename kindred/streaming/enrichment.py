"""Incremental enrichment of newly arriving profile files.

The batch form re-reads the base table and skips finished rows.  Here Spark's
own progress log does the skipping: each run takes the files that arrived
since the last one, and a run that was cut short resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from kindred.operators.enrich import enrich


def run_enrichment(
    spark: SparkSession,
    source: str,
    target: str,
    progress: str,
    schema: StructType,
    column: str,
    resolve: Callable[[DataFrame], DataFrame],
    key: str = "player",
) -> StreamingQuery:
    """Enrich all new files under ``source`` once and write each batch under its own number.

    A repeated batch overwrites its own folder, so a restart adds nothing twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        enrich(batch, column, resolve, key).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return (
        spark.readStream.schema(schema).parquet(source)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )

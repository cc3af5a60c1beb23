"""Vector store: unit blocks as Parquet, partitioned by method.

The blend weight is applied at score time, so one stored copy of the two unit
blocks serves every weight and no blended matrix is kept or rebuilt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_vectors(vectors: DataFrame, path: str, method: str) -> None:
    """Store ``(row_id, player, stat, text)`` of one method, replacing only that method.

    All methods share one table, hence one element type.
    """
    tagged = vectors.withColumns({"method": F.lit(method), **{b: F.col(b).cast("array<double>") for b in ("stat", "text")}})
    tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("method").parquet(path)


def read_vectors(spark: SparkSession, path: str, method: str) -> DataFrame:
    """Vectors of one method; only its partition is read."""
    return spark.read.parquet(path).where(F.col("method") == method).drop("method")


def load_profiles(profiles: DataFrame, vectors: DataFrame) -> DataFrame:
    """Profiles with their vectors, paired by key."""
    return profiles.join(vectors.drop("player"), "row_id")

"""Table readers and writers: CSV with a schema, optional and alternate sources."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.functions.constants import ALTERNATE_COLUMNS, MIN_MINUTES, MODEL_FEATURES
from kindred.operators.quality import minimum_exposure, per90_rates
from kindred.session import cut_lineage


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


STRING, INT, DOUBLE = T.StringType(), T.IntegerType(), T.DoubleType()

VALUE_SCHEMA = _schema(
    player=STRING, squad=STRING, market_value_eur=DOUBLE, market_value_raw=STRING, position_detail=STRING,
    age_tm=INT, nationality_tm=STRING, contract_expires=STRING,
)
BENCHMARK_SCHEMA = _schema(query_player=STRING, similar_player=STRING, tm_rank=INT)
PROFILE_SCHEMA = _schema(
    row_id=T.LongType(), player=STRING, squad=STRING, league=STRING, pos=STRING, age=INT, nation=STRING, is_world_cup=INT,
    playing_time_min=DOUBLE, **{f: DOUBLE for f in MODEL_FEATURES}, market_value_eur=DOUBLE, match_score=DOUBLE, match_strategy=STRING,
)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with header; a given schema avoids the extra inference pass."""
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("nanValue", "nan")
    return (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)


def write_table(df: DataFrame, path: str, form: str = "parquet") -> None:
    """Full overwrite as Parquet, or as CSV with header."""
    writer = df.write.mode("overwrite")
    if form == "csv":  # quotes inside a value are doubled, as read_csv expects
        writer.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    else:
        writer.parquet(path)


def with_row_id(df: DataFrame, *order: str) -> DataFrame:
    """Stable ``row_id`` by a total order, numbered without one global window.

    Rows are range-partitioned and sorted; each partition's start is the sum
    of the counts before it, a table of one row per partition.  The placed
    rows are written once, so counts and numbers come from the same layout.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = placed.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
    placed = cut_lineage(placed)
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    numbered = placed.join(F.broadcast(starts), "_part")
    return numbered.withColumn("row_id", F.col("_start") + F.col("_at") - F.col("_first")).drop("_part", "_at", "_first", "_start")


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The CSV at ``path``, or None where there is none."""
    try:
        return read_csv(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def without_values(df: DataFrame) -> DataFrame:
    """Profiles when the value table is absent: an all-NULL value column."""
    return df.withColumn("market_value_eur", F.lit(None).cast("double"))


def map_alternate(df: DataFrame, threshold: float = MIN_MINUTES) -> DataFrame:
    """Alternate source in profile names, with threshold and the two rates it allows."""
    named = df.select(*[F.col(c).alias(ALTERNATE_COLUMNS.get(c, c)) for c in df.columns])
    if "playing_time_min" not in named.columns or "gls" not in named.columns:
        return named
    played = minimum_exposure(named, "playing_time_min", threshold)
    kept = played.select("*", *[F.col(c).alias(f"_{c}") for c in ("gls", "ast") if c in played.columns])
    rated = per90_rates(kept, "playing_time_min", ["gls", "ast"])
    return rated.drop("_gls", "_ast")

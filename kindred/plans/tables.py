"""Views over the driver tables, in Spark and as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.session import shuffled

# Position code per embedding label, used by the Spark view and by its SQL twin.
LABEL_POSITIONS = ["GK", "CB", "LB", "DM", "CM", "AM", "LW", "ST", "DF", "MF"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One profile per vector: part attributes, a position and the vector ``vec``."""
    e, p = table(spark, sf_dir, "embeddings"), table(spark, sf_dir, "part")
    return e.join(shuffled(p), e.vec_id == p.p_partkey).select(
        F.col("vec_id").alias("row_id"),
        F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string")).alias("player"),
        F.col("p_brand").alias("squad"),
        F.col("p_type").alias("league"),
        F.element_at(F.array(*[F.lit(x) for x in LABEL_POSITIONS]), F.col("label").cast("int") + 1).alias("pos"),
        F.col("p_size").cast("int").alias("age"),
        F.when(F.col("p_size") % 10 != 0, F.col("p_retailprice")).alias("market_value_eur"),
        F.when(F.col("p_size") % 3 == 0, 1).otherwise(0).alias("is_world_cup"),
        F.col("embedding").alias("vec"),
    )


PROFILES_SQL = f"""profiles AS (
  SELECT vec_id AS row_id, p_name || ' #' || p_partkey AS player, p_brand AS squad, p_type AS league,
         list_extract({LABEL_POSITIONS!r}, (label + 1)::INTEGER) AS pos, p_size AS age,
         CASE WHEN p_size % 10 <> 0 THEN p_retailprice END AS market_value_eur,
         CASE WHEN p_size % 3 = 0 THEN 1 ELSE 0 END AS is_world_cup,
         embedding::DOUBLE[] AS vec
  FROM embeddings JOIN part ON vec_id = p_partkey)"""


def block_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles with the vector cut into a statistics half and a text half."""
    half = F.size("vec") / 2
    return profiles(spark, sf_dir).withColumns(
        {
            "stat": F.slice("vec", F.lit(1), half.cast("int")),
            "text": F.slice("vec", half.cast("int") + 1, half.cast("int")),
        }
    ).drop("vec")


BLOCK_PROFILES_SQL = f"""{PROFILES_SQL},
halves AS (
  SELECT * EXCLUDE (vec), vec[1:len(vec)//2] AS stat, vec[len(vec)//2+1:len(vec)] AS text FROM profiles),
units AS (
  SELECT * EXCLUDE (stat, text),
         list_transform(stat, lambda x: x / sqrt(list_dot_product(stat, stat))) AS stat,
         list_transform(text, lambda x: x / sqrt(list_dot_product(text, text))) AS text FROM halves)"""


def part_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics per part from its line items, named like profile statistics."""
    li, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    stats = li.groupBy("l_partkey").agg(
        F.avg("l_discount").alias("gls_per90"),
        F.avg("l_tax").alias("ast_per90"),
        (F.avg("l_discount") + F.avg("l_tax")).alias("xg_per90"),
        (F.avg("l_quantity") / 10).alias("prog_carries_per90"),
        (F.avg("l_extendedprice") / 10000).alias("prog_passes_per90"),
        (F.max("l_quantity") / 10).alias("tackles_tkl_per90"),
        (F.min("l_quantity") / 10).alias("int_per90"),
        (F.avg(F.when(F.col("l_returnflag") == "R", 100.0).otherwise(0.0))).alias("pass_completion_pct"),
        F.count(F.lit(1)).alias("kp"),
    )
    return stats.join(shuffled(p), stats.l_partkey == p.p_partkey).select(
        F.col("p_partkey").alias("row_id"),
        F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string")).alias("player"),
        F.col("p_brand").alias("squad"),
        F.col("p_type").alias("league"),
        F.element_at(F.array(*[F.lit(x) for x in LABEL_POSITIONS]), (F.col("p_size") % 10).cast("int") + 1).alias("pos"),
        F.when(F.col("p_size") % 7 != 0, F.col("p_size")).cast("int").alias("age"),
        "gls_per90", "ast_per90", "xg_per90", "prog_carries_per90", "prog_passes_per90",
        "tackles_tkl_per90", "int_per90", "pass_completion_pct", "kp",
    )


PART_STATS_SQL = f"""part_stats AS (
  SELECT p_partkey AS row_id, p_name || ' #' || p_partkey AS player, p_brand AS squad, p_type AS league,
         list_extract({LABEL_POSITIONS!r}, (p_size % 10 + 1)::INTEGER) AS pos,
         CASE WHEN p_size % 7 <> 0 THEN p_size END AS age, s.*
  FROM (SELECT l_partkey, avg(l_discount) AS gls_per90, avg(l_tax) AS ast_per90,
               avg(l_discount) + avg(l_tax) AS xg_per90, avg(l_quantity) / 10 AS prog_carries_per90,
               avg(l_extendedprice) / 10000 AS prog_passes_per90, max(l_quantity) / 10 AS tackles_tkl_per90,
               min(l_quantity) / 10 AS int_per90,
               avg(CASE WHEN l_returnflag = 'R' THEN 100.0::DOUBLE ELSE 0.0 END) AS pass_completion_pct,
               count(*) AS kp
        FROM lineitem GROUP BY l_partkey) s JOIN part ON l_partkey = p_partkey)"""


# Letters that stand for hexadecimal digits when names are derived from keys.
_HEX, _LETTERS = "0123456789abcdef", "etaoinshrdlucmfw"


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One derived two-word name per part, with the brand as club."""
    digest = F.md5(F.col("p_partkey").cast("string"))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("row_id"),
        F.translate(F.substring(digest, 1, 10), _HEX, _LETTERS).alias("first"),
        F.translate(F.substring(digest, 11, 12), _HEX, _LETTERS).alias("last"),
        F.col("p_brand").alias("squad"),
        F.col("p_retailprice").alias("market_value_eur"),
    ).withColumn("player", F.concat_ws(" ", "first", "last"))


PEOPLE_SQL = f"""people AS (
  SELECT *, first || ' ' || last AS player FROM (
    SELECT p_partkey AS row_id, translate(substr(md5(p_partkey::VARCHAR), 1, 10), '{_HEX}', '{_LETTERS}') AS first,
           translate(substr(md5(p_partkey::VARCHAR), 11, 12), '{_HEX}', '{_LETTERS}') AS last,
           p_brand AS squad, p_retailprice AS market_value_eur FROM part))"""

"""Registered queries: tables, vectors and fitted models written to the shared folder and read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from kindred.operators import features as E
from kindred.operators.enrich import map_by_name
from kindred.plans import quality_queries as Q
from kindred.plans.registry import ORACLES, query
from kindred.plans.tables import BLOCK_PROFILES_SQL, block_profiles, part_stats, table
from kindred.session import fresh_folder
from kindred.sources import vectors as V
from kindred.sources.tables import VALUE_SCHEMA, read_csv, read_optional, write_table


@query(
    "csv_round_trip",
    """SELECT p_name AS player, p_brand AS squad, CASE WHEN p_size % 5 <> 0 THEN p_retailprice END AS market_value_eur,
              'EUR "' || p_size || '", ' || p_type AS market_value_raw, p_type AS position_detail, p_size::INTEGER AS age_tm,
              CASE WHEN p_size % 3 = 0 THEN p_type END AS nationality_tm, '202' || p_size % 10 AS contract_expires, FALSE AS has_alternate
       FROM part""",
)
def csv_round_trip(spark, sf_dir):
    """The value table as CSV and back under its schema; the alternate table is absent."""
    size = F.col("p_size")
    rows = table(spark, sf_dir, "part").select(
        F.col("p_name").alias("player"), F.col("p_brand").alias("squad"), F.when(size % 5 != 0, F.col("p_retailprice")).alias("market_value_eur"),
        F.concat(F.lit('EUR "'), size.cast("string"), F.lit('", '), "p_type").alias("market_value_raw"), F.col("p_type").alias("position_detail"),
        size.cast("int").alias("age_tm"), F.when(size % 3 == 0, F.col("p_type")).alias("nationality_tm"),
        F.concat(F.lit("202"), (size % 10).cast("string")).alias("contract_expires"),
    )
    folder = fresh_folder(spark, "csv")
    write_table(rows, f"{folder}/values", "csv")
    alternate = read_optional(spark, f"{folder}/alternate", VALUE_SCHEMA)
    return read_csv(spark, f"{folder}/values", VALUE_SCHEMA).withColumn("has_alternate", F.lit(alternate is not None))


@query(
    "vector_store",
    "WITH " + BLOCK_PROFILES_SQL + """
SELECT row_id, player, squad, 'stat' AS block, i::INTEGER AS dim, round(stat[i], 8) AS value FROM units, range(1, 33) r(i)
UNION ALL SELECT row_id, player, squad, 'text', i::INTEGER, round(text[i], 8) FROM units, range(1, 33) r(i)""",
)
def vector_store(spark, sf_dir):
    """Unit blocks of every profile through the store, beside the blocks of another method."""
    p = block_profiles(spark, sf_dir)
    path = fresh_folder(spark, "vectors")
    V.write_vectors(p.select("row_id", "player", F.col("text").alias("stat"), F.col("stat").alias("text")), path, "other")
    V.write_vectors(E.unit_blocks(p.select("row_id", "player", "stat", "text"), ["stat", "text"]), path, "plain")
    loaded = V.load_profiles(p.drop("stat", "text"), V.read_vectors(spark, path, "plain"))
    block = lambda name: loaded.select("row_id", "player", "squad", F.lit(name).alias("block"), F.posexplode(name).alias("d", "x"))
    return block("stat").unionByName(block("text")).select(
        "row_id", "player", "squad", "block", (F.col("d") + 1).alias("dim"), F.round("x", 8).alias("value")
    )


@query("embedder_store", ORACLES["standardise_features"])
def embedder_store(spark, sf_dir):
    """Standardised features of every row under an embedder that was saved and loaded."""
    s, path = part_stats(spark, sf_dir), fresh_folder(spark, "embedder")
    E.save_embedder(E.feature_moments(s, Q._FEATURES), None, path)
    moments, pca = E.load_embedder(spark, path, reduced=False)
    names = F.array(*[F.lit(f) for f in Q._FEATURES])
    return E.transform_rows(s, moments, pca, Q._FEATURES).select("row_id", F.posexplode("stat").alias("i", "v")).select(
        "row_id", F.element_at(names, F.col("i") + 1).alias("feature"), (F.round("v", 6) + 0.0).alias("value")
    )


@query(
    "map_by_name",
    """SELECT p_name AS player, p_partkey, v.value FROM part LEFT JOIN (
         SELECT p_name, max(p_retailprice) AS value FROM part WHERE p_size < 20 GROUP BY p_name) v USING (p_name)""",
)
def mapped_by_name(spark, sf_dir):
    """A value per name set on every row of that name; a name without one gets NULL."""
    p = table(spark, sf_dir, "part").withColumnRenamed("p_name", "player")
    values = p.where("p_size < 20").groupBy("player").agg(F.max("p_retailprice").alias("value"))
    return map_by_name(p.select("player", "p_partkey", F.lit(0.0).alias("value")), values, "player", "value")

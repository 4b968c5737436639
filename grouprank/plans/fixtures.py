"""Fixture frames over the driver's parquet tables.

item = order, entity = customer, group = market segment or nation, the nine
features = exact per-order min/max of line values plus the order total,
text = the document with the same number. Everything is derived from the
given tables by Spark, so the work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grouprank.operators.sampling import shuffle_tasks

#: Rows of line items of a task, where they are dealt by order; the number of tasks grows with the rows.
LINES_PER_TASK = 1_000_000

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fx_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    m = F.col("c_custkey") % 10
    seg, nat = F.col("c_mktsegment"), F.col("n_name")
    genres = (F.when(m == 0, F.lit("[]"))
               .when(m == 1, F.concat(F.lit("['"), seg, F.lit(" ']")))
               .when(m == 2, F.lit(None).cast("string"))
               .otherwise(F.concat(F.lit("['"), seg, F.lit("', '"), nat, F.lit("']"))))
    return (cust.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
                .select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"),
                        genres.alias("genres")))


def fx_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    # an order has few lines: they are smaller to shuffle than their extremes, and no task holds those of the orders it reads
    tasks = shuffle_tasks(li, -(-li.count() // LINES_PER_TASK))
    lines = li.select("l_orderkey", "l_quantity", "l_discount", "l_tax", "l_extendedprice").repartition(tasks, "l_orderkey")
    agg = lines.groupBy("l_orderkey").agg(
        F.min("l_quantity").alias("mn_q"), F.max("l_quantity").alias("mx_q"),
        F.min("l_discount").alias("mn_d"), F.max("l_discount").alias("mx_d"),
        F.min("l_tax").alias("mn_t"), F.max("l_tax").alias("mx_t"),
        F.min("l_extendedprice").alias("mn_p"), F.max("l_extendedprice").alias("mx_p"))
    k = F.col("o_orderkey")
    ks = k.cast("string")
    cust = F.col("o_custkey").cast("string")
    date = F.col("o_orderdate").cast("string")
    id_artists = (F.when(k % 20 == 0, F.concat(F.lit("['"), cust, F.lit("', 'x']")))
                   .when(k % 20 == 1, F.lit("[]"))
                   .otherwise(F.concat(F.lit("['"), cust, F.lit("']"))))
    release = (F.when(k % 50 == 2, F.lit("99")).when(k % 50 == 3, F.lit("abcd"))
                .when(k % 50 == 4, F.substring(date, 1, 4))
                .otherwise(F.substring(date, 1, 10)))
    return (orders.join(agg, k == F.col("l_orderkey"), "left")
                  .select(ks.alias("id"), F.concat(F.lit("Order "), ks).alias("name"),
                          (k % 100).cast("int").alias("popularity"),
                          id_artists.alias("id_artists"), release.alias("release_date"),
                          F.col("mn_q").alias("danceability"), F.col("mx_q").alias("energy"),
                          F.col("mn_d").alias("loudness"), F.col("mx_d").alias("speechiness"),
                          F.col("mn_t").alias("acousticness"), F.col("mx_t").alias("instrumentalness"),
                          F.col("mn_p").alias("liveness"), F.col("mx_p").alias("valence"),
                          F.col("o_totalprice").alias("tempo")))


def fx_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    m = F.col("doc_id") % 7
    text, empty = F.col("text"), F.lit("")
    synced = F.to_json(F.array(F.struct(empty.alias("plainLyrics"), text.alias("syncedLyrics")),
                               F.struct(F.lit("second").alias("plainLyrics"), empty.alias("syncedLyrics"))))
    plain = F.struct(text.alias("plainLyrics"))
    resp = (F.when(m == 0, F.lit("[]")).when(m == 1, synced).when(m == 2, F.lit("not json"))
             .when(m == 3, F.to_json(plain)).otherwise(F.to_json(F.array(plain))))
    return docs.select(F.col("doc_id").cast("string").alias("track_id"), resp.alias("response_json"))


def fx_lyrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    m = F.col("doc_id") % 7
    return docs.select(F.col("doc_id").cast("string").alias("track_id"), F.col("lang").alias("genre"),
                       F.when(m == 0, F.lit(None).cast("string")).otherwise(F.col("text")).alias("lyrics"),
                       (m != 0).alias("lyrics_found"))


def fx_vec_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(F.col("vec_id").alias("id"),
                      F.concat(F.lit("g"), (F.col("vec_id") % 4).cast("string")).alias("genre"),
                      F.col("label").alias("artist_id_primary"), "embedding")

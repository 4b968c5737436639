"""Connected components of links between ids, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grouprank.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id of links (a, b): the least id that it is joined to, itself included.

    Large-star and small-star rounds: every id is linked to the least of its neighbours, until nothing changes. Each
    round is written, so its plan doesn't grow and a lost executor costs one round at most. Only sums reach the driver.
    """
    ends = links.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a"))
    now = written(ends.where("a != b").select("a", "b").distinct(), "links")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first()
        if state == before or not state[0]:
            break
        before = state
        both = now.union(now.select("b", "a")).toDF("a", "b")
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x"))
        now = written(small.select("x.a", "x.b").where("a != b").distinct(), "links")
    roots = now.select(F.col("b").alias("id")).distinct().withColumn("component", F.col("id"))
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)

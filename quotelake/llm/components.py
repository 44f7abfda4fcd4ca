"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.session import work_folder

EDGES = "u long, v long"


def components(edges: DataFrame) -> DataFrame:
    """node, root: every node of an edge with the smallest node it can reach. edges: u, v.

    Each round points nodes at smaller ones they know of; the rounds needed grow with the logarithm of the longest path. Each round is
    written to the shared folder, so that plans stay short and lost executors cost one round.
    """
    now = _written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = None
    while True:
        now = _written(_small_star(_large_star(now)), "edges")
        found = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == found:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        state = found


def _written(edges: DataFrame, name: str) -> DataFrame:
    spark = edges.sparkSession
    store = work_folder(spark, name)
    edges.write.parquet(store)
    return spark.read.schema(EDGES).parquet(store)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    others = down.join(least.withColumnRenamed("u", "c"), F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()

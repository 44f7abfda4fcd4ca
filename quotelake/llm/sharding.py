"""Sharding by a two-pass external shuffle.

Pass one scatters the rows uniformly into buckets by a seeded hash; there are as many buckets as make each fit in a task's memory.
Pass two puts each bucket into random order (a Fisher-Yates shuffle) and writes it. The shuffled buckets one after the
other are a random order of all rows, of which shard s takes the rows from s * rows / shards on: the law ``rows``,
whose counts differ by one at most. Only bucket counts meet in one place.

A bucket that lies across the border of two shards is cut there. Null texts are kept and have no bytes. Rows with equal doc_id are
separate rows and spread by their other columns; rows equal in all columns are
spread too, where there are more than COPIES. Columns may have any name and any type, maps as well. Empty tables give no shards. Further columns are written too;
``shard`` and ``slot`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelake.llm.columns import quoted, row_hash
from quotelake.session import work_folder

BUCKET_BYTES = 24 << 20
ROW_BYTES = 64
COPIES = 1000


def shuffled(docs: DataFrame, shards: int, seed: int = 29, bucket_bytes: int = BUCKET_BYTES, copies: int = COPIES) -> DataFrame:
    """All columns of docs with shard and slot (place in the shard, from 0)."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).alias("bytes")).first()
    buckets = max(1, -(-(size["bytes"] or 0) // bucket_bytes))
    names = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    # by content, not by place: a task that runs again puts every row where it was before
    rows = docs.select(row_hash(docs, seed).alias("key"), F.struct(*map(quoted, names)).alias("row"))
    scattered = _spread_copies(rows, seed, copies).withColumn("bucket", F.pmod(F.col("key"), F.lit(buckets)).cast("int"))
    # one row per bucket; a table's rows over BUCKET_BYTES of it
    counts = scattered.groupBy("bucket").agg(F.count("*").alias("rows"))
    places = work_folder(spark, "shards")
    counts.select(
        F.col("bucket").alias("b"),
        (F.sum("rows").over(Window.orderBy("bucket")) - F.col("rows")).alias("before"),
        F.sum("rows").over(Window.partitionBy()).alias("all"),
    ).write.parquet(places)
    offsets = spark.read.schema("b int, before long, all long").parquet(places)
    # bucket n is all that partition n holds; the shuffle of a partition goes by the seed and its number
    by_key = lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)
    listed = scattered.repartitionById(buckets, "bucket").groupBy("bucket").agg(F.collect_list(F.struct("key", "row")).alias("rows"))
    gathered = listed.select("bucket", F.array_sort("rows", by_key).alias("rows"))
    dealt = gathered.select("bucket", F.posexplode(F.shuffle("rows", seed)).alias("at", "one"))
    first = lambda shard: F.expr(f"(({shard}) * all + {shards} - 1) div {shards}")
    return (
        dealt.join(offsets, F.col("bucket") == F.col("b"))
        .withColumn("place", F.col("before") + F.col("at"))
        .withColumn("shard", F.expr(f"cast((place * {shards}) div all as int)"))
        .withColumn("slot", F.col("place") - first("shard"))
        .select("one.row.*", "shard", "slot")
    )


def _spread_copies(rows: DataFrame, seed: int, copies: int) -> DataFrame:
    """key, row: rows equal in every column, where there are more than ``copies``, get a key each instead of one for all.

    Such rows are interchangeable, so one of them and their number is all that is sent; they are made again in lots of ``copies``.
    """
    spark = rows.sparkSession
    store = work_folder(spark, "copies")
    rows.groupBy(F.col("key").alias("k")).agg(F.count("*").alias("n")).where(F.col("n") > copies).write.parquet(store)
    hot = spark.read.schema("k long, n long").parquet(store)
    if hot.isEmpty():
        return rows
    one = rows.join(hot, F.col("key") == F.col("k")).dropDuplicates(["key"])
    lots = one.withColumn("lot", F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {copies}"))))
    held = F.least(F.lit(copies), F.col("n") - F.col("lot") * copies)
    made = (
        lots.repartition(F.col("key"), F.col("lot"))
        .withColumn("at", F.explode(F.sequence(F.lit(1), held.cast("int"))))
        .select(F.xxhash64(F.lit(seed), "key", "lot", "at").alias("key"), "row")
    )
    return rows.join(hot, F.col("key") == F.col("k"), "left_anti").union(made)


def write_shards(docs: DataFrame, folder: str, shards: int, seed: int = 29, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write the shards as Parquet below folder (shard=0, shard=1, ...) and return what was written."""
    out = shuffled(docs, shards, seed, bucket_bytes)
    out.write.partitionBy("shard").parquet(folder)
    columns = [c for c in out.columns if c != "shard"]
    schema = out.select(*columns, "shard").schema
    return docs.sparkSession.read.schema(schema).parquet(folder)

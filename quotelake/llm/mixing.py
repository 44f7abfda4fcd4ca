"""Mixing sources to target weights by weighted fair queueing.

Each document waits in its source's queue, in an order shuffled by a seeded hash. Its virtual finish time is the
number of words its source has served once it is through, divided by the source's target. A source whose target is
above its size is served again, up to a number of passes. All copies are then ranked by finish time over all sources and the
ranking is cut where the budget is spent, so at any time each source has had its share. The copy that crosses the budget is taken if
that brings the mixture nearer to it.

No queue is ever put in order as a whole. A source's queue is cut into cells by the shuffled hash, so that even one
source with most rows is spread evenly; cells are summed first (a map-side combine), and only the sums are accumulated per source.
The cut is found alike: all copies are counted by ranges of the finish time (equal ones up to twice the budget, ever wider ones beyond), and only
the range it falls into is sorted.

Null texts have size 0 and take nothing. A null source is a source of its own and comes last. Rows with equal
doc_id or equal content are mixed as separate rows. Further columns are kept by ``mixed``; names of this module's
own columns do not clash with them. Columns of any type, maps as well, count for the shuffled order. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelake.llm.columns import quoted, row_hash
from quotelake.session import work_folder

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
PASSES = 3
CELL_ROWS = 4096
RANGES = 16384


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = 1.0, passes: int = PASSES) -> DataFrame:
    """One row per source: source, source_size, target. sizes: source, source_size, one row each.

    Sources take the weights in turn, in code point order. The budget (a share of all words) goes out by weight; what
    lies above ``passes`` times a source's size is shared again among the others by weight until none is above. Filled
    from the lowest ratio of limit to weight up, that ends at one level for all sources below their limit.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("weight", F.element_at(cycle, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    limit = F.col("source_size") * float(passes)
    by_ratio = Window.orderBy(F.col("ratio"), F.col("source").asc_nulls_last())
    above = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    below = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    levels = (
        ranked.withColumn("limit", limit)
        .withColumn("ratio", F.col("limit") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything) * float(budget))
        .withColumn("level", (F.col("total") - F.coalesce(F.sum("limit").over(below), F.lit(0.0))) / F.sum("weight").over(above))
        # the sources at their limit are those whose ratio is below the level that would hold from them on
        .withColumn("full", F.col("ratio") <= F.col("level"))
        .withColumn("level", F.max(F.when(~F.col("full"), F.col("level"))).over(everything))
    )
    target = F.when(F.col("full"), F.col("limit")).otherwise(F.col("level") * F.col("weight"))
    return levels.select("source", "source_size", target.alias("target"))


def schedule(
    docs: DataFrame,
    seed: int = 17,
    weights: Sequence[float] = WEIGHTS,
    budget: float = 1.0,
    passes: int = PASSES,
) -> DataFrame:
    """One row per document: doc_id, source, key, size, source_size, target, finish, copies, taken.

    finish: the virtual time at which its first copy is through (1.0: the whole budget); copies: how many of its
    passes lie before the cut; taken: their words. key is the shuffled
    hash of the whole row.
    """
    spark = docs.sparkSession
    store = work_folder(spark, "mix")
    docs.select(
        "doc_id",
        "source",
        row_hash(docs, seed).alias("key"),
        word_count(F.col("text")).alias("size"),
    ).write.parquet(store)
    rows = spark.read.schema("doc_id long, source string, key long, size long").parquet(store)
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    targets = source_targets(sums.select("source", "source_size"), weights, budget, passes)
    # as many cells as keep each at about CELL_ROWS rows; one row per source, so the plan follows the count of sources
    sources = targets.join(sums.select(F.col("source").alias("s"), "rows"), F.col("source").eqNullSafe(F.col("s"))).select(
        "source", "source_size", "target", F.greatest(F.ceil(F.col("rows") / CELL_ROWS), F.lit(1)).cast("long").alias("cells")
    )
    store_sources = f"{store}-sources"
    sources.write.parquet(store_sources)
    sources = spark.read.schema("source string, source_size long, target double, cells long").parquet(store_sources)

    named = sources.select(F.col("source").alias("s"), "source_size", "target", "cells")
    celled = rows.join(named, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("cell", F.pmod(F.col("key"), F.col("cells")))
    by_source = Window.partitionBy("cs").orderBy("cc").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        celled.groupBy(F.col("source").alias("cs"), F.col("cell").alias("cc"))
        .agg(F.sum("size").alias("cell_size"))
        .select("cs", "cc", F.coalesce(F.sum("cell_size").over(by_source), F.lit(0)).alias("before"))
    )
    in_cell = Window.partitionBy("source", "cell").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    queued = (
        celled.join(before, F.col("source").eqNullSafe(F.col("cs")) & (F.col("cell") == F.col("cc")))
        .withColumn("served", F.col("before") + F.sum("size").over(in_cell))
        .select("doc_id", "source", "key", "size", "source_size", "target", "served")
    )
    store_queue = f"{store}-queue"
    queued.write.parquet(store_queue)
    queued = spark.read.schema(
        "doc_id long, source string, key long, size long, source_size long, target double, served long"
    ).parquet(store_queue)

    copies = (
        queued.where("size > 0")
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))).alias("pass"))
        .select("source", "size", _finish(F.col("pass")).alias("at"))
        .where(F.col("at").isNotNull())
        .withColumn("range", _range(F.col("at")))
    )
    total = sums.agg((F.coalesce(F.sum("source_size"), F.lit(0)) * float(budget)).alias("budget"))
    # RANGES * 2 rows, and RANGES for each doubling of the finish time, whatever the size of the corpus
    ranged = copies.groupBy("range").agg(F.sum("size").alias("words"))
    spent = ranged.select("range", (F.sum("words").over(Window.orderBy("range")) - F.col("words")).alias("spent"), "words")
    crossing = (
        spent.crossJoin(F.broadcast(total)).where(F.col("spent") + F.col("words") > F.col("budget")).orderBy("range").limit(1)
    )  # both sides are single aggregate rows
    last = copies.join(F.broadcast(crossing.select("range", "spent", "budget")), "range")
    # finish times of one source differ, so that no two copies share a place
    upto = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out_of = (
        last.withColumn("place", _place(F.col("at")))
        .withColumn("sum", F.col("spent") + F.sum("size").over(upto))
        .where(F.col("sum") > F.col("budget"))
        .withColumn("nearer", F.col("sum") - F.col("budget") < F.col("budget") - (F.col("sum") - F.col("size")))
    )
    cut = out_of.agg(F.min(F.struct("place", "nearer")).alias("cut"))
    before_cut = lambda at: F.col("cut").isNull() | (at < F.col("cut.place")) | ((at == F.col("cut.place")) & F.col("cut.nearer"))
    taken = [F.when(before_cut(_place(_finish(F.lit(k)))), 1).otherwise(0) for k in range(passes)]
    counted = sum(taken[1:], taken[0])
    served = F.when((F.col("size") > 0) & _finish(F.lit(0)).isNotNull(), counted).otherwise(0)
    return (
        queued.crossJoin(F.broadcast(cut))  # one row
        .select(
            "doc_id",
            "source",
            "key",
            "size",
            "source_size",
            "target",
            _finish(F.lit(0)).alias("finish"),
            served.cast("int").alias("copies"),
        )
        .withColumn("taken", F.col("copies") * F.col("size"))
    )


def _finish(passed: Column) -> Column:
    return F.when(F.col("target") > 0, (passed * F.col("source_size") + F.col("served")) / F.col("target"))


def _place(at: Column) -> Column:
    """The order of copies over all sources: by finish time, then by source with null last."""
    return F.struct(at.alias("at"), F.col("source").isNull().alias("nameless"), F.coalesce("source", F.lit("")).alias("source"))


def _range(at: Column) -> Column:
    """Number of the range of a finish time; rises with it."""
    beyond = F.floor((F.log2(F.greatest(at, F.lit(2.0))) - 1) * RANGES) + 2 * RANGES
    return F.when(at < 2, F.floor(at * RANGES)).otherwise(beyond)


def mixed(docs: DataFrame, seed: int = 17, weights: Sequence[float] = WEIGHTS, budget: float = 1.0, passes: int = PASSES) -> DataFrame:
    """The mixture itself: the taken copies with all columns of docs, in order of virtual finish time over the whole table.

    Rows equal in every column are interchangeable: the copies that their schedules take are made from one of them.
    """
    own = schedule(docs, seed, weights, budget, passes).where("copies > 0")
    rows = own.select(F.col("key").alias("_key"), "source_size", "target", "finish", "copies")
    texts = docs.select(F.struct(*map(quoted, docs.columns)).alias("_row"), row_hash(docs, seed).alias("_k")).dropDuplicates(["_k"])
    served = (
        texts.join(rows, F.col("_k") == F.col("_key"))
        .withColumn("_pass", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    )
    at = F.col("finish") + F.col("_pass") * F.col("source_size") / F.col("target")
    return served.select("_row", at.alias("_at"), "_k").repartitionByRange("_at", "_k").sortWithinPartitions("_at", "_k").select("_row.*")

"""Quality rules by an isolation forest on the statistics of texts.

Trees split a sample of documents at random values of random statistics. Documents that few splits set apart from the
rest have short paths and are anomalous: score = 2 ** (-mean path / expected path), near 1 for anomalies.

The statistic of a rule is how far a text lies outside the range that nearly all good labelled rows keep to (0: inside, 1: by
the width of the range or more). So good documents share one point, and few splits set the others apart. The threshold comes
from labelled rows as well: of all scores, the one with the best share of bad rows above it, less ``caution`` times the share of
good rows. Rows that fail the base rule are decided already and teach nothing.

The ranges and the threshold come from all labelled documents. Each tree is grown on ``TREE_ROWS`` rows, as the method has it; the trees draw
them from ``sample_rows`` labelled documents (those with the lowest hash of doc_id, from all of them). Every document's whole text is scored. Null texts count as empty (no words: the base rule rejects them). A
document of fewer than 50 words, or with over half of its words in repeated windows, fails the base rule. With no labelled rows of
either kind, only the base rule decides. Repeated doc_ids are scored row by row; labels of a repeated doc_id count once
(the lowest). Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quotelake.llm import textstats
from quotelake.llm.samples import sample
from quotelake.llm.textstats import STATISTICS, ratios, with_statistics
from quotelake.operators.quantiles import exact_quantiles
from quotelake.operators.series import BLOCK, with_earlier, within_block
from quotelake.operators.sizing import materialised, materialised_numbers

SAMPLE_ROWS = 6000
TREES = 100
TREE_ROWS = 64
OUTSIDE = 0.002
LEAST_WIDTH = 0.05
CAUTION = 10.0

# Blocks of the scores' range, by which they are put in order.
_BLOCKS = 1 << 16

_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


class Forest(NamedTuple):
    """All trees as flat arrays; leaves have feature -1 and carry their path length in ``split``."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray  # the right child follows the left
    roots: np.ndarray
    expected: float
    threshold: float = np.inf
    low: np.ndarray | None = None
    high: np.ndarray | None = None


def _mean_path(n: int) -> float:
    """The mean path of a search in a random tree of n rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


def grow(rows: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 5) -> Forest:
    random = np.random.default_rng(seed)
    feature: list[int] = []
    split: list[float] = []
    left: list[int] = []
    roots = []
    tree_rows = min(tree_rows, len(rows))
    limit = int(np.ceil(np.log2(max(tree_rows, 2)))) + 2

    def leaf() -> int:
        feature.append(-1), split.append(0.0), left.append(-1)
        return len(feature) - 1

    for _ in range(trees):
        roots.append(leaf())
        waiting = [(roots[-1], rows[random.choice(len(rows), tree_rows, replace=False)], 0)]
        while waiting:
            node, own, depth = waiting.pop()
            low, high = own.min(axis=0), own.max(axis=0)
            varied = np.flatnonzero(high > low)
            if depth >= limit or not len(varied):
                split[node] = depth + _mean_path(len(own))
                continue
            by = int(random.choice(varied))
            at = random.uniform(low[by], high[by])
            below = own[:, by] <= at
            feature[node], split[node], left[node] = by, at, leaf()
            leaf()
            waiting += [(left[node], own[below], depth + 1), (left[node] + 1, own[~below], depth + 1)]
    arrays = (np.array(feature), np.array(split), np.array(left), np.array(roots))
    return Forest(*arrays, max(_mean_path(tree_rows), 1.0))


def scores(forest: Forest, rows: np.ndarray) -> np.ndarray:
    total = np.zeros(len(rows))
    for root in forest.roots:
        node = np.full(len(rows), root)
        inner = np.flatnonzero(forest.feature[node] >= 0)
        while len(inner):
            at = node[inner]
            node[inner] = forest.left[at] + (rows[inner, forest.feature[at]] > forest.split[at])
            inner = inner[forest.feature[node[inner]] >= 0]
        total += forest.split[node]
    return 2.0 ** (-total / max(len(forest.roots), 1) / forest.expected)


def base_failed(s: dict[str, np.ndarray]) -> np.ndarray:
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


def excess(rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return np.clip(np.maximum(rows - high, low - rows) / np.maximum(high - low, LEAST_WIDTH), 0, 1)


def anomaly(forest: Forest, s: dict[str, np.ndarray]) -> np.ndarray:
    rows = ratios(s)
    return scores(forest, rows if forest.low is None else excess(rows, forest.low, forest.high))


def threshold(scored: DataFrame, caution: float = CAUTION) -> float:
    """The score above which rows are rejected; infinite where no score sets bad rows apart. scored: score, good (stored).

    The shares above each score come from counts of distinct scores, which are put in order within blocks of the score's range.
    """
    total = scored.agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")).head()
    if not total["good"] or not total["bad"]:
        return np.inf
    place = -F.col("score")
    counts = scored.groupBy("score").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    blocked = materialised_numbers(counts.withColumns({"place": place, BLOCK: F.floor(place * _BLOCKS)}), total["good"] + total["bad"], "scores")
    known = with_earlier(blocked, [], {f"{name}_before": (F.sum(name), F.sum) for name in ("good", "bad")})
    order = within_block([], ["place"])
    above = {name: (F.coalesce(f"{name}_before", F.lit(0)) + F.sum(name).over(order)).cast("double") / F.lit(total[name]) for name in ("good", "bad")}
    gains = known.select("score", (above["bad"] - F.lit(float(caution)) * above["good"]).alias("gain"))
    best = gains.orderBy(F.desc("gain"), F.desc("score")).head()
    if best["gain"] <= 0:
        return np.inf
    below = blocked.where(F.col("score") < best["score"]).agg(F.max("score").alias("score")).head()["score"]
    return (best["score"] + (best["score"] if below is None else below)) / 2


def labelled_statistics(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """quality, the statistics and doc_id of every labelled document that passes the base rule, stored. Texts are not shuffled, only their statistics are."""
    marked = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    keyed = docs.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    fields = [keyed.schema["doc_id"], keyed.schema["text_hash"], *[StructField(name, LongType()) for name in STATISTICS]]
    found = keyed.mapInArrow(lambda batches: with_statistics(batches, ("doc_id", "text_hash")), StructType(fields))
    # of several texts of an id, that of the least hash
    once = found.join(marked, "doc_id").groupBy("doc_id", "quality").agg(F.min(F.struct("text_hash", *STATISTICS)).alias("s"))
    passing = once.select("quality", *[F.col(f"s.{name}").alias(name) for name in STATISTICS], "doc_id").where(~F.expr(_FAILED))
    # a row per labelled id at most
    return materialised_numbers(passing, labels.count(), "labelled")


def bounds(stored: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """The range that nearly all good labelled rows keep to, by ratio; None without good rows."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = ratios({name: batch.column(name).to_numpy() for name in STATISTICS})
            place = np.tile(np.arange(rows.shape[1], dtype=np.int32), len(rows))
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(rows.ravel())], names=["ratio", "value"])

    values = materialised(stored.where("quality = 1").mapInArrow(listed, "ratio int, value double"), "ratios")
    found = exact_quantiles(values, "value", {"low": OUTSIDE, "high": 1 - OUTSIDE}, ["ratio"], len(textstats.RATIOS)).orderBy("ratio").collect()
    return (np.array([r["low"] for r in found]), np.array([r["high"] for r in found])) if found else None


def scored_rows(stored: DataFrame, forest: Forest) -> DataFrame:
    """score, good of each labelled row."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = anomaly(forest, {name: batch.column(name).to_numpy() for name in STATISTICS})
            good = batch.column("quality").to_numpy() == 1
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(good)], names=["score", "good"])

    return materialised(stored.mapInArrow(scored, "score double, good boolean"), "scored")


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, caution: float = CAUTION) -> Forest:
    stored = labelled_statistics(docs, labels)
    kept_to = bounds(stored)
    if kept_to is None:
        return grow(np.zeros((1, len(textstats.RATIOS))), 0)
    low, high = kept_to
    # what the trees draw their rows from, so the collected rows have a bound
    drawn = sample(stored, "doc_id", sample_rows, 11).select("quality", *STATISTICS).toPandas()
    drawn = drawn.sort_values(list(drawn.columns), kind="stable")
    rows = excess(ratios({name: drawn[name].to_numpy() for name in STATISTICS}), low, high)
    forest = grow(rows)._replace(low=low, high=high)
    return forest._replace(threshold=threshold(scored_rows(stored, forest), caution))


def judge(docs: DataFrame, forest: Forest) -> DataFrame:
    """doc_id, the statistics, base_failed, anomaly, kept: one row per document."""
    schema = "doc_id long, " + ", ".join(f"{name} long" for name in STATISTICS) + ", anomaly double"

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in with_statistics(batches, ("doc_id",)):
            found = {name: batch.column(name).to_numpy() for name in STATISTICS}
            yield batch.append_column("anomaly", pa.array(anomaly(forest, found)))

    return (
        docs.select("doc_id", "text")
        .mapInArrow(judged, schema)
        .withColumn("base_failed", F.expr(_FAILED))
        .withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < F.lit(float(forest.threshold))))
    )


def kept_documents(docs: DataFrame, forest: Forest) -> DataFrame:
    """The documents that pass, with all their columns: each task judges the rows it has read, so nothing is joined or shuffled."""

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = textstats.batch_statistics(batch.column("text"))
            yield batch.filter(pa.array(~base_failed(found) & (anomaly(forest, found) < forest.threshold)))

    return docs.mapInArrow(passing, docs.schema)

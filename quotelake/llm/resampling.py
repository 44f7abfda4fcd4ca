"""Importance resampling of documents towards a target distribution, by hashed n-gram features.

A text's features are its runs of up to ``longest`` consecutive words, joined by one space; a feature's bucket is the CRC-32 of its bytes,
modulo ``buckets``. Both tables are counted by bucket (each task adds up its own texts first). A bucket's gain is the smoothed log ratio of its shares in the target and in
the documents, and a document's weight the mean gain of its features. Adding Gumbel noise drawn from a hash of the document's id and
keeping the highest scores draws without replacement in proportion to the exponentiated weights.

The CRCs are computed on length-bucketed matrices: the distinct features of a slice of texts are grouped by equal length into two-dimensional
uint8 arrays, one step of the CRC table updates all features of a length at once, column by column, and the buckets are scattered back to the
places of the features. Matrices are cut at MATRIX_BYTES. Features longer than LONG_BYTES hardly ever share a length and go through zlib one by one.

Ranks need no order over all documents: scores are whole numbers within a range that the logarithms bound, so they are counted first; only documents at
or above the score that the draw ends at are numbered, within their score, from counts by (score, doc_id, stored part).

A null or empty text has no features and weight 0. Rows with equal doc_id have the same noise and are drawn as separate rows; their ranks follow each
other. A null doc_id counts as the empty one in the noise and comes before others among equal scores. Extra columns are ignored. With an empty table of documents the result
is empty; with an empty target all gains follow from the smoothing alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelake.llm import words as W
from quotelake.llm.terms import Terms, term_slices
from quotelake.session import work_folder

BUCKETS = 10_000
LONGEST = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = "2024"
MATRIX_BYTES = 4 << 20
LONG_BYTES = 2048

_POLYNOMIAL = 0xEDB88320


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1)
    return table


_TABLE = _crc_table()


def crc_matrix(matrix: np.ndarray) -> np.ndarray:
    """The CRC-32 of each row of a uint8 matrix, all rows a column at a time."""
    crc = np.full(len(matrix), 0xFFFFFFFF, np.uint32)
    for column in np.ascontiguousarray(matrix.T):
        crc = _TABLE[(crc ^ column) & 0xFF] ^ (crc >> 8)
    return ~crc


def crc_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The CRC-32 of each span of data, by matrices of spans of equal length."""
    out = np.zeros(len(starts), np.uint32)
    lengths = ends - starts
    by_length = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[by_length])) + 1
    for rows in np.split(by_length, cuts) if len(by_length) else []:
        length = int(lengths[rows[0]])
        if length > LONG_BYTES:
            for k in rows:
                out[k] = zlib.crc32(data[starts[k] : ends[k]].tobytes())
            continue
        step = max(1, MATRIX_BYTES // max(length, 1))
        for at in range(0, len(rows), step):
            part = rows[at : at + step]
            out[part] = crc_matrix(data[starts[part, None] + np.arange(length)])
    return out


def features(t: Terms, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end in data, and the text (counted from the slice's first), of every run of up to ``longest`` terms."""
    text = np.repeat(np.arange(t.last - t.first), np.diff(t.bounds))
    starts, ends, own = [], [], []
    for n in range(1, longest + 1):
        run = max(len(text) - n + 1, 0)
        same = text[:run] == text[n - 1 : n - 1 + run]
        starts.append(t.starts[:run][same])
        ends.append(t.ends[n - 1 : n - 1 + run][same])
        own.append(text[:run][same])
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(own)


def feature_buckets(t: Terms, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every feature of a slice, and the text it belongs to. Each distinct feature is hashed once."""
    starts, ends, own = features(t, longest)
    _, first, place = np.unique(W.span_hashes(t.data, starts, ends), return_index=True, return_inverse=True)
    return (crc_spans(t.data, starts[first], ends[first]) % np.uint32(buckets)).astype(np.int64)[place], own


def bucket_counts(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: the features of all texts by bucket. Each task adds up its texts, so a task sends ``buckets`` rows at most."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            for t in term_slices(batch.column("text")):
                n += np.bincount(feature_buckets(t, longest, buckets)[0], minlength=buckets)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(n[some])], names=["bucket", "n"])

    counts = texts.select("text").mapInArrow(counted, "bucket int, n long")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> list[int]:
    """floor(1000 * ln(target share / documents' share)) of each bucket, both smoothed by one per bucket; ``buckets`` numbers on the driver."""
    s = bucket_counts(docs, longest, buckets).withColumnRenamed("n", "s")
    t = bucket_counts(target, longest, buckets).withColumnRenamed("n", "t")
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = every.join(s, "bucket", "left").join(t, "bucket", "left").na.fill(0, ["s", "t"]).collect()
    all_s, all_t = sum(r["s"] for r in both), sum(r["t"] for r in both)
    out = [0] * buckets
    for r in both:
        out[r["bucket"]] = int(np.floor(1000 * np.log((r["t"] + 1.0) * (all_s + buckets) / ((r["s"] + 1.0) * (all_t + buckets)))))
    return out


def weighed(docs: DataFrame, gain: list[int], longest: int = LONGEST) -> DataFrame:
    """doc_id, n_words, n_features, weight of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(np.array(gain, np.int64))

    def weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = sent.value
        for batch in batches:
            ids = batch.column("doc_id")
            for t in term_slices(batch.column("text")):
                rows = t.last - t.first
                bucket, own = feature_buckets(t, longest, len(of))
                n = np.bincount(own, minlength=rows)
                total = np.zeros(rows, np.int64)
                np.add.at(total, own, of[bucket])
                columns = [np.diff(t.bounds), n, np.where(n > 0, total // np.maximum(n, 1), 0)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(t.first, rows).cast(pa.int64()), *[pa.array(c.astype(np.int64)) for c in columns]],
                    names=["doc_id", "n_words", "n_features", "weight"],
                )

    return docs.select("doc_id", "text").mapInArrow(weights, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: str = SEED) -> Column:
    """floor(1000 * Gumbel noise) from the first 32 bits of a hash of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: str = SEED,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; rank is null where it is not drawn.

    Drawn are the floor(percent * N / 100) highest scores of the N documents with at least ``least_words`` words.
    """
    spark = docs.sparkSession
    store = work_folder(spark, "resampled")
    made = weighed(docs, gains(docs, target, longest, buckets), longest)
    # the part a row is stored in tells rows of equal doc_id apart, once it is written
    made.withColumns({"score": F.col("weight") + gumbel(F.col("doc_id"), seed), "part": F.spark_partition_id()}).write.parquet(store)
    rows = spark.read.schema("doc_id long, n_words long, n_features long, weight long, score long, part int").parquet(store)

    eligible = F.col("n_words") >= least_words
    scores = rows.where(eligible).groupBy("score").agg(F.count("*").alias("n"))
    # one row per whole score: some 100,000 at any number of documents
    higher = scores.select(
        F.col("score").alias("at"), F.sum("n").over(Window.orderBy(F.desc("score"))).alias("upto"), "n", F.sum("n").over(Window.partitionBy()).alias("all")
    )
    drawn = F.floor(F.col("all") * percent / 100)
    reached = higher.withColumn("drawn", drawn).where(F.col("upto") - F.col("n") < F.col("drawn")).withColumn("above", F.col("upto") - F.col("n"))
    last = reached.agg(F.min("at").alias("cut"), F.max("drawn").alias("drawn")).head()
    others = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if last["cut"] is None:
        return rows.select(*others, none)
    chosen = eligible & (F.col("score") >= last["cut"])
    candidates = rows.where(chosen)
    cells = candidates.groupBy("score", "doc_id", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_first(), "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.join(reached.select("at", "above"), F.col("score") == F.col("at")).select(
        F.col("score").alias("s"),
        F.col("doc_id").alias("d"),
        F.col("part").alias("p"),
        (F.col("above") + F.coalesce(F.sum("n").over(before), F.lit(0))).alias("start"),
    )
    own = Window.partitionBy("score", "doc_id", "part").orderBy("n_features")
    same = (F.col("score") == F.col("s")) & F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("part") == F.col("p"))
    numbered = candidates.withColumn("k", F.row_number().over(own)).join(starts, same)
    rank = F.col("start") + F.col("k")
    ranked = numbered.select(*others, F.when(rank <= last["drawn"], rank).cast("long").alias("rank"))
    return ranked.unionByName(rows.where(~chosen).select(*others, none))

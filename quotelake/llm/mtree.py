"""Exact top-k search by inner product over M-trees.

Inner products become distances by one more coordinate: with M the greatest norm in a tree, an item x gets sqrt(M^2 - |x|^2) and a query
0, so that distance^2 = |q|^2 + M^2 - 2 q.x. In that space each tree has pages of items around a routing item, with the page's covering
radius, each item's distance to the routing item and the routing items' distances to the root's. The search opens pages in order of their least
possible distance, ends when that is beyond the k-th result, and by the triangle inequality skips routing items and items whose stored
distance already puts them out of reach. Scores are exact integers: distances (with a margin for rounding) only decide what is computed.

Items are dealt to trees of about TREE_ROWS by a hash of their id and stored as one row per tree; queries are packed in blocks. Every block meets every
tree (the stated queries against all rows), and gives its best k of that tree; ranks follow from those. No task holds more than a tree and a block.

Null vectors and those with a null or non-finite component take no part. Vectors of other lengths are only compared among themselves. Rows
with a null id take no part; of rows with equal ids, the one with the least vector counts. Ties go to the smaller id. Extra columns are
ignored; an empty table gives an empty result. Scores are exact while they stay below 2^53.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelake.session import work_folder

TREE_ROWS = 32768
PAGE_ROWS = 1024
BLOCK_QUERIES = 2048
MARGIN = 1e-6


class Tree(NamedTuple):
    """Pages one after the other; the first item of a page is its routing item."""

    ids: np.ndarray
    items: np.ndarray
    to_routing: np.ndarray  # distance of each item to its page's routing item
    starts: np.ndarray  # of the pages, and the end
    radius: np.ndarray
    to_root: np.ndarray  # distance of each routing item to the first page's
    top: float  # M^2


def _lift(items: np.ndarray, top: float) -> np.ndarray:
    return np.sqrt(np.maximum(top - (items**2).sum(axis=1), 0))


def _distances(items: np.ndarray, lift: np.ndarray, k: int) -> np.ndarray:
    return np.sqrt(((items - items[k]) ** 2).sum(axis=1) + (lift - lift[k]) ** 2)


def build(ids: np.ndarray, items: np.ndarray, page_rows: int = PAGE_ROWS) -> Tree:
    """Halve the items between two far ones until they fit a page; the routing item is the one nearest to the page's mean."""
    order = np.argsort(ids, kind="stable")
    ids, items = ids[order], items[order]
    top = float((items**2).sum(axis=1).max())
    lift = _lift(items, top)
    pages, waiting = [], [np.arange(len(ids))]
    while waiting:
        own = waiting.pop()
        if len(own) <= page_rows:
            pages.append(own)
            continue
        a = int(_distances(items[own], lift[own], 0).argmax())
        from_a = _distances(items[own], lift[own], a)
        from_b = _distances(items[own], lift[own], int(from_a.argmax()))
        nearer = np.argsort(from_a - from_b, kind="stable")  # halves stay equal, even if all items are the same
        waiting += [own[nearer[len(own) // 2 :]], own[nearer[: len(own) // 2]]]
    laid, to_routing, radius = [], [], []
    for own in pages:
        middle = ((items[own] - items[own].mean(axis=0)) ** 2).sum(axis=1) + (lift[own] - lift[own].mean()) ** 2
        k = int(middle.argmin())
        own = np.concatenate((own[k : k + 1], np.delete(own, k)))
        laid.append(own)
        to_routing.append(_distances(items[own], lift[own], 0))
        radius.append(to_routing[-1].max())
    every = np.concatenate(laid)
    starts = np.concatenate(([0], np.cumsum([len(p) for p in laid])))
    heads = every[starts[:-1]]
    return Tree(ids[every], items[every], np.concatenate(to_routing), starts, np.array(radius), _distances(items[heads], lift[heads], 0), top)


def search(tree: Tree, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best items other than the query's own: ids and scores, best first."""
    reach = float((query**2).sum()) + tree.top
    distance = lambda score: np.sqrt(max(reach - 2 * score, 0.0))
    margin = MARGIN * (1 + np.sqrt(reach))
    heads = tree.items[tree.starts[:-1]]
    root = distance(float(heads[0] @ query))
    ids, scores, limit, worst = np.zeros(0, np.int64), np.zeros(0), np.inf, -np.inf
    # (least possible distance, page, distance to its routing item if known)
    waiting = [(max(abs(root - d) - r, 0.0), p, -1.0) for p, (d, r) in enumerate(zip(tree.to_root.tolist(), tree.radius.tolist(), strict=True))]
    heapq.heapify(waiting)
    while waiting:
        least, page, known = heapq.heappop(waiting)
        if least > limit + margin:
            break
        if known < 0:
            known = distance(float(heads[page] @ query))
            heapq.heappush(waiting, (max(known - tree.radius[page], least, 0.0), page, known))
            continue
        rows = slice(tree.starts[page], tree.starts[page + 1])
        items, own = tree.items[rows], tree.ids[rows]
        if limit < np.inf:
            inside = np.abs(known - tree.to_routing[rows]) <= limit + margin
            if not inside.all():
                items, own = items[inside], own[inside]
        found = items @ query
        good = (found >= worst) & (own != query_id)
        if not good.any():
            continue
        ids, scores = np.concatenate((ids, own[good])), np.concatenate((scores, found[good]))
        if len(ids) > k:
            order = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[order], scores[order]
        if len(ids) == k:
            worst = float(scores.min())
            limit = distance(worst)
    order = np.lexsort((ids, -scores))
    return ids[order], scores[order]


def whole_numbers(embedding: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component; null if the vector or a component is null or not finite."""
    x = F.transform(embedding, lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(embedding.isNotNull() & finite & (F.size(embedding) > 0), F.transform(x, lambda v: F.floor(v * scale).cast("double")))


TREES = "dim int, tree long, n int, ids binary, items binary, to_routing binary, starts binary, radius binary, to_root binary, top double"
BLOCKS = "dim int, block long, query_ids binary, queries binary"


def _rows(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column("vec_id").to_numpy()
    vectors = table.column("vector").combine_chunks()
    return ids, vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)


def _built(table: pa.Table) -> pa.Table:
    ids, items = _rows(table)
    tree = build(ids, items)
    row = {"dim": table.column("dim")[0].as_py(), "tree": table.column("tree")[0].as_py(), "n": len(ids), "top": tree.top}
    row |= {name: getattr(tree, name).tobytes() for name in ("ids", "items", "to_routing", "radius", "to_root")}
    row["starts"] = tree.starts.astype(np.int64).tobytes()
    kinds = {"dim": pa.int32(), "tree": pa.int64(), "n": pa.int32(), "top": pa.float64()}
    return pa.table({name: pa.array([row[name]], kinds.get(name, pa.binary())) for name in (part.split()[0] for part in TREES.split(", "))})


def _packed(table: pa.Table) -> pa.Table:
    ids, items = _rows(table)
    order = np.argsort(ids, kind="stable")
    return pa.table(
        {
            "dim": table.column("dim")[:1].cast(pa.int32()),
            "block": table.column("block")[:1].cast(pa.int64()),
            "query_ids": pa.array([ids[order].tobytes()], pa.binary()),
            "queries": pa.array([items[order].tobytes()], pa.binary()),
        }
    )


def _searched(k: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {name: batch.column(name)[r] for name in batch.schema.names}
                floats = lambda name: np.frombuffer(row[name].as_buffer(), np.float64)  # noqa: B023, E731
                longs = lambda name: np.frombuffer(row[name].as_buffer(), np.int64)  # noqa: B023, E731
                dim = row["dim"].as_py()
                tree = Tree(
                    longs("ids"), floats("items").reshape(-1, dim), floats("to_routing"), longs("starts"), floats("radius"), floats("to_root"), row["top"].as_py()
                )
                query_ids, results = longs("query_ids"), []
                for query_id, query in zip(query_ids.tolist(), floats("queries").reshape(-1, dim), strict=True):
                    results.append(search(tree, query_id, query, k))
                counts = [len(ids) for ids, _ in results]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(query_ids, counts)),
                        pa.array(np.concatenate([ids for ids, _ in results])),
                        pa.array(np.concatenate([scores for _, scores in results]).astype(np.int64)),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

    return found


def _stored(df: DataFrame, purpose: str, schema: str) -> DataFrame:
    spark = df.sparkSession
    store = work_folder(spark, purpose)
    df.write.parquet(store)
    return spark.read.schema(schema).parquet(store)


def index(vectors: DataFrame, tree_rows: int = TREE_ROWS) -> DataFrame:
    """One row per tree. vectors: vec_id, vector (of doubles), dim."""
    trees = max(1, -(-vectors.count() // tree_rows))
    dealt = vectors.withColumn("tree", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(trees)))
    return _stored(dealt.groupBy("dim", "tree").applyInArrow(_built, TREES), "trees", TREES)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, tree_rows: int = TREE_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score. queries: rows as in vectors."""
    trees = index(vectors, tree_rows)
    blocks = max(1, -(-queries.count() // block_queries))
    dealt = queries.withColumn("block", F.pmod(F.xxhash64(F.lit(2), "vec_id"), F.lit(blocks)))
    packed = _stored(dealt.groupBy("dim", "block").applyInArrow(_packed, BLOCKS), "queries", BLOCKS)
    homes = trees.select(F.col("dim").alias("d"), F.col("tree").alias("t"))
    met = packed.join(homes, F.col("dim") == F.col("d")).drop("d")
    pairs = trees.join(met.withColumnRenamed("dim", "d"), (F.col("dim") == F.col("d")) & (F.col("tree") == F.col("t"))).drop("d", "t", "tree", "block", "n")
    best = pairs.mapInArrow(_searched(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def prepared(embeddings: DataFrame) -> DataFrame:
    """vec_id, vector, dim of the rows that take part; stored, as it is used more than once."""
    rows = embeddings.select(F.col("vec_id").cast("long"), whole_numbers(F.col("embedding")).alias("vector")).where("vec_id is not null and vector is not null")
    least = rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    return _stored(least.withColumn("dim", F.size("vector")), "vectors", "vec_id long, vector array<double>, dim int")

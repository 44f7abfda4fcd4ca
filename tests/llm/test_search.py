import numpy as np
import pytest

from quotelake.llm import mtree


def brute(rows, k, picked):
    ids = np.array([i for i, _ in rows])
    items = np.array([v for _, v in rows])
    out = []
    for q in np.flatnonzero(picked(ids)):
        score = items @ items[q]
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[q]][:k]
        out += [(int(ids[q]), n + 1, int(ids[j]), int(score[j])) for n, j in enumerate(order)]
    return sorted(out)


@pytest.mark.parametrize("spread", [1, 3, 40])
def test_search_skips_nothing(spread):
    """Small numbers give many ties."""
    random = np.random.default_rng(spread)
    centres = random.integers(-20, 20, (6, 8))
    items = (centres[random.integers(0, 6, 900)] + random.integers(-spread, spread + 1, (900, 8))).astype(float)
    ids = random.permutation(5000)[:900]
    tree = mtree.build(ids, items, page_rows=40)
    assert sorted(tree.ids.tolist()) == sorted(ids.tolist())
    for q in range(60):
        found, scores = mtree.search(tree, int(ids[q]), items[q], 20)
        score = items @ items[q]
        want = [j for j in np.lexsort((ids, -score)) if j != q][:20]
        assert found.tolist() == ids[want].tolist() and scores.tolist() == score[want].tolist()


def test_pages_keep_their_bounds():
    random = np.random.default_rng(0)
    items = random.integers(-9, 9, (700, 5)).astype(float)
    tree = mtree.build(np.arange(700), items, page_rows=50)
    lift = np.sqrt(tree.top - (tree.items**2).sum(axis=1))
    for p, (a, b) in enumerate(zip(tree.starts, tree.starts[1:], strict=False)):
        d = np.sqrt(((tree.items[a:b] - tree.items[a]) ** 2).sum(axis=1) + (lift[a:b] - lift[a]) ** 2)
        assert b - a <= 50 and np.allclose(d, tree.to_routing[a:b]) and tree.radius[p] == pytest.approx(d.max())


def test_far_pages_are_not_opened(monkeypatch):
    random = np.random.default_rng(3)
    centres = random.normal(size=(20, 6)) * 100
    items = np.round(np.repeat(centres, 50, axis=0) + random.normal(size=(1000, 6)))
    tree = mtree.build(np.arange(1000), items, page_rows=50)
    opened = []

    class Seen(np.ndarray):
        def __matmul__(self, other):
            opened.append(self.shape)
            return np.asarray(self) @ other

    tree = tree._replace(items=tree.items.view(Seen))
    mtree.search(tree, 0, items[0], 10)
    assert sum(len(s) == 2 for s in opened) < 10


def test_table(spark, small):
    rows = [(r["vec_id"], np.floor(64 * np.array(r["embedding"], float))) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    vectors = mtree.prepared(spark.read.parquet(f"{small}/embeddings.parquet"))
    got = mtree.top_k(vectors, vectors.where("vec_id % 20 = 0"), 20, tree_rows=100, block_queries=7).collect()
    assert sorted(map(tuple, got)) == brute(rows, 20, lambda ids: ids % 20 == 0)


def test_edges(spark):
    rows = [
        (0, [0.5, 1.0]),
        (1, None),
        (2, [None, 1.0]),
        (3, [float("nan"), 1.0]),
        (4, [float("inf"), 1.0]),
        (5, [-0.01, 0.0]),
        (6, [0.5, 1.0]),
        (7, [0.5, 1.0]),
        (7, [0.5, 1.0]),
        (8, [1.0, 2.0, 3.0]),
        (9, []),
        (None, [1.0, 1.0]),
        (20, [0.5, 1.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as score", "2 as dim")
    vectors = mtree.prepared(df)
    got = mtree.top_k(vectors, vectors.where("vec_id % 20 = 0"), 20).collect()
    kept = [(0, [32.0, 64.0]), (5, [-1.0, 0.0]), (6, [32.0, 64.0]), (7, [32.0, 64.0]), (20, [32.0, 64.0])]
    assert sorted(map(tuple, got)) == brute(kept, 20, lambda ids: ids % 20 == 0)
    none = mtree.prepared(df.where("false"))
    assert mtree.top_k(none, none, 20).count() == 0

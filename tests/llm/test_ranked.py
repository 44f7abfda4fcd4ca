import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from quotelake.llm import ranked
from tests.llm.conftest import edge_rows, prose
from tests.llm.test_resampling import words


def brute(docs, items, k=20):
    """(doc_id, text) and (item_id, text) rows to sorted (item_id, rank, doc_id, score)."""
    held = [(doc_id, Counter(words(text))) for doc_id, text in docs if doc_id is not None and words(text)]
    n, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for t, d in df.items()}
    least = {}
    for item_id, text in items:
        if item_id is not None and text is not None:
            least[item_id] = min(text, least.get(item_id, text))
    out = []
    for item_id, text in least.items():
        scored = []
        for doc_id, c in held:
            m = 100 - 25 + (25 * sum(c.values()) * n) // length
            score = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in words(text) if t in c)
            if score > 0:
                scored.append((-score, doc_id))
        out += [(item_id, r + 1, doc_id, -score) for r, (score, doc_id) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def collected(df):
    return sorted((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect())


def made_segment(seed, rows=600, terms=40, copies=150):
    random = np.random.default_rng(seed)
    vectors = random.integers(1, 50, (rows, terms)) * (random.random((rows, terms)) < 0.2)
    vectors[:, 0] = random.integers(1, 9, rows)  # a term of every document
    vectors[:copies] = vectors[0]
    row, term = np.nonzero(vectors)
    bounds = np.searchsorted(row, np.arange(rows + 1))
    return vectors, ranked.Segment(random.permutation(rows).astype(np.int64), bounds, term, vectors[row, term].astype(float))


@pytest.mark.parametrize("seed", range(4))
def test_blocks_are_skipped_by_bounds_that_hold(seed):
    vectors, segment = made_segment(seed)
    every = [np.arange(40) for _ in range(40)]
    lists = ranked.blocked_lists(segment, every, block_rows=16)
    for term, blocked in enumerate(lists):
        assert sorted(blocked.rows.tolist()) == np.flatnonzero(vectors[:, term]).tolist()
        for b, (x, y) in enumerate(zip(blocked.bounds, blocked.bounds[1:], strict=False)):
            assert (blocked.summary[b] == vectors[blocked.rows[x:y]].max(axis=0)).all()


@pytest.mark.parametrize("seed", range(4))
def test_search_skips_no_result(seed):
    vectors, segment = made_segment(seed, rows=900)
    random = np.random.default_rng(seed)
    lists = ranked.blocked_lists(segment, [np.arange(40) for _ in range(40)], block_rows=16)
    scored = 0
    for _ in range(40):
        terms = random.choice(40, 4, replace=False)
        times = random.integers(1, 3, 4)
        best = ranked.Best(10)
        scored += ranked.search(segment, lists, terms, times, best)
        score = vectors[:, terms] @ times
        want = [r for r in np.lexsort((segment.ids, -score)) if score[r] > 0][:10]
        assert best.ids.tolist() == segment.ids[want].tolist() and best.scores.tolist() == score[want].tolist()
    assert scored < 40 * 900 * 0.9


def test_similar_documents_share_blocks():
    random = np.random.default_rng(0)
    kinds = random.integers(0, 8, 400)
    vectors = np.zeros((400, 33))
    vectors[:, 0] = 5
    for r, kind in enumerate(kinds):
        vectors[r, 1 + 4 * kind : 5 + 4 * kind] = random.integers(20, 30, 4)
    row, term = np.nonzero(vectors)
    segment = ranked.Segment(np.arange(400), np.searchsorted(row, np.arange(401)), term, vectors[row, term])
    blocked = ranked.blocked_lists(segment, [np.arange(33) for _ in range(33)], block_rows=20)[0]
    mixed = [len(set(kinds[blocked.rows[x:y]])) for x, y in zip(blocked.bounds, blocked.bounds[1:], strict=False)]
    assert np.mean(mixed) < 1.5


@pytest.mark.parametrize(("segment_rows", "group_terms", "block_terms"), [(8192, 4096, 4_000_000), (7, 6, 40)])
def test_against_brute_force(spark, edge_docs, monkeypatch, segment_rows, group_terms, block_terms):
    monkeypatch.setattr(ranked, "SEGMENT_ROWS", segment_rows)
    monkeypatch.setattr(ranked, "GROUP_TERMS", group_terms)
    items = [(1, "The RIVER river rose"), (2, None), (3, ""), (4, "nothing-of-it zzz"), (None, "river"), (5, prose(5, 30)), (6, "日本 é"), (7, prose(25, 60)), (7, prose(24, 60))]
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as score", "2 as terms")
    docs = edge_docs.selectExpr("*", "1 as n", "2 as tf", "3 as terms", "map(1, 2) as rank")
    got = ranked.ranked(docs, table, block_terms=block_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert collected(got) == brute([(r[0], r[1]) for r in edge_rows()], items)


def test_ties_and_repeated_rows(spark):
    docs = [(9, "a b c")] * 30 + [(k, "a b c") for k in range(30)] + [(k, "b") for k in range(100, 140)]
    items = [(1, "c"), (2, "a b b"), (3, "b")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = ranked.ranked(df, spark.createDataFrame(items, "item_id long, text string"))
    assert collected(got) == brute(docs, items)


def test_table(spark, small, small_docs):
    items = spark.read.parquet(f"{small}/benchmark.parquet")
    want = brute([(r["doc_id"], r["text"]) for r in small_docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert collected(ranked.ranked(small_docs, items)) == want


def test_empty_tables(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "river")], "item_id long, text string")
    assert ranked.ranked(no_docs, items).count() == 0
    assert ranked.ranked(edge_docs, items.where("false")).count() == 0


def test_groups_hold_their_bound():
    bounds = np.array([0, 3, 5, 9, 10])
    items = ranked.Items(np.arange(4), bounds, np.array([1, 2, 3, 2, 3, 4, 5, 6, 7, 1]), np.ones(10, np.int64))
    groups = ranked.grouped(items, 3)
    assert [g[0].tolist() for g in groups] == [[0, 1], [2], [3]]
    together = defaultdict(set)
    for own, vocabulary, with_it in groups:
        assert len(own) == 1 or len(vocabulary) <= 3
        for term, w in zip(vocabulary, with_it, strict=True):
            together[term] |= set(vocabulary[w])
    assert together[2] == {1, 2, 3} and together[7] == {4, 5, 6, 7}

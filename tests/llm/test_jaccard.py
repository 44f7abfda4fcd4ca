import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quotelake.llm import jaccard
from quotelake.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def shingle_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 4:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 4]) for k in range(len(words) - 3))


def brute(rows):
    """All pairs: (doc_id, n, component)."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            both = len(x & y)
            if x and y and 100 * both >= 85 * (len(x) + len(y) - both):
                parent[find(a)] = find(b)
    least = defaultdict(lambda: None)
    for k, (i, s) in enumerate(sets):
        if i is not None:
            r = find(k)
            least[r] = i if least[r] is None else min(least[r], i)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    return sorted(((i, len(s), least[find(k)] if s else i) for k, (i, s) in enumerate(sets)), key=key)


def got(docs):
    return sorted((tuple(r) for r in jaccard.grouped(docs).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def near_rows():
    """Chains of near copies of all sizes around the boundary and beyond."""
    random = np.random.default_rng(3)
    rows, n = [], 0
    for words in [1, 2, 3, 4, 5, 8, 9, 10, 11, 12, 14, 15, 16, 17, 18, 20, 23, 30, 60, 200]:
        base = [f"w{words}x{k}" for k in range(words)]
        for copy in range(6):
            own = list(base)
            for _ in range(copy % 3 if words > 7 else 0):
                own[int(random.integers(len(own)))] = f"z{n}"
            if copy == 4:
                own.append("tail")
            if copy == 5:
                own = own[: max(1, words - 1)]
            rows.append((n, " ".join(own) if copy % 2 else "  ".join(own).upper()))
            n += 1
        base[len(base) // 2] = "half"
    return rows


def test_small_table(small_docs):
    assert got(small_docs) == brute([(r["doc_id"], r["text"]) for r in small_docs.collect()])


def test_near_copies(spark):
    rows = near_rows()
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == brute(rows)


def test_edges(edge_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert got(edge_docs.withColumn("key", F.lit(1)).withColumn("n", F.lit(2))) == brute(rows)
    assert got(no_docs) == []


def test_first_of_groups(edge_docs, no_docs):
    rows = jaccard.first_of_groups(edge_docs).collect()
    assert rows and rows[0].asDict().keys() == set(edge_docs.columns)
    kept = sorted(r["doc_id"] for r in rows if r["doc_id"] is not None)
    want = {c for i, n, c in brute([(r["doc_id"], r["text"]) for r in edge_docs.collect()]) if i is not None}
    assert kept == sorted(want)
    assert jaccard.first_of_groups(no_docs).count() == 0


def test_two_scans_on_a_large_group(spark):
    base = [f"b{k}" for k in range(120)]
    rows = [(i, " ".join(w if (k * 31 + i * 17) % 97 else f"c{i}x{k}" for k, w in enumerate(base))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(docs) == brute(rows)


@pytest.mark.parametrize("s", range(1, 40))
def test_overlap_is_what_the_threshold_needs(s):
    t = jaccard.Threshold(85, 100)
    for other in range(1, 60):
        sharing = [o for o in range(min(s, other) + 1) if 100 * o >= 85 * (s + other - o)]
        assert (other in t.partners(s)) == bool(sharing)
        if sharing:
            assert t.overlap(s, other) == sharing[0]
            assert t.prefix(s) >= s - sharing[0] + 1


def test_boundary_follows_cost():
    t = jaccard.Threshold(85, 100)
    assert 1 <= jaccard.boundary({s: 100 for s in range(1, 30)}, t) < 14
    assert jaccard.boundary({}, t) == jaccard.MOST_SMALL  # nothing to compare costs nothing


def test_components(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, 200), (300, 200), (300, 400), (7, 7)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{k: 0 for k in range(51)}, 100: 100, 200: 100, 300: 100, 400: 100}


def test_shared_counts_are_never_too_low():
    """Two n-grams of a set that agree in the bits sent both count; copies of a set in other stretches do not."""

    def stretch(tokens, ids):
        a = np.array(tokens, np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()
        return 0, False, a, np.array(ids, np.uint64).view(np.uint8).reshape(-1, 8)[:, :5].T.tobytes()

    rows = [stretch([5, 5, 9, 11], [1, 1, 1, 1]), stretch([5, 9], [2, 2]), stretch([5, 5, 9, 11], [1, 1, 1, 1])]
    kinds = (pa.int32(), pa.bool_(), pa.binary(), pa.binary())
    table = pa.table({n: pa.array(c, kind) for n, c, kind in zip(("p", "counts", "a", "b"), zip(*rows, strict=True), kinds, strict=True)})
    found = jaccard._all_shared(jaccard._shared(table, 3)).to_pylist()
    assert sorted((r["id"], r["shared"]) for r in found) == [(1, 3), (2, 2)]


def test_first_of_groups_with_any_columns(edge_docs):
    docs = edge_docs.selectExpr("*", "1 _key", "2 _id", "3 _k", "4 `a.b`", "map('x', doc_id) m")
    made = jaccard.first_of_groups(docs)
    assert made.columns == docs.columns
    want = sorted(r["doc_id"] for r in jaccard.first_of_groups(edge_docs).collect() if r["doc_id"] is not None)
    assert sorted(r["doc_id"] for r in made.collect() if r["doc_id"] is not None) == want
    assert {(r["_key"], r["_id"], r["_k"], r["a.b"]) for r in made.collect()} == {(1, 2, 3, 4)}

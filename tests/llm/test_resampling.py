import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quotelake.llm import resampling
from quotelake.llm.terms import term_slices
from tests.llm.conftest import edge_rows

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, target, percent, least, longest, buckets):
    """(doc_id, text) rows to sorted (doc_id, n_features, weight, score) and the drawn ones in order."""

    def hashed(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    s, t = Counter(b for _, x in docs for b in hashed(x)), Counter(b for x in target for b in hashed(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    rows = []
    for doc_id, text in docs:
        f = hashed(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(f), weight, score, len(words(text)) >= least))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    return [r[:4] for r in rows], able[: percent * len(able) // 100]


def check(got, docs, target, percent=10, least=20, longest=1, buckets=10_000):
    rows, drawn = brute(docs, target, percent, least, longest, buckets)
    key = lambda r: tuple((v is not None, v or 0) for v in r)
    assert sorted((tuple(r[:4]) for r in got), key=key) == sorted(rows, key=key)
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r["doc_id"], r["score"]) for r in ranked] == [(r[0], r[3]) for r in drawn]


def test_crc_matrix():
    random = np.random.default_rng(0)
    for n in (0, 1, 7, 300):
        matrix = random.integers(0, 256, (50, n)).astype(np.uint8)
        assert resampling.crc_matrix(matrix).tolist() == [zlib.crc32(row.tobytes()) for row in matrix]


def test_crc_spans_of_all_lengths(monkeypatch):
    monkeypatch.setattr(resampling, "MATRIX_BYTES", 100)
    monkeypatch.setattr(resampling, "LONG_BYTES", 40)
    random = np.random.default_rng(1)
    data = random.integers(0, 256, 5000).astype(np.uint8)
    starts = random.integers(0, 4900, 400)
    ends = starts + random.integers(0, 60, 400)
    want = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
    assert resampling.crc_spans(data, starts, ends).tolist() == want


@pytest.mark.parametrize("slice_bytes", [1, 30, 1 << 20])
def test_terms(slice_bytes):
    texts = ["", None, "One two", "é-日本 x_Y", "...", "tail", "Ünder 9lives", " lead", "a" * 100, "end "]
    got = defaultdict(list)
    for t in term_slices(pa.array(texts), slice_bytes):
        for k in range(t.last - t.first):
            for j in range(t.bounds[k], t.bounds[k + 1]):
                got[t.first + k].append(t.data[t.starts[j] : t.ends[j]].tobytes().decode())
    assert [got[k] for k in range(len(texts))] == [words(x) for x in texts]


@pytest.mark.parametrize(("longest", "buckets", "percent"), [(1, 10_000, 10), (2, 64, 50), (3, 1000, 100)])
def test_against_brute_force(spark, edge_docs, longest, buckets, percent):
    target = [None, "", "The river ROSE for days", "boats and rain, boats"]
    table = spark.createDataFrame([(k, x) for k, x in enumerate(target)], "item_id long, text string")
    clashing = edge_docs.selectExpr("*", "1 as score", "2 as bucket", "3 as part", "4 as n", "map(1, 2) as weight")
    got = resampling.resampled(clashing, table, percent, longest=longest, buckets=buckets).collect()
    check(got, [(r[0], r[1]) for r in edge_rows()], target, percent, 20, longest, buckets)


def test_repeated_rows_get_ranks_of_their_own(spark):
    docs = [(7, "same words " * 20)] * 40 + [(k, f"word{k} " * 30) for k in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    target = spark.createDataFrame([(1, "same")], "item_id long, text string")
    check(resampling.resampled(df, target, 50).collect(), docs, ["same"], 50)


def test_table(spark, small, small_docs):
    target = spark.read.parquet(f"{small}/benchmark.parquet")
    got = resampling.resampled(small_docs, target).collect()
    check(got, [(r["doc_id"], r["text"]) for r in small_docs.collect()], [r["text"] for r in target.collect()])


def test_empty_tables(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert resampling.resampled(no_docs, none).count() == 0
    check(resampling.resampled(edge_docs, none).collect(), [(r[0], r[1]) for r in edge_rows()], [])
    short = edge_docs.where(F.length("text") < 10)
    assert resampling.resampled(short, none).where("rank is not null").count() == 0

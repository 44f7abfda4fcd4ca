import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotelake.llm import repeats, suffixes
from tests.llm.conftest import edge_rows, prose


def brute(docs, length=50):
    """(doc_id, text) rows to sorted (doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    first = {}
    raws = [(doc_id, (text or "").encode()) for doc_id, text in docs]
    for doc_id, raw in raws:
        if doc_id is not None:
            for k in range(len(raw) - length + 1):
                string = raw[k : k + length]
                first[string] = min(doc_id, first.get(string, doc_id))
    out = []
    for doc_id, raw in raws:
        gone = bytearray(len(raw))
        if doc_id is not None:
            for k in range(len(raw) - length + 1):
                if first[raw[k : k + length]] < doc_id:
                    gone[k : k + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(raw)) if gone[k] and (not k or not gone[k - 1]))
        out.append((doc_id, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))


def digest(df):
    rows = []
    for r in df.collect():
        spans = [(s["start"], s["end"]) for s in r["spans"]]
        assert spans == sorted(spans) and all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))
        rows.append((r["doc_id"], r["n_bytes"], sum(b - a for a, b in spans), len(spans), hashlib.sha256(r["kept"]).hexdigest()))
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))


@pytest.mark.parametrize("long_names", [4, 30_000])
def test_suffix_array_and_prefixes(monkeypatch, long_names):
    monkeypatch.setattr(suffixes, "LONG_NAMES", long_names)
    random = np.random.default_rng(4)
    for _ in range(150):
        symbols = int(random.integers(1, 5))
        text = np.append(random.integers(1, symbols + 1, random.integers(0, 70)), 0)
        own = text.tolist()
        want = sorted(range(len(own)), key=lambda i: own[i:])
        array = suffixes.suffix_array(text, symbols + 1)
        assert array.tolist() == want
        shared = suffixes.permuted_common_prefixes(text, array)
        for a, b in zip(want, want[1:], strict=False):
            n = next(k for k in range(len(own)) if own[a + k] != own[b + k])
            assert shared[b] == n


@pytest.mark.parametrize("long_names", [4, 30_000])
def test_long_runs_and_periods(monkeypatch, long_names):
    monkeypatch.setattr(suffixes, "LONG_NAMES", long_names)
    for raw in (b"a" * 3000, b"ab" * 1500, b"abcab" * 400 + b"a" * 700, bytes(range(256)) * 8, bytes(range(255, -1, -1)) * 8):
        text = np.append(np.frombuffer(raw, np.uint8).astype(np.int64) + 1, 0)
        own = text.tolist()
        assert suffixes.suffix_array(text, 257).tolist() == sorted(range(len(own)), key=lambda i: own[i:])


@pytest.mark.parametrize("length", [1, 2, 20, 50, 63, 64])
def test_window_hashes_tell_strings_apart(length):
    random = np.random.default_rng(length)
    data = random.integers(0, 2, 4000).astype(np.uint8)
    data[2000:3000] = data[:1000]
    hashes = repeats.window_hashes(data, length)
    strings = [data[k : k + length].tobytes() for k in range(len(data) - length + 1)]
    assert len(hashes) == len(strings)
    assert len(set(hashes.tolist())) == len(set(strings)) == len(set(zip(hashes.tolist(), strings, strict=True)))


def test_runs_cover_every_string_once():
    random = np.random.default_rng(1)
    sizes = np.array([50, 51, 400, 50, 3000])
    ends = np.cumsum(sizes)
    data = random.integers(0, 4, int(ends[-1])).astype(np.uint8)
    least, text, first, strings = repeats.anchored_runs(data, ends)
    places = np.concatenate([np.arange(a, a + n) for a, n in zip(first, strings, strict=True)])
    begins = ends - sizes
    assert places.tolist() == [p for b, n in zip(begins, sizes, strict=True) for p in range(b, b + n - 49)]
    anchors = {}
    for a, t, f, n in zip(least, text, first, strings, strict=True):
        assert begins[t] <= f and f + n + 49 <= ends[t]
        for k in range(f, f + n):
            assert anchors.setdefault(data[k : k + 50].tobytes(), a) == a


def passages():
    """Documents that share passages of many lengths, whole, overlapping, at either end, repeated inside one document."""
    shared = [prose(1000 + k, 40)[: 44 + 3 * k] for k in range(12)]
    rows = []
    for k in range(60):
        parts = [prose(k, 8 + k % 5)]
        for j in range(1 + k % 4):
            parts.insert((k + j) % 2 * len(parts), shared[(k * 5 + j * 7) % 12])
        rows.append((k * 3 % 61, " ".join(parts)))
    rows += [(70, "=" * 400), (71, "=" * 49), (72, "x" + "=" * 60 + "y"), (73, "ab" * 200), (74, "ba" * 40)]
    rows += [(80, "日本語 " * 30), (81, "本語 " * 30), (82, shared[11] + shared[10] + shared[11])]
    return rows + [(90 + k, rows[5][1]) for k in range(5)]


@pytest.mark.parametrize(("hot_docs", "shard_bytes", "range_anchors", "pack_bytes"), [(1 << 20, 6 << 20, 4_000_000, 1), (3, 6 << 20, 50, 900), (1 << 20, 700, 30, 1 << 20), (1, 6 << 20, 4_000_000, 5000)])
def test_passages(spark, monkeypatch, hot_docs, shard_bytes, range_anchors, pack_bytes):
    monkeypatch.setattr(repeats, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(repeats, "RANGE_ANCHORS", range_anchors)
    monkeypatch.setattr(repeats, "PACK_BYTES", pack_bytes)
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 5 * shard_bytes)
    df = spark.createDataFrame(passages(), "doc_id long, text string").repartition(3)
    assert digest(repeats.without_repeats(df, hot_docs=hot_docs)) == brute(passages())


def test_other_length(spark):
    df = spark.createDataFrame(passages(), "doc_id long, text string")
    assert digest(repeats.without_repeats(df, length=31)) == brute(passages(), 31)
    with pytest.raises(ValueError):
        repeats.without_repeats(df, length=20)


def test_edges(spark, edge_docs, no_docs):
    docs = edge_docs.selectExpr("*", "1 as pack", "2 as spans", "3 as key", "map(1, 2) as first", "4 as n_bytes")
    assert digest(repeats.without_repeats(docs)) == brute([(r[0], r[1]) for r in edge_rows()])
    assert repeats.without_repeats(no_docs).count() == 0
    assert digest(repeats.without_repeats(docs.where(F.length("text") < 10))) == brute([(r[0], r[1]) for r in edge_rows() if r[1] is not None and len(r[1]) < 10])


def test_table(small_docs):
    assert digest(repeats.without_repeats(small_docs)) == brute([(r["doc_id"], r["text"]) for r in small_docs.collect()])


def test_segments_without_a_repeated_string_are_told():
    random = np.random.default_rng(9)
    long = bytes(random.integers(0, 256, 90).astype(np.uint8))
    segments = [long[:60], long[5:70], long[40:], b"=" * 51, bytes(range(60)), long[8:59] + b"x"]
    assert repeats.with_repeats(segments, 50).tolist() == [True, True, False, True, False, True]

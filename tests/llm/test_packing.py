import bisect
import itertools
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotelake.llm import packing

ODD = [
    "a \n b c  d\x1ce ​f　 g\t\th",
    "  lead",
    "trail  \n\n",
    "   x y's don't  we'll<|endoftext|>ok",
    "",
    "\x85q \x85 \r\n z",
    "éa.b ß!!x 日本語。ab ١٢٣.",
    "x" * 3000 + " " * 2000,
    "a <|endoftext|> b",
    "<|endoftext|><|endoftext|>",
    "http://a.b/c?d=e&f=g 3.14,15 'quoted' ###head",
    None,
]


def expected(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_ids_are_those_of_the_tokenizer(spark, small_docs):
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string").union(small_docs.select(F.col("doc_id") + 1000, "text"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = defaultdict(dict)
    for r in packing.pieces(docs).collect():
        rows[r["doc_id"]][r["piece"]] = r
    assert rows.keys() == texts.keys()
    for doc_id, own in rows.items():
        ids, at = expected(texts[doc_id]), 0
        for k in range(len(own)):
            piece = own[k]
            assert piece["start"] == at
            part = ids[at : at + piece["length"]]
            assert piece["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            assert piece["length"] == 1024 or k == 0
            at += piece["length"]
        assert at == len(ids)


def test_known_parts_are_forgotten_and_learnt_again(small_docs):
    import pyarrow as pa

    parts = packing.PartIds("byte_bpe_50k.json", most=50)
    texts = [r["text"] for r in small_docs.limit(20).collect()]
    column = pa.array(texts)
    for text, ids in zip(texts * 2, [*parts.texts(column, 2), *parts.texts(column, 2)], strict=True):
        assert ids.tolist() == expected(text)


@pytest.mark.parametrize("n", [1, 5, 1023, 1024, 1025, 2048, 5000])
def test_cut(n):
    parts = packing.cut(n, 1024)
    assert sum(length for _, length in parts) == n and all(length == 1024 for _, length in parts[1:])
    assert [start for start, _ in parts] == list(itertools.accumulate([0, *[length for _, length in parts[:-1]]]))


def test_slack_takes_longer_pieces():
    left = dict.fromkeys([40, 30, 7, 3], 1)
    assert packing._fullest(left, 50) == {40: 1, 7: 1, 3: 1}
    assert packing._fullest({40: 1, 30: 1, 9: 1, 5: 1, 4: 4}, 50, slack=1) == {40: 1, 9: 1}


def test_fullest_combination_by_brute_force():
    random = np.random.default_rng(2)
    for _ in range(60):
        lengths = sorted(random.integers(1, 30, 9).tolist(), reverse=True)
        best = max(s for n in range(10) for c in itertools.combinations(lengths, n) if (s := sum(c)) <= 50)
        found = packing._fullest(dict(sorted(Counter(lengths).items(), reverse=True)), 50)
        assert sum(k * n for k, n in found.items()) == best
        assert all(Counter(lengths)[k] >= n for k, n in found.items())


def best_fit(lengths):
    """Bins that best-fit decreasing takes."""
    free = []
    for length in sorted(lengths, reverse=True):
        k = bisect.bisect_left(free, length)
        bisect.insort(free, (free.pop(k) if k < len(free) else 1024) - length)
    return len(free)


def test_patterns_use_every_piece_once():
    random = np.random.default_rng(4)
    counts = Counter(random.integers(1, 1025, 5000).tolist())
    found = packing.patterns(dict(counts))
    used = Counter()
    for bins, combination in found:
        assert sum(k * n for k, n in combination.items()) <= 1024
        for k, n in combination.items():
            used[k] += bins * n
    assert used == counts
    assert sum(bins for bins, _ in found) <= best_fit(counts.elements())


def check(rows):
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    return len(bins)


def test_packed(small_docs):
    rows = packing.packed(packing.pieces(small_docs)).collect()
    assert check(rows) <= best_fit(r["length"] for r in rows)
    assert len(rows) == packing.pieces(small_docs).count()


def test_edges(edge_docs, no_docs):
    rows = packing.packed(packing.pieces(edge_docs.withColumn("length", F.lit("x")))).collect()
    check(rows)
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in edge_docs.collect()}
    assert [r["length"] for r in rows if r["doc_id"] == 1] == [1]
    assert packing.packed(packing.pieces(no_docs)).count() == 0

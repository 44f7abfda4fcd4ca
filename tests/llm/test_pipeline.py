"""The pipeline's stages against plain versions of them on a small table."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quotelake.llm import isolation, mixing, packing, pii
from tests.llm.conftest import prose
from tests.llm.test_jaccard import LOWER, WORD, brute
from tests.llm.test_packing import check, expected

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, small, tmp_path_factory):
    docs, out = spark.read.parquet(f"{small}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        folder = str(tmp_path_factory.mktemp(name)) + "/x"
        made = stage(spark, docs, small)
        made.write.parquet(folder)
        out[name] = (docs, docs := spark.read.parquet(folder))
    return out


def rows(df):
    return sorted(map(tuple, df.select(COLUMNS).collect()))


def test_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules",
        "ngram_jaccard_join",
        "personal_data",
        "source_mixing",
        "best_fit_packing",
    ]


def test_quality(spark, small, stages):
    docs, kept = stages["quality_rules"]
    judged = isolation.judge(docs, isolation.fit(docs, spark.read.parquet(f"{small}/labels.parquet"))).where("kept")
    assert rows(kept) == rows(docs.join(judged.select("doc_id"), "doc_id"))


def test_near_copies(stages):
    docs, kept = stages["ngram_jaccard_join"]
    first = {c for _, _, c in brute([(r["doc_id"], r["text"]) for r in docs.collect()])}
    assert rows(kept) == [r for r in rows(docs) if r[0] in first]


def first_by_shingles(rows, n=5, part=80):
    """The least doc_id of each group, by comparing all pairs on n-word shingles. rows: (doc_id, text)."""
    sets = []
    for i, text in sorted(rows):
        words = WORD.findall((text or "").translate(LOWER))
        sets.append((i, {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()))
    group = list(range(len(sets)))
    for a, (_, x) in enumerate(sets):
        for b, (_, y) in enumerate(sets[:a]):
            if x and y and 100 * len(x & y) >= part * len(x | y):
                group = [min(group[a], group[b]) if g in (group[a], group[b]) else g for g in group]
    return {sets[g][0] for g in group}


def test_near_copies_share_four_fifths_of_five_word_shingles(spark, small):
    rows = []
    for k in range(8):
        base = [f"w{k}x{j}" for j in range(200 + 5 * k)]
        changed = [*base]
        for j in range(4 + k):
            changed[(j * 17 + 6) % len(base)] = f"y{k}x{j}"
        added = base + [f"z{k}x{j}" for j in range(len(base) * (16 + 2 * k) // 100)]
        rows += [(10 * k + j, " ".join(words)) for j, words in enumerate((base, changed, added))]
    rows += [(100, " ".join(rows[0][1].split()[:4])), (101, rows[0][1].upper()), (102, None), (103, prose(3, 90))]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], ", ".join(f"{c} {'long' if c in ('doc_id', 'n_chars') else 'string'}" for c in COLUMNS))
    want = first_by_shingles(rows)
    assert want != first_by_shingles(rows, 4, 85)
    made = dict(corpus_pipeline.STAGES)["ngram_jaccard_join"](spark, docs.repartition(3), small)
    assert {r["doc_id"] for r in made.collect()} == want


def test_near_copies_of_the_table(stages):
    docs, kept = stages["ngram_jaccard_join"]
    first = first_by_shingles([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert rows(kept) == [r for r in rows(docs) if r[0] in first]


def test_personal_data(stages):
    docs, hidden = stages["personal_data"]
    field = pii.fit(docs)
    want = []
    for r in docs.collect():
        text, at, out = r["text"], 0, []
        for kind, start, end in pii.all_spans(text, field)[1]:
            if start >= at:
                out.append(text[at:start] + f"[{kind.upper()}]")
            at = max(at, end)
        text = "".join(out) + text[at:]
        assert not pii.base_spans(text)
        want.append((r["doc_id"], text, r["lang"], r["source"], len(text)))
    assert rows(hidden) == sorted(want)


def test_mixing(stages):
    docs, mixed = stages["source_mixing"]
    copies = {r["doc_id"]: r["copies"] for r in mixing.schedule(docs).collect() if r["copies"]}
    assert Counter(r["doc_id"] for r in mixed.collect()) == copies
    assert set(rows(mixed)) <= set(rows(docs))


def test_packing(stages):
    docs, packed = stages["best_fit_packing"]
    found = packed.collect()
    check(found)
    lengths = Counter()
    for r in found:
        lengths[r["doc_id"]] += r["length"]
    want = Counter()
    for r in docs.collect():
        want[r["doc_id"]] += len(expected(r["text"]))
    assert lengths == want


def test_run(spark, small, stages):
    assert corpus_pipeline.run(spark, small).select(F.sum("length")).first() == stages["best_fit_packing"][1].select(F.sum("length")).first()


def test_stages_with_edge_rows(spark, small, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            made = stage(spark, docs, small)
            assert name == "best_fit_packing" or made.columns == COLUMNS
            made.count()
    assert packing.PIECES

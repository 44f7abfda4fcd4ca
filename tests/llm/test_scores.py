"""Statistics, the isolation forest, the rule ensemble and the language model."""

import math
import re
import time
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quotelake.llm import hmm, isolation, rule_ensemble, textstats
from quotelake.llm import words as W

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def counted(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(repeated),
    )


def test_statistics(edge_docs, small_docs):
    texts = [r["text"] for r in edge_docs.union(small_docs).collect()] + ["a b c a b c", "x\nx\n \n \nx", "#a|b & <c>", "a b c\na b c d", "\n\n"]
    found = textstats.batch_statistics(pa.array(texts))
    for k, text in enumerate(texts):
        assert tuple(found[name][k] for name in textstats.STATISTICS[:5]) == counted(text), text


def test_words_of_slices():
    texts = ["One two", None, "", " three\tFOUR five", "six", "é x"] * 5
    for size in (1, 9, 1 << 20):
        found = []
        for s in W.word_slices(pa.array(texts).slice(1), lower=True, slice_bytes=size):
            data = s.data.tobytes()
            found += [(s.first + t, data[a:b].decode()) for t, a, b in zip(s.text, s.starts, s.ends, strict=True)]
        assert found == [(k, w) for k, text in enumerate(texts[1:]) for w in WORD.findall(text or "")]
    hashes = {}
    for s in W.word_slices(pa.array(["The tHe the he", "x the"]), lower=True):
        for a, b, h in zip(s.starts, s.ends, s.hashes, strict=True):
            hashes.setdefault(s.data[a:b].tobytes().lower(), set()).add(int(h))
    assert all(len(own) == 1 for own in hashes.values()) and len(set.union(*hashes.values())) == 3


def test_forest_isolates_what_is_apart():
    random = np.random.default_rng(0)
    rows = np.concatenate((random.normal(size=(500, 3)), np.full((5, 3), 8.0)))
    found = isolation.scores(isolation.grow(rows), rows)
    assert found[500:].min() > np.quantile(found[:500], 0.99)


def test_path_lengths_by_walking_each_tree():
    random = np.random.default_rng(1)
    rows = random.normal(size=(300, 4))
    forest = isolation.grow(rows, 10)
    for row, score in zip(rows[:20], isolation.scores(forest, rows[:20]), strict=True):
        total = 0.0
        for node in forest.roots:
            while forest.feature[node] >= 0:
                node = forest.left[node] + (row[forest.feature[node]] > forest.split[node])
            total += forest.split[node]
        assert score == pytest.approx(2 ** (-total / 10 / forest.expected))


def test_isolation_on_the_table(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    forest = isolation.fit(docs, labels)
    judged = isolation.judge(docs, forest).join(docs, "doc_id").join(labels, "doc_id", "left").collect()
    for r in judged:
        assert tuple(r[name] for name in textstats.STATISTICS[:5]) == counted(r["text"])
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    good = [r["kept"] for r in judged if r["quality"] == 1 and not r["base_failed"]]
    bad = [r["kept"] for r in judged if r["quality"] == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1
    kept = {r["doc_id"] for r in isolation.kept_documents(docs, forest).collect()}
    assert kept == {r["doc_id"] for r in judged if r["kept"]}


def test_isolation_edges(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    forest = isolation.fit(edge_docs, none)
    rows = isolation.judge(edge_docs.withColumn("anomaly", F.lit(1)), forest).collect()
    assert len(rows) == edge_docs.count() and all(r["kept"] == (not r["base_failed"]) for r in rows)
    labels = spark.createDataFrame([(k, int(k % 4 > 0)) for k in range(20, 60)] + [(None, 1), (21, None), (22, 1)], "doc_id long, quality int")
    assert isolation.judge(edge_docs, isolation.fit(edge_docs, labels)).count() == edge_docs.count()
    assert isolation.judge(no_docs, isolation.fit(no_docs, labels)).count() == 0


def test_ranges_and_threshold_come_from_all_labelled_rows(spark):
    random = np.random.default_rng(3)
    texts = [" ".join(f"{'w' * (1 + k % 7)}{k}-{random.integers(9**6)}{'!' * int(random.integers(3))}" for k in range(60 + n % 9)) for n in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 5 > 0)) for k in range(300)], "doc_id long, quality int")
    forest = isolation.fit(docs, labels, sample_rows=40)
    rows, good = textstats.ratios(textstats.batch_statistics(pa.array(texts))), np.arange(300) % 5 > 0
    low, high = np.quantile(rows[good], [isolation.OUTSIDE, 1 - isolation.OUTSIDE], axis=0)
    np.testing.assert_allclose([forest.low, forest.high], [low, high], rtol=1e-12)

    found = np.round(random.random(500), 2)
    bad = found + random.random(500) > 1.1
    scored = spark.createDataFrame([(float(x), not bool(y)) for x, y in zip(found, bad, strict=True)], "score double, good boolean")
    gains = {x: (bad & (found >= x)).sum() / bad.sum() - 0.5 * (~bad & (found >= x)).sum() / (~bad).sum() for x in found}
    best = max(gains, key=lambda x: (gains[x], x))
    assert isolation.threshold(scored, 0.5) == pytest.approx((best + found[found < best].max(initial=0)) / 2)
    assert isolation.threshold(scored.where("good")) == isolation.threshold(scored.where("false")) == np.inf


def test_lasso_finds_the_rules_that_matter():
    random = np.random.default_rng(5)
    rows = random.random((1500, 4))
    good = (rows[:, 0] > 0.3) & (rows[:, 2] <= 0.8)
    model = rule_ensemble.fitted(rows, good)
    held = rule_ensemble.holds(model.rules, rows)
    z = held @ model.weights + model.bias
    assert ((z > 0) == good).mean() > 0.98
    assert len(model.rules) < len(rule_ensemble.tree_rules(rows, good)) / 2


def test_compiled_rules_are_the_model(spark, small_docs):
    random = np.random.default_rng(6)
    rules = [((int(random.integers(len(rule_ensemble.FEATURES))), bool(random.integers(2)), float(random.random())),) for _ in range(8)]
    rules.append((rules[0][0], rules[1][0]))
    model = rule_ensemble.Ensemble(rules, random.normal(size=len(rules)), 0.3)
    for r in rule_ensemble.scored(small_docs, model).collect():
        row = np.array([[r[name] for name in rule_ensemble.FEATURES]])
        z = float((rule_ensemble.holds(rules, row) @ model.weights)[0] + 0.3)
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-z)))


def test_rule_ensemble_on_held_out_labels(spark):
    from quotelake.llm.catalog import QUERIES

    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op6_rule_ensemble"](spark, folder).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    right = [r["predicted"] == labels[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean(right) > 0.95 and all(0 <= r["score"] <= 1 for r in rows)


def test_rule_ensemble_edges(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = rule_ensemble.scored(edge_docs.withColumn("score", F.lit("x")), rule_ensemble.fit(edge_docs, none)).collect()
    assert len(rows) == edge_docs.count() and all(r["score"] == pytest.approx(0.5) for r in rows)
    labels = spark.createDataFrame([(20, 1), (None, 0), (21, None), (20, 1)], "doc_id long, quality int")
    assert all(r["score"] > 0.5 for r in rule_ensemble.scored(edge_docs, rule_ensemble.fit(edge_docs, labels)).collect())
    assert rule_ensemble.scored(no_docs, rule_ensemble.fit(no_docs, none)).count() == 0


def model_of(random, states, classes):
    norm = lambda x: x / x.sum(axis=-1, keepdims=True)
    return hmm.Model(norm(random.random(states)), norm(random.random((states, states))), norm(random.random((states, classes))))


def test_forward_is_the_sum_over_all_paths():
    random = np.random.default_rng(8)
    model = model_of(random, 3, 5)
    texts = [[1, 0, 4], [2], [3, 3, 1, 0], [4, 4]]
    found = hmm.log10_likelihood(model, hmm.lattice(np.concatenate(texts), np.array([len(t) for t in texts])))
    for text, score in zip(texts, found, strict=True):
        total = 0.0
        for path in np.ndindex(*[3] * len(text)):
            p = model.start[path[0]] * model.emit[path[0], text[0]]
            for a, b, c in zip(path, path[1:], text[1:], strict=False):
                p *= model.move[a, b] * model.emit[b, c]
            total += p
        assert 10**score == pytest.approx(total)


def test_expected_counts_by_all_paths_and_likelihood_rises():
    random = np.random.default_rng(9)
    model = model_of(random, 2, 3)
    texts = [[1, 0, 2], [2, 2], [0]]
    x = hmm.lattice(np.concatenate(texts), np.array([len(t) for t in texts]))
    start, move, emit = np.zeros(2), np.zeros((2, 2)), np.zeros((2, 3))
    for text in texts:
        paths = list(np.ndindex(*[2] * len(text)))
        chances = []
        for path in paths:
            p = model.start[path[0]] * model.emit[path[0], text[0]]
            for a, b, c in zip(path, path[1:], text[1:], strict=False):
                p *= model.move[a, b] * model.emit[b, c]
            chances.append(p)
        for path, p in zip(paths, np.array(chances) / sum(chances), strict=True):
            start[path[0]] += p
            for a, b in zip(path, path[1:], strict=False):
                move[a, b] += p
            for a, c in zip(path, text, strict=True):
                emit[a, c] += p
    found = hmm.expected(model, x)
    assert np.allclose(found.start, start) and np.allclose(found.move, move) and np.allclose(found.emit, emit)
    likelihood = [hmm.log10_likelihood(model, x).sum()]
    for _ in range(5):
        model = hmm.updated(hmm.expected(model, x))
        likelihood.append(hmm.log10_likelihood(model, x).sum())
    assert likelihood[-1] > likelihood[0]


def base_scores(rows):
    tokens = lambda t: [*WORD.findall((t or "").translate(LOWER)), None]
    counts = Counter()
    for doc_id, text in rows:
        if doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 != 2:
            counts.update(tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    return [
        (doc_id, len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), total, sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens(t)))
        for doc_id, t in rows
    ]


@pytest.mark.parametrize("known", [hmm.KNOWN, 64])
def test_base_scores(edge_docs, small_docs, known):
    """With few known words, nearly all counts come through the join."""
    docs = edge_docs.unionByName(small_docs.withColumn("doc_id", F.col("doc_id") + 1000)).withColumn("score", F.lit(1))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = [(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in hmm.scored(docs, rounds=1, known=known, own_classes=min(known, hmm.CLASSES)).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    for a, b in zip(sorted(got, key=key), sorted(base_scores(rows), key=key), strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4])


def test_probabilities_sum_to_one_over_the_vocabulary(spark):
    """One-word texts: all words, the unknown one of each kind, and no word at all, with the rest of the mass on longer texts."""
    docs = spark.createDataFrame([(k, " ".join("ab cde f, g1 hij".split()[: k % 5 + 1])) for k in range(1, 40)], "doc_id long, text string")
    scores = {r["doc_id"]: r["score"] for r in hmm.scored(docs).collect()}
    assert all(s < 0 for s in scores.values())


def topic_rows():
    random = np.random.default_rng(4)
    return [(k, " ".join(f"t{k % 3}w{int(w)}" for w in random.zipf(1.5, 40) % 60)) for k in range(210)]


def test_training_converges_and_scores_are_the_sum_over_states(spark, monkeypatch):
    seen, train = {}, hmm.trained

    def kept(training, v, *more):
        seen.update(training=training, v=v, made=train(training, v, *more))
        return seen["made"]

    monkeypatch.setattr(hmm, "trained", kept)
    monkeypatch.setattr(hmm, "START_TOKENS", 2000)
    rows = topic_rows()
    got = hmm.scored(spark.createDataFrame(rows, "doc_id long, text string"), own_classes=100).collect()
    v, (model, likelihoods) = seen["v"], seen["made"]
    assert hmm.one_round(seen["training"], v, model)[1] - likelihoods[-1] < hmm.TOLERANCE
    held = [r for r in got if r["held_out"]]
    # three topics: far above the gain of two rounds from equal states
    assert sum(r["score"] - r["base_score"] for r in held) / sum(r["n_tokens"] for r in held) > 0.2
    counts = Counter(w for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2 for w in t.split())
    alike = Counter()
    place = {}
    for w in {w for _, t in rows for w in t.split()}:
        at = v.find(next(W.word_slices(pa.array([w]), lower=True)).hashes)[0]
        place[w] = v.classes[at] if at >= 0 else -1
        if place[w] < 0:
            alike[len(w)] += counts[w] + (counts[w] > 0)
    texts = dict(rows)
    for r in got:
        now, total = model.start, 0.0
        for w in [*texts[r["doc_id"]].split(), None]:
            c = v.size - 1 if w is None else place[w] if place[w] >= 0 else v.own + len(w) + 16
            if w and place[w] < 0:
                total += math.log10((counts[w] + 1) / (alike[len(w)] + 1))
            p = now * model.emit[:, c]
            total += math.log10(p.sum())
            now = p / p.sum() @ model.move
        assert r["score"] == pytest.approx(total)


def test_states_and_classes_grow_within_bounds():
    sizes = [(hmm.states_of(n), hmm.classes_of(n)) for n in (10, 10**4, 10**5, 10**6, 10**9)]
    assert sizes == sorted(sizes, key=lambda x: x[0]) and sizes[3][1] > sizes[2][1] > sizes[0][1]
    assert all(k * (c + hmm.KINDS + 1) <= hmm.CELLS for k, c in sizes)


def test_language_model_edges(no_docs):
    assert hmm.scored(no_docs).count() == 0


def _plain_counts(model, x):
    """The recursions with a new array for each term of a step, as they were before."""
    emitted = model.emit.T[x.classes]
    alpha, scale, now = np.empty_like(emitted), np.empty(len(x.classes), emitted.dtype), model.start
    for start, n in zip(x.starts.tolist(), x.active.tolist(), strict=True):
        now = (now[:n] @ model.move if start else np.broadcast_to(now, (n, len(now)))) * emitted[start : start + n]
        total = now.sum(axis=1)
        now /= total[:, None]
        alpha[start : start + n], scale[start : start + n] = now, total
    emitted /= scale[:, None]
    moves, back = np.zeros(model.move.shape), model.move.T.copy()
    beta = np.ones((int(x.active[-1]), len(model.start)), emitted.dtype)
    for t in range(len(x.starts) - 1, -1, -1):
        start, n = int(x.starts[t]), int(x.active[t])
        if t + 1 < len(x.starts):
            after, m = int(x.starts[t + 1]), int(x.active[t + 1])
            ahead = emitted[after : after + m] * beta
            moves += alpha[start : start + m].T @ ahead
            emitted[after : after + m] = beta
            beta = np.ones((n, len(model.start)), emitted.dtype)
            beta[:m] = ahead @ back
    emitted[: int(x.active[0])] = beta
    gamma = alpha * emitted
    emits = np.stack([np.bincount(x.classes, gamma[:, k], model.emit.shape[1]) for k in range(len(model.start))])
    return hmm.Model(gamma[: int(x.active[0])].sum(axis=0), moves * model.move, emits)


def test_long_texts_take_few_calls_a_step():
    random = np.random.default_rng(3)
    lengths = random.integers(4000, 5000, 4)
    model = hmm.Model(*[part.astype(np.float32) for part in model_of(random, 12, 3000)])
    x = hmm.lattice(random.integers(0, 3000, int(lengths.sum())), lengths)
    for got, wanted in zip(hmm.expected(model, x), _plain_counts(model, x), strict=True):
        assert np.allclose(got, wanted, rtol=1e-3, atol=1e-4)

    def seconds(fn):
        begun = time.thread_time()
        fn(model, x)
        return time.thread_time() - begun

    times = [(seconds(hmm.expected), seconds(_plain_counts)) for _ in range(9)]
    assert min(t[0] for t in times) < min(t[1] for t in times)


def test_counts_of_few_and_of_many_tasks_add_up(spark, monkeypatch):
    rows = [(k, " ".join(f"w{(k * j) % 17}" for j in range(30))) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    v = hmm.vocabulary(hmm.word_counts(docs), 40, own_classes=8)
    sequences, model = hmm.encoded(docs, v), hmm.initial(v)
    one = hmm.expected_over(sequences, v, model)
    monkeypatch.setattr(hmm, "SALTS", 1)
    many = hmm.expected_over(sequences.repartition(3), v, model)
    for a, b in zip(one[0], many[0], strict=True):
        assert np.allclose(a, b, rtol=1e-3, atol=1e-4)
    assert one[1:] == pytest.approx(many[1:], rel=1e-6)


def test_statistics_of_many_texts_take_little_memory():
    texts = pa.array([" ".join(f"w{(k * j) % 101}" for j in range(2000)) for k in range(500)])
    textstats.batch_statistics(texts)
    tracemalloc.start()
    textstats.batch_statistics(texts)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 16 << 20


def test_few_labelled_rows_make_few_files(spark, small_docs, small):
    # a shuffle partition each, as with many partitions that adaptive execution leaves alone
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        stored = isolation.labelled_statistics(small_docs, spark.read.parquet(f"{small}/labels.parquet"))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert stored.count() > 40 and len(stored.inputFiles()) == 1


def test_words_are_found_whatever_bits_they_share():
    words = np.array([0, 1, 5, (1 << 46) - 1, 1 << 46, 3 << 46, (3 << 46) + 7, (1 << 64) - 2, (1 << 64) - 1], np.uint64)
    none = np.zeros(len(words), np.int64)
    v = hmm.Vocabulary(words, none, none, none, none, 0, 0, 0, 0, hmm.places_of(words))
    others = np.array([2, (1 << 46) - 2, 2 << 46, (3 << 46) + 1, (1 << 64) - 3], np.uint64)
    assert v.find(np.concatenate((words, others))).tolist() == [*range(9), -1, -1, -1, -1, -1]


def test_lattices_use_the_same_arrays():
    random = np.random.default_rng(4)
    lengths = random.integers(1, 400, 300)
    model = hmm.Model(*[part.astype(np.float32) for part in model_of(random, 12, 3000)])
    x, room = hmm.lattice(random.integers(0, 3000, int(lengths.sum())), lengths), hmm.Room()
    first = hmm.expected_and_likelihood(model, x, room)
    tracemalloc.start()
    again = hmm.expected_and_likelihood(model, x, room)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # less than the forward and the backward probabilities of all tokens
    assert most < 2 * 4 * 12 * len(x.classes)
    assert first[1] == again[1] and all((a == b).all() for a, b in zip(first[0], again[0], strict=True))

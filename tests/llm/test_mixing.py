from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quotelake.llm import mixing


def targets(sizes, weights=(5, 2, 1), passes=3):
    """Resharing step by step, as the rule says."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, fixed, left = sum(sizes.values()), {}, set(sizes)
    while left:
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        above = {s for s in left if share[s] >= passes * sizes[s]}
        if not above:
            return {**fixed, **share}
        fixed |= {s: float(passes * sizes[s]) for s in above}
        left -= above
    return fixed


@pytest.mark.parametrize(
    "sizes",
    [{"a": 10, "b": 500, "c": 80, None: 40, "ä": 7}, {"a": 0, "b": 5}, {"a": 100}, {"a": 1, "b": 1, "c": 1000, "d": 2, "e": 3, "f": 900}],
)
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r["source"]: r["target"] for r in mixing.source_targets(rows).collect()}
    want = targets(sizes)
    assert found.keys() == want.keys()
    for s in want:
        assert found[s] == pytest.approx(want[s])


def test_mixture(small_docs):
    rows = mixing.schedule(small_docs).collect()
    sizes, taken, longest = Counter(), Counter(), defaultdict(int)
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
    want = targets(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s] + max(longest.values())
    assert {r["key"]: r["copies"] for r in rows} == queue(rows)
    again = mixing.schedule(small_docs).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def queue(rows, passes=3):
    """Copies by key: all queues served in the order of finish times until the budget is spent."""
    by_source = defaultdict(list)
    for r in rows:
        by_source[r["source"]].append(r)
    waiting = []
    for source, own in by_source.items():
        served = 0
        for r in sorted((r for r in own if r["size"] and r["target"]), key=lambda r: r["finish"]):
            served += r["size"]
            for k in range(passes):
                waiting.append(((k * r["source_size"] + served) / r["target"], source is None, (source or "").encode(), r["key"], r["size"]))
    copies, spent, budget = Counter({r["key"]: 0 for r in rows}), 0, sum(r["size"] for r in rows)
    for *_, key, size in sorted(waiting):
        if spent + size > budget:
            if spent + size - budget < budget - spent:
                copies[key] += 1
            break
        spent += size
        copies[key] += 1
    return dict(copies)


def texts(spark, *groups):
    """groups: source, documents, words of each."""
    rows = [(source, size) for source, count, size in groups for _ in range(count)]
    return spark.createDataFrame([(k, " ".join(f"w{k}x{i}" for i in range(size)), s) for k, (s, size) in enumerate(rows)], "doc_id long, text string, source string")


@pytest.mark.parametrize(
    "groups",
    [
        [("a", 51, 10), ("b", 21, 10), ("c", 1, 1680)],
        [("a", 1, 900), ("b", 40, 3)],
        [("a", 30, 7), (None, 2, 500), ("", 9, 4)],
        [("a", 3, 1), ("b", 1, 1)],
        [(f"s{k:02}", 2 + k, 1 + k % 5) for k in range(30)] + [("z", 1, 4000)],
    ],
)
def test_dominant_documents(spark, groups):
    rows = mixing.schedule(texts(spark, *groups)).collect()
    assert {r["key"]: r["copies"] for r in rows} == queue(rows)
    budget, spent = sum(r["size"] for r in rows), sum(r["taken"] for r in rows)
    assert abs(spent - budget) <= max(r["size"] for r in rows)


def test_any_columns(spark):
    docs = texts(spark, ("a", 5, 4), ("b", 3, 9)).selectExpr("*", "map('k', doc_id) m", "1 _k", "2 _key", "3 size", "4 `a.b`", "5 finish")
    made = mixing.mixed(docs)
    assert made.columns == docs.columns and {r["_k"] for r in made.collect()} == {1}


def test_order_of_the_queues(small_docs):
    """Within a source, documents and passes are served in the order of their finish times."""
    by_source = defaultdict(list)
    for r in mixing.schedule(small_docs).collect():
        if r["size"]:
            by_source[r["source"]].append((r["finish"], r["size"], r["copies"], r["target"], r["source_size"]))
    for own in by_source.values():
        own.sort()
        served = 0
        for finish, size, _, target, _ in own:
            served += size
            assert finish == pytest.approx(served / target)
        copies = [c for _, _, c, _, _ in own]
        assert copies == sorted(copies, reverse=True)


def test_mixed_rows(spark, small_docs):
    rows = mixing.schedule(small_docs)
    made = mixing.mixed(small_docs.withColumn("size", F.lit("x")))
    assert made.columns == [*small_docs.columns, "size"]
    want = Counter({r["doc_id"]: r["copies"] for r in rows.collect() if r["copies"]})
    got = Counter(r["doc_id"] for r in mixing.mixed(small_docs).collect())
    assert got == want


def test_edges(edge_docs, no_docs):
    rows = mixing.schedule(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert all(r["taken"] == 0 for r in rows if not r["size"])
    assert sum(r["copies"] for r in rows) == mixing.mixed(edge_docs).count()
    assert mixing.schedule(no_docs).count() == 0 and mixing.mixed(no_docs).count() == 0


def test_native_plan(small_docs):
    plan = mixing.mixed(small_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan

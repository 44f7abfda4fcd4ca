from collections import defaultdict

from pyspark.sql import functions as F

from quotelake.llm import sharding


def check(rows, shards):
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r["shard"]].append(r["slot"])
    sizes = [len(by_shard[s]) for s in range(shards)]
    assert set(by_shard) <= set(range(shards)) and max(sizes) - min(sizes) <= 1
    for own in by_shard.values():
        assert sorted(own) == list(range(len(own)))


def test_shards_of_many_buckets(small_docs, tmp_path):
    made = sharding.write_shards(small_docs, str(tmp_path / "s"), 24, bucket_bytes=20_000)
    rows = made.collect()
    check(rows, 24)
    assert sorted((r["doc_id"], r["text"]) for r in rows) == sorted((r["doc_id"], r["text"]) for r in small_docs.collect())
    ordered = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    assert ordered != sorted(ordered)
    assert sum(abs(a - b) == 1 for a, b in zip(ordered, ordered[1:], strict=False)) < 10


def test_one_bucket_and_few_rows(spark, small_docs):
    rows = sharding.shuffled(small_docs.limit(10), 24).collect()
    check(rows, 24)
    assert len(rows) == 10


def test_edges(edge_docs, no_docs, tmp_path):
    made = sharding.shuffled(edge_docs.withColumn("shard", F.lit("x")).withColumn("slot", F.lit(1)), 4, bucket_bytes=3000)
    rows = made.collect()
    check(rows, 4)
    assert len(rows) == edge_docs.count() and made.columns == [*edge_docs.columns, "shard", "slot"]
    assert sharding.shuffled(no_docs, 4).count() == 0


def test_native_plan(small_docs):
    plan = sharding.shuffled(small_docs, 24)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_any_columns_and_copies(spark):
    """Inner names, maps, and a third of all rows equal in every column."""
    other = spark.range(300).selectExpr("id doc_id", "concat('text ', id) text", "map('k', id) m", "1 _key", "2 _bucket", "3 key", "4 row", "5 `a.b`")
    same = spark.range(150).selectExpr("7L doc_id", "'again' text", "map('k', 7L) m", "1 _key", "2 _bucket", "3 key", "4 row", "5 `a.b`")
    docs = other.union(same)
    made = sharding.shuffled(docs, 4, bucket_bytes=2000, copies=20)
    rows = made.collect()
    check(rows, 4)
    assert made.columns == [*docs.columns, "shard", "slot"]
    assert sorted((r["doc_id"], r["text"], r["m"]["k"]) for r in rows) == sorted((r["doc_id"], r["text"], r["m"]["k"]) for r in docs.collect())
    by_shard = defaultdict(int)
    for r in rows:
        by_shard[r["shard"]] += r["text"] == "again"
    assert len(by_shard) == 4 and min(by_shard.values()) > 15
    again = sharding.shuffled(docs.repartition(7), 4, bucket_bytes=2000, copies=20).collect()
    key = lambda r: (r["shard"], r["slot"])
    assert [r["doc_id"] for r in sorted(rows, key=key)] == [r["doc_id"] for r in sorted(again, key=key)]

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from quotelake.operators import integrity
from quotelake.operators.snapshots import (
    as_text,
    changed_rows,
    compare_digests,
    content_digests,
    flatten_categories,
    overlay,
    parse_snapshot,
    reference_keys,
    tag_extraction,
    transpose_statement,
    widen,
)
from quotelake.plans.bronze import land_snapshot
from quotelake.sources import control
from quotelake.sources.files import read_bronze


def test_flatten_categories(spark, rows):
    payload = {"a": {"x": 1, "deep": {"y": [1]}}, "b": [{"x": 2}, 7, {"z": "t"}], "c": 5, "d": "text", "e": None}
    df = spark.createDataFrame([("us", json.dumps(payload))], "market string, payload string")
    flat = flatten_categories(df, "payload", ["market"])
    got = {(r["category"], r["item"]): r["fields"] for r in flat.collect()}
    assert got == {
        ("a", 0): {"x": "1", "deep": '{"y":[1]}'},
        ("b", 0): {"x": "2"},
        ("b", 1): {"z": "t"},
    }
    assert rows(widen(flat, "fields", ["x", "nope"]), "category", "x", "nope") == [
        ("a", "1", None),
        ("b", None, None),
        ("b", "2", None),
    ]


def test_transpose_statement(spark, rows):
    wide = spark.createDataFrame([("A", "sales", 1.0, 2.0), ("A", "cost", 3.0, None)], "ticker string, item string, y1 double, y2 double")
    out = transpose_statement(wide, ["ticker"], "item", ["sales", "cost"])
    assert out.columns == ["ticker", "period", "sales", "cost"]
    assert rows(out) == [("A", "y1", 1.0, 3.0), ("A", "y2", 2.0, None)]


def test_overlay(spark):
    df = spark.createDataFrame([({"a": "1", "b": "1"}, {"b": "2"}, None)], "x map<string,string>, y map<string,string>, z map<string,string>")
    assert df.select(overlay(F.col("x"), F.col("y"), F.col("z"))).head()[0] == {"a": "1", "b": "2"}
    assert df.select(overlay(F.col("z"), F.col("y"))).head()[0] == {"b": "2"}


def test_reference_keys_and_parse(spark, rows):
    df = spark.createDataFrame([("B", "tech"), ("A", "tech"), ("C", None), ("D", "")], "ticker string, sector_key string")
    assert rows(reference_keys(df, "sector_key"), "sector_key", "ticker") == [("tech", "A")]
    raw = spark.createDataFrame([("A", '{"open": "x", "n": 3}')], "ticker string, payload string")
    assert tuple(parse_snapshot(raw, "payload", "open string, n int, gone int", ["ticker"]).head()) == ("x", 3, None, "A")


def digest_of(df):
    return {r["k"]: r["content_hash"] for r in content_digests(df, ["k"]).collect()}


def test_digest_properties(spark):
    ddl = "k string, v string, n int"
    data = [("a", "x", 1), ("a", "y", 2), ("b", None, 3)]
    base = digest_of(spark.createDataFrame(data, ddl))
    assert digest_of(spark.createDataFrame(data[::-1], ddl).repartition(3)) == base
    assert digest_of(tag_extraction(spark.createDataFrame(data, ddl))) == base
    assert digest_of(spark.createDataFrame([*data[:2], ("b", "", 3)], ddl))["b"] != base["b"]
    assert digest_of(spark.createDataFrame([*data, ("a", "x", 1)], ddl))["a"] != base["a"]
    assert digest_of(spark.createDataFrame([("a", "x", 2), ("a", "y", 1), data[2]], ddl))["a"] != base["a"]


def test_changed_snapshots(spark, rows):
    ddl = "k string, v string"
    old = content_digests(spark.createDataFrame([("a", "1"), ("b", "1")], ddl), ["k"])
    now = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "1")], ddl)
    compared = compare_digests(content_digests(now, ["k"]), old, ["k"])
    assert rows(compared, "k", "status") == [("a", "unchanged"), ("b", "changed"), ("c", "new")]
    assert rows(changed_rows(now, compared, ["k"])) == [("b", "2"), ("c", "1")]


def test_land_snapshot_writes_changes_only(spark, tmp_path):
    root = str(tmp_path)
    first = spark.createDataFrame([("A", "1"), ("B", "1")], "ticker string, v string")
    second = spark.createDataFrame([("A", "1"), ("B", "2")], "ticker string, v string")
    for df in (first, first, second, second):
        land_snapshot(df, root, "ticker", "info", "ticker")
    landed = read_bronze(spark, root, "ticker", "info")
    assert sorted((r["ticker"], r["v"]) for r in landed.collect()) == [("A", "1"), ("B", "1"), ("B", "2")]


@pytest.fixture
def lake(spark, tmp_path):
    data = tmp_path / "lake"
    for name in ("b", "a", "sub/c"):
        (data / name).parent.mkdir(parents=True, exist_ok=True)
        (data / f"{name}.parquet").write_bytes(name.encode() * 10)
    (data / "skip.txt").write_text("no")
    return data, str(tmp_path / "control")


def test_manifest_matches_hashlib(spark, lake):
    data, ctl = lake
    lines = []
    for p in sorted(data.rglob("*.parquet"), key=lambda p: str(p.relative_to(data))):
        lines.append(f"{p.relative_to(data)}:{hashlib.sha256(p.read_bytes()).hexdigest()}")
    buckets = {}
    for line in lines:
        buckets.setdefault(hashlib.md5(line.rsplit(":", 1)[0].encode()).hexdigest()[:4], []).append(line)
    hashed = [f"{b}:{hashlib.sha256(chr(10).join(sorted(own)).encode()).hexdigest()}" for b, own in buckets.items()]
    want = hashlib.sha256("\n".join(sorted(hashed)).encode()).hexdigest()
    assert control.build_manifest(spark, str(data), ctl, "bronze") == want
    assert control.build_manifest(spark, f"file:{data}/", ctl, "bronze") == want
    assert control.verify_manifest(spark, ctl, "bronze", want) == want
    with pytest.raises(integrity.IntegrityError, match="composite"):
        control.verify_manifest(spark, ctl, "bronze", "0" * 64)


def test_manifest_does_not_depend_on_row_order(spark, lake):
    files = integrity.file_hashes(spark, str(lake[0]))
    assert integrity.manifest_hash(files.repartition(3)).head() == integrity.manifest_hash(files).head()
    assert integrity.manifest_hash(files.limit(0)).head()["file_count"] == 0


def test_open_column_names(spark, rows):
    df = spark.createDataFrame([("k", 1, [2], "x")], "key string, `a.b` int, `c``d` array<int>, ENI string")
    assert rows(as_text(df)) == [("k", "1", "[2]", "x")]
    one, other = (content_digests(d, ["key"]).head()["content_hash"] for d in (df, df.withColumn("a.b", F.lit(2))))
    assert one != other
    wide = spark.createDataFrame([("ENI.MI", "net.income", 1.0, 2.0), ("ENI.MI", "sales", 3.0, None)], "ticker string, item string, `2024.Q1` double, `2024.Q2` double")
    out = transpose_statement(wide, ["ticker"], "item")
    assert out.columns == ["ticker", "period", "net.income", "sales"]
    assert rows(out) == [("ENI.MI", "2024.Q1", 1.0, 3.0), ("ENI.MI", "2024.Q2", 2.0, None)]


def test_missing_and_tampered_files_stop_the_gate(spark, rows, lake):
    data, ctl = lake
    control.build_manifest(spark, str(data), ctl, "bronze")
    (data / "new.parquet").write_bytes(b"extra")
    control.verify_manifest(spark, ctl, "bronze")  # an unlisted file is no harm
    (data / "a.parquet").write_bytes(b"changed")
    (data / "b.parquet").unlink()
    _, recorded = control.load_manifest(spark, ctl, "bronze")
    compared = integrity.compare_files(recorded, integrity.file_hashes(spark, str(data)))
    assert rows(compared) == [
        ("a.parquet", "tampered"),
        ("b.parquet", "missing"),
        ("new.parquet", "unlisted"),
        ("sub/c.parquet", "ok"),
    ]
    with pytest.raises(integrity.IntegrityError, match="tampered"):
        control.verify_manifest(spark, ctl, "bronze")


@pytest.mark.parametrize(
    "line, hit",
    [
        ("fatal: no", True),
        ("Traceback (most recent call last)", True),
        ("wrote 0 rows", True),
        ("wrote 0 ROWS.", True),
        ("wrote 250 rows", False),
        ("ValueException: x", True),
        ("exception handling", False),
        ("all good", False),
    ],
)
def test_log_rules(spark, line, hit):
    df = spark.createDataFrame([(f"  {line} ",)], "line string")
    assert [r["line"] for r in integrity.log_issues(df).collect()] == ([line] if hit else [])
    assert integrity.log_status(df).head()["status"] == ("CRITICAL" if hit else "OK")


def test_custody_and_gate(spark, lake):
    data, ctl = lake
    want = control.build_manifest(spark, str(data), ctl, "bronze")
    good = spark.createDataFrame([("fine",)], "line string")
    bad = spark.createDataFrame([("fine",), (" FATAL x",)], "line string")
    control.gate(spark, ctl, "bronze", good, want)
    with pytest.raises(integrity.IntegrityError, match="FATAL x"):
        control.gate(spark, ctl, "bronze", bad)
    control.gate(spark, ctl, "bronze", None)
    entries = control.custody_tail(spark, ctl, 2).collect()
    assert [(e["verdict"], e["issue_count"], e["file_count"]) for e in entries] == [("PASSED", 0, 3), ("FAILED", 1, 3)]
    assert entries[0]["manifest_hash"] == want

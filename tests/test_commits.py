import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.sources import commits, files, sinks
from quotelake.sources.paths import create_once
from quotelake.schemas import TableSpec

SCHEMA = T.StructType([T.StructField("ticker", T.StringType()), T.StructField("year", T.IntegerType()), T.StructField("x", T.DoubleType())])
BY = ("ticker", "year")


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


OLD = [("A", 2023, 1.0), ("A", 2024, 2.0), ("B", 2024, 3.0)]
NEW = [("A", 2024, 9.0), ("C", 2024, 4.0)]
BOTH = [("A", 2023, 1.0), ("A", 2024, 9.0), ("B", 2024, 3.0), ("C", 2024, 4.0)]


class Killed(Exception):
    pass


def after_the(step):
    def killed(*args, **kwargs):
        step(*args, **kwargs)
        raise Killed

    return killed


def half_of(write):
    """Only some of the files get written."""

    def killed(df, path, by, version):
        write(df.limit(1), path, by, version)
        raise Killed

    return killed


def refused(*_, **__):
    raise Killed


STEPS = {
    "half the data": ("_write_data", half_of),
    "all the data": ("_write_data", after_the),
    "before the list": ("_list_folders", lambda step: refused),
    "after the list": ("_list_folders", after_the),
    "before the commit": ("_publish", lambda step: refused),
}


@pytest.mark.parametrize("write", ["touched", "whole", "append"])
@pytest.mark.parametrize("step", [*STEPS, "after the commit"])
def test_a_killed_write_is_seen_whole_or_not_at_all(spark, rows, tmp_path, monkeypatch, write, step):
    path = str(tmp_path / "t")
    commits.replace(frame(spark, *OLD), path, BY)
    attempt = {
        "touched": lambda: commits.replace_touched(frame(spark, *NEW), path, BY),
        "whole": lambda: commits.replace(frame(spark, *NEW), path, BY),
        "append": lambda: commits.append(frame(spark, *NEW), path, BY),
    }[write]
    want = {"touched": BOTH, "whole": NEW, "append": sorted(OLD + NEW)}[write]
    with monkeypatch.context() as patch:
        name, kill = STEPS.get(step, ("_publish", after_the))
        patch.setattr(commits, name, kill(getattr(commits, name)))
        with pytest.raises(Killed):
            attempt()
    got = rows(commits.read(spark, path, SCHEMA))
    assert got == (want if step == "after the commit" else OLD)
    if step != "after the commit":
        attempt()
        assert rows(commits.read(spark, path, SCHEMA)) == want
        left = commits.unreferenced(spark, path, SCHEMA, BY).count()
        assert (left > 0) == (step in STEPS or write != "append")


def test_first_write_killed(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    with monkeypatch.context() as patch:
        patch.setattr(commits, "_publish", refused)
        with pytest.raises(Killed):
            commits.replace(frame(spark, *OLD), path, BY)
    assert commits.read(spark, path, SCHEMA).isEmpty() and not commits.is_committed(spark, path)
    commits.replace_touched(frame(spark, *NEW), path, BY)
    assert rows(commits.read(spark, path, SCHEMA)) == NEW


def test_two_writers_from_one_commit(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    commits.replace(frame(spark, *OLD), path, BY)
    publish = commits._publish

    def late(session, where, entry):
        monkeypatch.setattr(commits, "_publish", publish)
        commits.replace_touched(frame(spark, ("B", 2024, 7.0)), path, BY)
        publish(session, where, entry)

    monkeypatch.setattr(commits, "_publish", late)
    with pytest.raises(commits.Conflict):
        commits.replace_touched(frame(spark, *NEW), path, BY)
    assert rows(commits.read(spark, path, SCHEMA)) == [("A", 2023, 1.0), ("A", 2024, 2.0), ("B", 2024, 7.0)]


def test_create_once(spark, tmp_path):
    path = str(tmp_path / "x.json")
    assert create_once(spark, path, "one") and not create_once(spark, path, "two")
    assert (tmp_path / "x.json").read_text() == "one"
    assert not [name for name in os.listdir(tmp_path) if "draft" in name]


def test_readers_keep_their_commit(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    first = commits.replace(frame(spark, *OLD), path, BY)
    before = commits.read(spark, path, SCHEMA)
    second = commits.replace_touched(frame(spark, *NEW), path, BY)
    assert rows(before) == OLD  # planned before, read after
    assert rows(commits.read(spark, path, SCHEMA, first)) == OLD
    assert rows(commits.read(spark, path, SCHEMA, after=first)) == NEW
    assert commits.read(spark, path, SCHEMA, after=second).isEmpty()
    only = spark.createDataFrame([("A", 2024), ("Z", 1)], "ticker string, year int")
    assert rows(commits.read(spark, path, SCHEMA, only=only)) == [("A", 2024, 9.0)]


def test_many_commits_are_listed_anew(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "COMPACT_EVERY", 3)
    path, want = str(tmp_path / "t"), {}
    for k in range(8):
        row = ("AB"[k % 2], 2020 + k % 3, float(k))
        want[row[:2]] = [row] if k % 4 else [*want.get(row[:2], []), row]
        (commits.replace_touched if k % 4 else commits.append)(frame(spark, row), path, BY, f"s:{k}")
        assert rows(commits.read(spark, path, SCHEMA)) == sorted(r for own in want.values() for r in own)
    bases = [e["base"] for e in commits._entries(spark, path, range(1, 9))]
    assert bases == [1, 1, 1, 4, 4, 4, 7, 7]
    assert commits.has_source(spark, path, "s:2") and not commits.has_source(spark, path, "s:9")


def test_emptied_partitions(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "COMPACT_EVERY", 2)
    path = str(tmp_path / "t")
    commits.replace(frame(spark, *OLD), path, BY)
    gone = spark.createDataFrame([("A", 2023), ("A", 2024), ("Z", 1)], "ticker string, year int")
    commits.replace_touched(frame(spark, *NEW), path, BY, gone=gone)
    assert rows(commits.read(spark, path, SCHEMA)) == [("A", 2024, 9.0), ("B", 2024, 3.0), ("C", 2024, 4.0)]
    commits.replace_touched(frame(spark), path, BY, gone=gone)
    assert rows(commits.read(spark, path, SCHEMA)) == [("B", 2024, 3.0), ("C", 2024, 4.0)]
    commits.append(frame(spark, ("A", 2023, 6.0)), path, BY)
    assert rows(commits.read(spark, path, SCHEMA)) == [("A", 2023, 6.0), ("B", 2024, 3.0), ("C", 2024, 4.0)]


def test_odd_names_and_null_partitions(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    odd = ["007", "1e5", "a/b +c%d", "é=ñ", "x y", "{[*]}", "a:b#?"]
    data = [(t, 2024, float(k)) for k, t in enumerate(odd)] + [(None, None, 9.0)]
    commits.replace(frame(spark, *data), path, BY)
    assert rows(commits.read(spark, path, SCHEMA)) == sorted(data, key=lambda r: tuple((v is not None, str(v)) for v in r))
    commits.replace_touched(frame(spark, ("a/b +c%d", 2024, 50.0), (None, None, 51.0)), path, BY)
    got = {r["ticker"]: r["x"] for r in commits.read(spark, path, SCHEMA).collect()}
    assert got["a/b +c%d"] == 50.0 and got[None] == 51.0 and len(got) == len(data)
    only = spark.createDataFrame([("é=ñ", 2024), (None, None)], "ticker string, year int")
    assert commits.read(spark, path, SCHEMA, only=only).count() == 2
    assert commits.unreferenced(spark, path, SCHEMA, BY).count() == 2


def test_empty_and_unpartitioned(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    commits.replace(frame(spark), path)
    assert commits.is_committed(spark, path) and files.read_table(spark, path, SCHEMA).isEmpty()
    commits.replace(commits.read(spark, path, SCHEMA).unionAll(frame(spark, *OLD)), path)
    commits.append(frame(spark, *NEW), path)
    assert rows(files.read_table(spark, path, SCHEMA)) == sorted(OLD + NEW)
    commits.replace(commits.read(spark, path, SCHEMA).where("x > 8"), path)
    assert rows(files.read_table(spark, path, SCHEMA)) == [("A", 2024, 9.0)]
    commits.replace_touched(frame(spark), str(tmp_path / "u"), BY)
    assert commits.read(spark, str(tmp_path / "u"), SCHEMA).isEmpty()


def test_foreign_files_are_not_hidden(spark, tmp_path):
    path = str(tmp_path / "t")
    frame(spark, *OLD).write.partitionBy(*BY).parquet(path)
    with pytest.raises(RuntimeError, match="no commit"):
        commits.replace_touched(frame(spark, *NEW), path, BY)
    assert files.read_table(spark, path, SCHEMA).count() == 3


def test_slices_in_one_commit(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "f")
    spec = TableSpec("f", SCHEMA, ("ticker", "year"), (), partition=("year",))
    sinks.load_slices(frame(spark, *OLD), path, spec, ("year",))
    monkeypatch.setattr(commits, "_publish", refused)
    with pytest.raises(Killed):
        sinks.load_slices(frame(spark, *NEW), path, spec, ("ticker", "year"))
    assert rows(files.read_table(spark, path, SCHEMA)) == OLD
    monkeypatch.undo()
    sinks.load_slices(frame(spark, *NEW), path, spec, ("ticker", "year"))
    assert rows(files.read_table(spark, path, SCHEMA)) == BOTH
    sinks.load_slices(frame(spark, *NEW), path, spec, ("year",))
    assert rows(files.read_table(spark, path, SCHEMA)) == [OLD[0], *NEW]
    assert files.read_table(spark, path, SCHEMA).where(F.col("year") == 2023).count() == 1

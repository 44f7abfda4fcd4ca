import os

import pytest
from pyspark.sql import functions as F

from quotelake.operators import integrity
from quotelake.plans.bronze import land_prices
from quotelake.plans.silver import run_silver
from quotelake.schemas import MANIFEST, PRICE_HISTORY, TAKEN
from quotelake.sources import commits, control
from quotelake.sources.files import read_table
from quotelake.sources.paths import listing, set_modified
from tests.test_jobs import landed
from tests.test_series import bars


def put(root, name, text="x", at=None):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    if at is not None:
        os.utime(path, (at, at))


def take(spark, root, ctl, pattern="*.txt"):
    files = control.unseen_files(spark, ctl, "in", str(root), pattern)
    control.record_files(files, ctl, "in")
    return sorted(r["path"] for r in files.collect())


def test_every_file_is_taken_once_whatever_its_time(spark, tmp_path):
    root, ctl = tmp_path / "in", str(tmp_path / "ctl")
    assert take(spark, root, ctl) == []
    put(root, "a/1.txt", at=1_700_000_000)
    put(root, "b/2.txt", at=1_700_000_000)
    put(root, "a/no.csv")
    assert take(spark, root, ctl) == ["a/1.txt", "b/2.txt"]
    assert take(spark, root, ctl) == []
    put(root, "a/3.txt", at=1_700_000_000)  # the same time
    put(root, "c/d/4.txt", at=1_600_000_000)  # an older time
    assert take(spark, root, ctl) == ["a/3.txt", "c/d/4.txt"]
    put(root, "a/1.txt", "longer", at=1_700_000_000)  # written again
    os.remove(root / "b/2.txt")
    assert take(spark, root, ctl) == ["a/1.txt"]
    put(root, "b/2.txt", at=1_700_000_000)  # back as it was
    assert take(spark, root, ctl) == []


def test_a_run_that_fails_takes_its_files_again(spark, tmp_path):
    root, ctl = tmp_path / "in", str(tmp_path / "ctl")
    put(root, "a.txt")
    assert control.unseen_files(spark, ctl, "in", str(root), "*.txt").count() == 1
    assert take(spark, root, ctl) == ["a.txt"]


def test_ledgers_are_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "COMPACT_EVERY", 3)
    root, ctl = tmp_path / "in", str(tmp_path / "ctl")
    for k in range(8):
        put(root, f"{k % 2}/{k}.txt", at=1_700_000_000 - k)
        assert take(spark, root, ctl) == [f"{k % 2}/{k}.txt"]
    assert take(spark, root, ctl) == []
    assert read_table(spark, f"{ctl}/ledgers/in", TAKEN).count() == 8


def test_folders_at_rest_are_left_out_by_their_sums(spark):
    taken = spark.createDataFrame([(f"f{k % 3}/{k}", k, k) for k in range(30)], "path string, length long, modified long")
    found = taken.union(spark.createDataFrame([("f1/new", 1, 1), ("f9/x", 1, 1)], taken.schema)).where("path <> 'f2/2'")
    assert sorted(r["path"] for r in control.unseen(found, taken).collect()) == ["f1/new", "f9/x"]


def test_silver_takes_late_files_with_old_times(spark, tmp_path):
    bronze, silver = str(tmp_path / "b"), str(tmp_path / "s")
    pdf = bars(30, tickers=("A",), start="2020-01-01", step="1D").sort_values("date")
    land_prices(landed(spark, pdf.head(20)).drop("extraction_timestamp"), bronze)
    assert run_silver(spark, bronze, silver)
    before = {r["path"] for r in listing(spark, bronze).collect()}
    land_prices(landed(spark, pdf).drop("extraction_timestamp"), bronze)
    for r in listing(spark, bronze).collect():
        if r["path"] not in before:
            set_modified(spark, f"{bronze}/{r['path']}", 1_000_000_000_000)
    assert run_silver(spark, bronze, silver)
    assert read_table(spark, f"{silver}/price_history", PRICE_HISTORY).count() == 30
    assert not run_silver(spark, bronze, silver)


def heads(spark, ctl):
    return spark.read.schema(MANIFEST).json(f"{ctl}/manifests/s/heads").orderBy("generated_at").collect()


def whole(spark, root):
    return integrity.manifest_hash(integrity.file_hashes(spark, str(root), "*.txt")).head()["manifest_hash"]


def test_second_builds_hash_what_changed(spark, tmp_path):
    root, ctl = tmp_path / "data", str(tmp_path / "ctl")
    build = lambda **how: control.build_manifest(spark, str(root), ctl, "s", "*.txt", **how)
    for k in range(40):
        put(root, f"{k % 4}/{k}.txt", str(k))
    assert build() == whole(spark, root)
    assert build() == whole(spark, root)
    put(root, "5/new[1].txt", "new")
    put(root, "1/1.txt", "altered")
    os.remove(root / "2/2.txt")
    assert build() == whole(spark, root)
    os.remove(root / "3/3.txt")
    assert build() == whole(spark, root)
    assert build(full=True) == whole(spark, root)
    assert [(h["hashed"], h["file_count"]) for h in heads(spark, ctl)] == [(40, 40), (0, 40), (2, 40), (0, 39), (39, 39)]
    assert control.verify_manifest(spark, ctl, "s", pattern="*.txt") == whole(spark, root)


def test_builds_that_die_change_nothing(spark, tmp_path, monkeypatch):
    root, ctl = tmp_path / "data", str(tmp_path / "ctl")
    build = lambda: control.build_manifest(spark, str(root), ctl, "s", "*.txt")
    for k in range(12):
        put(root, f"{k}.txt", str(k))
    first = build()
    put(root, "0.txt", "other")
    for name in ("bucket_hashes", "tree_hash"):
        with monkeypatch.context() as patch:
            patch.setattr(control, name, lambda *_: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                build()
        assert control.load_manifest(spark, ctl, "s")[0]["manifest_hash"] == first
    os.remove(root / "1.txt")
    assert build() == whole(spark, root)
    assert control.verify_manifest(spark, ctl, "s", pattern="*.txt") == whole(spark, root)


@pytest.mark.parametrize(("disguised", "full", "found"), [(False, False, True), (False, True, True), (True, True, True), (True, False, False)])
def test_tampering(spark, tmp_path, disguised, full, found):
    root, ctl = tmp_path / "data", str(tmp_path / "ctl")
    for k in range(6):
        put(root, f"{k}.txt", "aa", at=1_700_000_000)
    control.build_manifest(spark, str(root), ctl, "s", "*.txt")
    put(root, "touched.txt")  # not listed
    os.utime(root / "2.txt", (1_800_000_000, 1_800_000_000))  # another time, the same content
    put(root, "4.txt", "bb", at=1_700_000_000 if disguised else None)
    if found:
        with pytest.raises(integrity.IntegrityError, match="4.txt .tampered"):
            control.verify_manifest(spark, ctl, "s", pattern="*.txt", full=full)
    else:
        control.verify_manifest(spark, ctl, "s", pattern="*.txt", full=full)


def test_nothing_but_the_named_files_is_opened(spark, tmp_path, monkeypatch):
    root = tmp_path / "data"
    for name in ("a b.txt", "{c}.txt", "d*.txt", "sub/é[x].txt", "plain.txt"):
        put(root, name, name)
    every = {r["path"]: r["sha256"] for r in integrity.file_hashes(spark, str(root), "*.txt").collect()}
    some = spark.createDataFrame([(n,) for n in every if n != "plain.txt"], "path string")
    got = {r["path"]: r["sha256"] for r in integrity.hashes_of(spark, str(root), some).collect()}
    assert got == {n: h for n, h in every.items() if n != "plain.txt"}
    monkeypatch.setattr(integrity, "MAX_NAMED", 2)
    assert {r["path"]: r["sha256"] for r in integrity.hashes_of(spark, str(root), some, "*.txt").collect()} == got
    assert integrity.hashes_of(spark, str(root), some.where(F.lit(False))).count() == 0

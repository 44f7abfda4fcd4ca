"""Files hashed by ranges, the state of the chain going from task to task."""

import hashlib
import random

import pytest

from quotelake.operators import integrity, large_files


@pytest.fixture
def folder(tmp_path, spark):
    rng = random.Random(5)
    contents = {
        "a/random.bin": rng.randbytes(300_001),
        "a/ends in line.bin": rng.randbytes(200_000) + b"\n",
        "a/marked.bin": b"\xef\xbb\xbf" + rng.randbytes(150_000) + b"x",
        "b/marked and ends.bin": b"\xef\xbb\xbf" + rng.randbytes(150_000) + b"\n",
        "b/lines.bin": b"\n" * 120_000,
        "b/no lines.bin": b"\r\0" * 90_000,
        "b/packed.bin.gz": rng.randbytes(100_000),
        "b/at the limit.bin": rng.randbytes(65_536),
        "b/small.bin": b"abc",
    }
    for name, data in contents.items():
        path = tmp_path / "data" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    splits = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    yield str(tmp_path / "data"), {name: (hashlib.sha256(data).hexdigest(), len(data)) for name, data in contents.items()}
    spark.conf.set("spark.sql.files.maxPartitionBytes", splits)


def test_ranges_give_the_sha256_of_the_file(spark, folder, monkeypatch):
    root, wanted = folder
    monkeypatch.setattr(large_files, "RANGE_BYTES", 65_536)
    monkeypatch.setattr(large_files, "PIECE_BYTES", 1_000)
    # a file above this must not be a row
    monkeypatch.setattr(integrity, "MAX_FILE_BYTES", 100_000)
    found = integrity.file_hashes(spark, root, "*.bin*")
    assert {r["path"]: (r["sha256"], r["length"]) for r in found.collect()} == wanted
    named = spark.createDataFrame([("a/random.bin",), ("b/small.bin",)], "path string")
    assert {r["path"]: r["sha256"] for r in integrity.hashes_of(spark, root, named).collect()} == {n: wanted[n][0] for n in ("a/random.bin", "b/small.bin")}


def test_a_state_goes_on_where_it_was_left():
    data = random.Random(6).randbytes(1_000)
    state = None
    for at in range(0, 1_000, 77):
        sha = large_files.Sha256(state)
        sha.update(data[at : at + 77])
        state = sha.state()
    assert large_files.Sha256(state).hexdigest() == hashlib.sha256(data).hexdigest()

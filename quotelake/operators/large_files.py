"""SHA-256 of files too large for one task.

SHA-256 is one chain over the bytes of a file in order, so its state goes from task to task: each takes a range of a file, starts from the
state the one before it left, and returns 112 bytes. Files are split by Spark's text reader, whose rows (the runs between newlines) are
stored as pieces with their place; a round hashes one range of every file. A task never holds more than a range, and files follow their own chains side by side.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import _hashlib
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.session import work_folder
from quotelake.sources.paths import literal

RANGE_BYTES = 256 << 20
PIECE_BYTES = 512 << 10

# Text files with these endings are unpacked when they are read.
PACKED = (".gz", ".bz2", ".deflate", ".lz4", ".snappy", ".zst")

_BYTE_ORDER_MARK = b"\xef\xbb\xbf"  # left out of the first row of a file by the reader


class LargeFile(NamedTuple):
    path: str
    length: int
    uri: str  # as rows name it


class Sha256:
    """OpenSSL's SHA-256, whose state can be taken out and put back."""

    _SIZE = 112

    def __init__(self, state: bytes | None = None):
        self._lib = ctypes.CDLL(_hashlib.__file__)  # linked with libcrypto
        self._state = ctypes.create_string_buffer(state or bytes(self._SIZE), self._SIZE)
        if state is None:
            self._lib.SHA256_Init(self._state)

    def update(self, data: bytes) -> None:
        self._lib.SHA256_Update(self._state, data, ctypes.c_size_t(len(data)))

    def state(self) -> bytes:
        return self._state.raw

    def hexdigest(self) -> str:
        out = ctypes.create_string_buffer(32)
        self._lib.SHA256_Final(out, self._state)
        return out.raw.hex()


PIECES = "file int, start long, piece long, size long, data binary, range long"


def _stored_pieces(spark: SparkSession, files: Sequence[LargeFile], range_bytes: int) -> DataFrame:
    """Every byte of the files (with a newline at the end of each) in pieces, ordered by file, start and piece."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, piece = None, 0
        for batch in batches:
            file, start = batch.column("file"), batch.column("start")
            at = 0
            while at < batch.num_rows:
                own = (file[at].as_py(), start[at].as_py())
                same = pc.and_(pc.equal(file, own[0]), pc.equal(start, own[1]))
                stop = pc.index(same.slice(at), False).as_py()
                stop = batch.num_rows if stop < 0 else at + stop
                if own != block:
                    block, piece = own, 0
                rows = batch.column("value").slice(at, stop - at).cast(pa.large_binary())
                runs = pa.LargeListArray.from_arrays(pa.array([0, len(rows)], pa.int64()), rows)
                data = pc.binary_join(runs, pa.scalar(b"\n", pa.large_binary()))[0].as_py() + b"\n"
                parts = [data[k : k + PIECE_BYTES] for k in range(0, len(data), PIECE_BYTES)]
                n = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([own[0]] * n, pa.int32()),
                        pa.array([own[1]] * n, pa.int64()),
                        pa.array(range(piece, piece + n), pa.int64()),
                        pa.array([len(p) for p in parts], pa.int64()),
                        pa.array(parts, pa.binary()),
                        pa.array([own[1] // range_bytes] * n, pa.int64()),
                    ],
                    names=[column.split()[0] for column in PIECES.split(", ")],
                )
                piece += n
                at = stop

    names = F.broadcast(spark.createDataFrame([(k, f.uri) for k, f in enumerate(files)], "file int, uri string"))
    rows = spark.read.option("lineSep", "\n").text([literal(f.path) for f in files])
    rows = rows.select(F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("value"))
    store = work_folder(spark, "pieces")
    rows.join(names, "uri").select("file", "start", "value").mapInArrow(pieces, PIECES).write.partitionBy("range").parquet(store)
    return spark.read.schema(PIECES).parquet(store)


def sha256_by_ranges(spark: SparkSession, files: Sequence[LargeFile], range_bytes: int | None = None) -> list[str]:
    """The SHA-256 of each file, in hex. The driver holds 112 bytes a file."""
    range_bytes = range_bytes or RANGE_BYTES
    order = sorted(range(len(files)), key=lambda k: -files[k].length)
    files = [files[k] for k in order]
    stored = _stored_pieces(spark, files, range_bytes)
    sizes = {r["file"]: r["size"] for r in stored.groupBy("file").agg(F.sum("size").alias("size")).collect()}
    marked = []
    for k, f in enumerate(files):
        more = sizes.get(k, 0) - f.length  # a newline more where the file does not end in one
        if more not in (0, 1, -3, -2):
            raise OSError(f"{f.path} changed while it was read: {f.length} bytes listed, {sizes.get(k, 0)} read")
        marked.append(more < 0)
    lengths = [f.length for f in files]
    held = {k: (Sha256().state(), 0) for k in range(len(files))}
    for number in range(-(-files[0].length // range_bytes)):
        states = dict(held)

        def hashed(batches: Iterator[pa.RecordBatch], states=states) -> Iterator[pa.RecordBatch]:
            now, sha, done = None, None, 0

            def out() -> pa.RecordBatch:
                columns = [pa.array([now], pa.int32()), pa.array([sha.state()], pa.binary()), pa.array([done], pa.int64())]
                return pa.RecordBatch.from_arrays(columns, names=["file", "state", "done"])

            for batch in batches:
                for file, data in zip(batch.column("file").to_pylist(), batch.column("data"), strict=True):
                    if file != now:
                        if now is not None:
                            yield out()
                        now, sha, done = file, Sha256(states[file][0]), states[file][1]
                        if not done and marked[file]:
                            sha.update(_BYTE_ORDER_MARK)
                            done = len(_BYTE_ORDER_MARK)
                    part = data.as_py()[: lengths[file] - done]
                    sha.update(part)
                    done += len(part)
            if now is not None:
                yield out()

        # the longest files come first, so those that reach this range are 0 to n - 1; a task takes one
        n = sum(length > number * range_bytes for length in lengths)
        part = stored.where(F.col("range") == number).select("file", "start", "piece", "data")
        placed = part.repartitionById(n, F.col("file")).sortWithinPartitions("file", "start", "piece")
        for r in placed.mapInArrow(hashed, "file int, state binary, done long").collect():
            held[r["file"]] = (bytes(r["state"]), r["done"])
    found = {order[k]: Sha256(held[k][0]).hexdigest() for k in range(len(files))}
    return [found[k] for k in range(len(files))]

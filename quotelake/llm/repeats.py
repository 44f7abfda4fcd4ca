"""Removal of byte strings that an earlier document holds, by suffix arrays over shards.

Every string of ``length`` bytes that also starts in a document with a smaller doc_id is removed, exactly; overlaps count, and strings are judged on the input.

A string's anchor is the least hash among its runs of ANCHOR bytes, so equal strings have equal anchors, whatever is around them. First the distinct anchors
of each pack of texts meet by ranges of hash, which tells the anchors of two documents or more from those of one; only strings with the former can
repeat. Successive strings with one anchor overlap and travel as one segment, to the shard that the anchor belongs to. A shard puts its
distinct segments (but those of one document without a string that occurs elsewhere) one after the other, sorts all their suffixes by induced sorting, and computes the permuted common prefixes: suffixes that
share ``length`` symbols with their neighbour are the same string, and the least doc_id among their segments is the first to hold it. That gives each segment's
repeated stretches, which go back to the texts.

Texts that are equal as a whole are told apart by the first 128 bits of their SHA-256: only the one with the least doc_id is looked into, the others are repeats from end to end. Packs hold
texts up to PACK_BYTES (or one text) and are stored in buckets, so that what is found out about them comes to them and they are not shuffled again. Shards are
sized by the bytes that hits announce. An anchor of more than HOT_DOCS documents would fill a shard, so its strings are not put together: each goes by its own 128-bit hash to the least doc_id that holds it, which combines before the shuffle, and back by a join.

Null texts are empty. Rows with equal doc_id are one document as far as "smaller" goes: none of them is an earlier document to the others. Rows with a null doc_id stay
as they are and are earlier than none. Texts of fewer than ``length`` bytes have no such string. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.llm import suffixes
from quotelake.llm import words as W
from quotelake.operators.sizing import broadcast_if_small
from quotelake.session import work_folder

LENGTH = 50
ANCHOR = 20
PACK_BYTES = 2 << 20
RANGE_ANCHORS = 4_000_000
SHARD_BYTES = 8 << 20
BUCKET_BYTES = 32 << 20
HOT_DOCS = 32_768

PACK = "ids binary, ends binary, data binary"
RANGE = "range long, pack long, anchors binary, docs binary"
HITS = "pack long, anchors binary, n long, hot long"
SEGMENTS = "shard long, pack long, bytes binary, places binary"
SPANS = "pack long, spans binary"
WINDOWS = "h1 long, h2 long, doc long, pack long, text int, start long"
KEPT = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"

_BASES = (0xD6E8FEB86659FD93, 0xA24BAED4963EE407)


def window_hashes(data: np.ndarray, length: int, base: int = _BASES[0]) -> np.ndarray:
    """A 64-bit hash of each run of ``length`` bytes, built from runs of powers of two."""
    n = len(data) - length + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    run, width, out, done = W._BYTE_VALUES[data], 1, None, 0
    with np.errstate(over="ignore"):
        while True:
            if length & width:
                if out is None:
                    out = run[: len(data) - width + 1]
                else:
                    rows = len(data) - done - width + 1
                    out = out[:rows] * np.uint64(pow(base, width, 1 << 64)) + run[done : done + rows]
                done += width
            if done == length:
                return W.mixed(out[:n])
            rows = len(run) - width
            run = run[:rows] * np.uint64(pow(base, width, 1 << 64)) + run[width : width + rows]
            width *= 2


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least value in each run of ``width`` values."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[: len(values) - span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def anchored_runs(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Runs of successive strings with one anchor, in texts of at least ``length`` bytes that end at ``ends`` in data: anchor (the last bit is
    zero), text, place of the first string in data, and number of strings."""
    hashes = window_hashes(data, anchor) & ~np.uint64(1)
    least = least_of(hashes, length - anchor + 1)
    starts = np.concatenate(([0], ends[:-1]))
    inside = np.ones(len(least), bool)
    for back in range(1, length):
        edge = ends - back
        inside[edge[edge < len(least)]] = False
    begins = inside.copy()
    begins[1:] &= (least[1:] != least[:-1]) | ~inside[:-1]
    begins[starts] = True
    first = np.flatnonzero(begins)
    stops = np.append(first[1:], len(least))
    total = np.concatenate(([0], np.cumsum(inside)))
    return least[first], np.searchsorted(ends, first, "right"), first, total[stops] - total[first]


def _longs(value: pa.Scalar, kind: str = "<i8") -> np.ndarray:
    return np.frombuffer(value.as_buffer(), kind)


def _binaries(parts: list[np.ndarray]) -> pa.Array:
    return pa.array([p.tobytes() for p in parts], pa.binary())


def bucket_count(total: int) -> int:
    return max(1, -(-total // BUCKET_BYTES))


def _by_pack(rows: DataFrame, column: str, name: str, total: int) -> DataFrame:
    """What there is of a pack in one list, partitioned as the packs are stored, so that a join leaves these where they are."""
    return rows.repartition(bucket_count(total), "pack").groupBy("pack").agg(F.collect_list(column).alias(name))


def _packs(rows: DataFrame, total: int) -> DataFrame:
    """Texts put together in packs, stored in buckets, with a number that stays. total: the bytes of all texts."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            data, offsets = W.text_bytes(batch.column("text"))
            first = 0
            while first < len(ids):
                last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + PACK_BYTES, "right")) - 1)
                own = [ids[first:last], offsets[first + 1 : last + 1] - offsets[first], data[offsets[first] : offsets[last]]]
                yield pa.RecordBatch.from_arrays([_binaries([x]) for x in own], names=["ids", "ends", "data"])
                first = last

    spark = rows.sparkSession
    store = work_folder(spark, "packs")
    buckets = bucket_count(total)
    numbered = rows.mapInArrow(packed, PACK).withColumn("pack", F.monotonically_increasing_id()).repartition(buckets, "pack")
    # the table's name only serves to say that it is bucketed; its files are in the work folder and stay there
    name = store.rsplit("/", 1)[-1].replace("-", "_")
    numbered.write.option("path", store).option("compression", "zstd").bucketBy(buckets, "pack").saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return stored


def _hits(packs: DataFrame, total: int, length: int, hot_docs: int) -> DataFrame:
    """For each pack and range of hashes the anchors that two documents or more have (those of more than ``hot_docs`` with the last bit set). Stored."""
    spark = packs.sparkSession
    # an anchor is the least of length - ANCHOR + 1 hashes, so it changes about every half of that
    ranges = max(1, -(-2 * total // ((length - ANCHOR + 2) * RANGE_ANCHORS)))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                least, text, _, _ = anchored_runs(np.frombuffer(batch.column("data")[k].as_buffer(), np.uint8), _longs(batch.column("ends")[k]), length)
                order = np.lexsort((text, least))
                least, text = least[order], text[order]
                new = np.ones(len(least), bool)
                new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
                least, docs = np.unique(least[new], return_counts=True)
                home = (W.mixed(least) % np.uint64(ranges)).astype(np.int64)
                order = np.argsort(home, kind="stable")
                cuts = np.flatnonzero(np.diff(home[order])) + 1
                parts = np.split(order, cuts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(home[p[0]]) for p in parts], pa.int64()),
                        pa.array([batch.column("pack")[k].as_py()] * len(parts), pa.int64()),
                        _binaries([least[p] for p in parts]),
                        _binaries([docs[p].astype(np.uint8 if docs[p].max() < 256 else "<i4") for p in parts]),
                    ],
                    names=["range", "pack", "anchors", "docs"],
                )

    def shared(table: pa.Table) -> pa.Table:
        own = [_longs(a, "<u8") for a in table.column("anchors")]
        unique, place = np.unique(np.concatenate(own), return_inverse=True)
        docs = np.zeros(len(unique), np.int64)
        counts = [_longs(d, "u1" if len(d.as_buffer()) == n else "<i4") for d, n in zip(table.column("docs"), map(len, own), strict=True)]
        np.add.at(docs, place, np.concatenate(counts).astype(np.int64))
        marked = unique | (docs > hot_docs).astype(np.uint64)
        packs, found, at = [], [], 0
        for pack, size in zip(table.column("pack").to_pylist(), map(len, own), strict=True):
            p = place[at : at + size]
            p, at = p[docs[p] > 1], at + size
            if len(p):
                packs.append(pack)
                found.append(marked[p])
        n = [len(f) for f in found]
        hot = [int((f & np.uint64(1)).sum()) for f in found]
        return pa.table({"pack": pa.array(packs, pa.int64()), "anchors": _binaries(found), "n": pa.array(n, pa.int64()), "hot": pa.array(hot, pa.int64())})

    store = work_folder(spark, "hits")
    packs.select("pack", "ends", "data").mapInArrow(anchors, RANGE).groupBy("range").applyInArrow(shared, HITS).write.parquet(store)
    return spark.read.schema(HITS).parquet(store)


def _chosen(batch: pa.RecordBatch, k: int, length: int, hot: bool) -> tuple[np.ndarray, ...]:
    """Data, document and text, place and strings of the runs in a pack whose anchor is shared (and hot, or not)."""
    data, ends = np.frombuffer(batch.column("data")[k].as_buffer(), np.uint8), _longs(batch.column("ends")[k])
    wanted = np.concatenate([_longs(a, "<u8") for a in batch.column("hits")[k].values])
    wanted = np.sort(wanted[(wanted & np.uint64(1)).astype(bool) == hot] & ~np.uint64(1))
    least, text, first, strings = anchored_runs(data, ends, length)
    if not len(wanted):
        keep = np.zeros(0, np.int64)
    else:
        keep = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, least), len(wanted) - 1)] == least)
    begin = np.concatenate(([0], ends[:-1]))
    text, first = text[keep], first[keep]
    return data, least[keep], _longs(batch.column("ids")[k])[text], text, first, first - begin[text], strings[keep]


def _squeezed(values: np.ndarray) -> bytes:
    """Segments of a pack overlap, and their places rise, so both shrink well before they are shuffled."""
    return zstandard.compress(values.tobytes(), 3)


def _unsqueezed(value: pa.Scalar) -> bytes:
    return zstandard.decompress(value.as_buffer())


def _flat(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, ``counts`` of them."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))


def first_holders(segments: list[bytes], first_doc: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """For distinct segments with the least doc_id that holds each: the least doc_id for each of their strings, and where each segment's begin."""
    sizes = np.array([len(s) for s in segments], np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    # bytes count from 2, segments end in 1, and 0 ends the text
    text = np.ones(int((sizes + 1).sum()) + 1, np.int16)
    text[_flat(begins, sizes)] = np.frombuffer(b"".join(segments), np.uint8).astype(np.int16) + 2
    text[-1] = 0
    array = suffixes.suffix_array(text, 258)
    shared = suffixes.permuted_common_prefixes(text, array)[array] >= length
    owner = np.full(len(text), np.iinfo(np.int64).max)
    strings = sizes - length + 1
    at = _flat(begins, strings)
    owner[at] = np.repeat(first_doc, strings)
    groups = np.flatnonzero(~shared)
    least = np.minimum.reduceat(owner[array], groups)
    holder = np.empty(len(text), np.int64)
    holder[array] = np.repeat(least, np.diff(np.append(groups, len(array))))
    return holder[at], np.cumsum(strings) - strings


def with_repeats(segments: list[bytes], length: int) -> np.ndarray:
    """Which segments have a string whose hash another place in them has too; the others share their anchor and no string."""
    sizes = np.array([len(s) for s in segments], np.int64)
    begins = np.cumsum(sizes) - sizes
    strings = sizes - length + 1
    hashes = window_hashes(np.frombuffer(b"".join(segments), np.uint8), length)[_flat(begins, strings)]
    order = np.argsort(hashes)
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = hashes[order[1:]] == hashes[order[:-1]]
    met = np.zeros(len(order), bool)
    met[order] = same[1:] | same[:-1]
    return np.logical_or.reduceat(met, np.cumsum(strings) - strings)


def _shard(length: int):
    def found(table: pa.Table) -> pa.Table:
        known: dict[bytes, int] = {}
        own, places, packs = [], [], []
        for row in range(table.num_rows):
            raw = _unsqueezed(table.column("bytes")[row])
            places.append(np.frombuffer(_unsqueezed(table.column("places")[row]), "<i8").reshape(4, -1))
            ends = np.cumsum(places[-1][0]).tolist()
            own += [known.setdefault(raw[a:b], len(known)) for a, b in zip([0, *ends], ends, strict=False)]
            packs.append(np.full(len(ends), table.column("pack")[row].as_py(), np.int64))
        segment, pack = np.array(own), np.concatenate(packs)
        _, doc, text, start = np.concatenate(places, axis=1)
        first_doc, last_doc = np.full(len(known), np.iinfo(np.int64).max), np.full(len(known), np.iinfo(np.int64).min)
        np.minimum.at(first_doc, segment, doc)
        np.maximum.at(last_doc, segment, doc)
        able = (first_doc < last_doc) | with_repeats(list(known), length)
        kept = np.flatnonzero(able)
        if not len(kept):
            return span_rows(*np.zeros((4, 0), np.int64))
        own = able[segment]
        segment, pack, doc, text, start = (np.cumsum(able) - 1)[segment[own]], pack[own], doc[own], text[own], start[own]
        holder, begins = first_holders(list(itertools.compress(known, able)), first_doc[kept], length)
        strings = np.diff(np.append(begins, len(holder)))[segment]
        place = _flat(np.zeros(len(segment), np.int64), strings)
        repeated = holder[np.repeat(begins[segment], strings) + place] < np.repeat(doc, strings)
        row = np.repeat(np.arange(len(segment)), strings)
        edge = np.ones(len(row) + 1, bool)
        edge[1:-1] = (row[1:] != row[:-1]) | (repeated[1:] != repeated[:-1])
        cuts = np.flatnonzero(edge)
        a, b = cuts[:-1][repeated[cuts[:-1]]], cuts[1:][repeated[cuts[:-1]]] - 1
        k = row[a]
        return span_rows(pack[k], text[k], start[k] + place[a], start[k] + place[b] + length)

    return found


def span_rows(pack: np.ndarray, text: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Table:
    """A row per pack: its spans as triples (text, start, end)."""
    order = np.argsort(pack, kind="stable")
    triples = np.stack((text, start, end), axis=1).astype("<i8")[order] if len(pack) else np.zeros((0, 3), "<i8")
    cuts = np.flatnonzero(np.diff(pack[order])) + 1
    parts = np.split(triples, cuts) if len(pack) else []
    numbers = pack[order][np.concatenate(([0], cuts)).astype(np.int64)] if len(pack) else np.zeros(0, np.int64)
    return pa.table({"pack": pa.array(numbers, pa.int64()), "spans": _binaries(parts)})


def _spans(packs: DataFrame, hits: DataFrame, total: int, length: int) -> DataFrame:
    """Repeated stretches of the texts, several rows per pack."""
    sizes = hits.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("hot"), F.lit(0)).alias("hot")).head()
    shards = max(1, -(-int(sizes["n"]) * (length + (length - ANCHOR) // 2) // SHARD_BYTES))
    met = packs.join(_by_pack(hits, "anchors", "hits", total), "pack")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                data, least, doc, text, first, start, strings = _chosen(batch, k, length, hot=False)
                home = (W.mixed(least) % np.uint64(shards)).astype(np.int64)
                order = np.argsort(home, kind="stable")
                cuts = np.flatnonzero(np.diff(home[order])) + 1
                parts = np.split(order, cuts) if len(order) else []
                size = strings + length - 1
                places = np.stack((size, doc, text, start)).astype("<i8")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(home[p[0]]) for p in parts], pa.int64()),
                        pa.array([batch.column("pack")[k].as_py()] * len(parts), pa.int64()),
                        pa.array([_squeezed(data[_flat(first[p], size[p])]) for p in parts], pa.binary()),
                        pa.array([_squeezed(places[:, p]) for p in parts], pa.binary()),
                    ],
                    names=["shard", "pack", "bytes", "places"],
                )

    found = met.mapInArrow(segments, SEGMENTS).groupBy("shard").applyInArrow(_shard(length), SPANS)
    return found.unionByName(_hot_spans(met, length)) if sizes["hot"] else found


def _hot_spans(met: DataFrame, length: int) -> DataFrame:
    """The same for strings with hot anchors: each by its own hash to the least document that holds it, and back."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                data, _, doc, text, first, start, strings = _chosen(batch, k, length, hot=True)
                h1, h2 = (window_hashes(data, length, base).view(np.int64)[_flat(first, strings)] for base in _BASES)
                columns = [h1, h2, np.repeat(doc, strings), np.full(len(h1), batch.column("pack")[k].as_py())]
                columns = [pa.array(c, pa.int64()) for c in columns]
                columns += [pa.array(np.repeat(text, strings), pa.int32()), pa.array(_flat(start, strings), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["h1", "h2", "doc", "pack", "text", "start"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pack, text, start = (batch.column(c).to_numpy() for c in ("pack", "text", "start"))
            yield from span_rows(pack, text, start, start + length).to_batches()

    rows = met.mapInArrow(windows, WINDOWS)
    first = rows.groupBy(F.col("h1").alias("a"), F.col("h2").alias("b")).agg(F.min("doc").alias("first"))
    repeated = rows.join(first, (F.col("h1") == F.col("a")) & (F.col("h2") == F.col("b"))).where("first < doc")
    return repeated.select("pack", "text", "start").mapInArrow(packed, SPANS)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text of a pack, and the maximal removed spans."""
    for batch in batches:
        for k in range(batch.num_rows):
            data, ends = np.frombuffer(batch.column("data")[k].as_buffer(), np.uint8), _longs(batch.column("ends")[k])
            begins = np.concatenate(([0], ends[:-1]))
            found = batch.column("spans")[k].values
            triples = [_longs(s).reshape(-1, 3) for s in found] if found is not None else []
            text, start, end = np.concatenate(triples).T if triples else np.zeros((3, 0), np.int64)
            cover = np.bincount(begins[text] + start, minlength=len(data) + 1) - np.bincount(begins[text] + end, minlength=len(data) + 1)
            gone = np.cumsum(cover)[:-1] > 0
            edge = np.zeros(len(data) + 1, bool)
            edge[1:-1] = gone[1:] != gone[:-1]
            edge[begins] = edge[-1] = True
            cuts = np.flatnonzero(edge)
            a, b = cuts[:-1][gone[cuts[:-1]]], cuts[1:][gone[cuts[:-1]]]
            own = np.searchsorted(ends, a, "right")
            spans = pa.StructArray.from_arrays([pa.array(a - begins[own]), pa.array(b - begins[own])], names=["start", "end"])
            bounds = np.searchsorted(own, np.arange(len(ends) + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(_longs(batch.column("ids")[k])),
                    pa.array(ends - begins),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), spans),
                    _binaries([data[x:y][~gone[x:y]] for x, y in zip(begins, ends, strict=True)]),
                ],
                names=["doc_id", "n_bytes", "spans", "kept"],
            )


def without_repeats(docs: DataFrame, length: int = LENGTH, hot_docs: int = HOT_DOCS) -> DataFrame:
    """doc_id, n_bytes, spans (the maximal removed stretches of bytes, in order) and kept (the bytes left) of every document."""
    if length <= ANCHOR:
        raise ValueError(f"strings must be longer than {ANCHOR} bytes")
    text = F.coalesce("text", F.lit(""))
    key = F.unhex(F.substring(F.sha2(text.cast("binary"), 256), 1, 32))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"), key.alias("key"))
    able = F.col("doc_id").isNotNull() & (F.col("n_bytes") >= length)
    spark, store = docs.sparkSession, work_folder(docs.sparkSession, "copies")
    long = rows.where(able)
    total = int(long.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("bytes")).head()["bytes"])
    # stored, as it is counted and joined twice; sent to all tasks only where the count proves it small
    long.groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("key", "first").write.parquet(store)
    marked = rows.join(broadcast_if_small(spark.read.schema("key binary, first long").parquet(store)), "key", "left")
    whole = able & F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False))
    packs = _packs(marked.where(able & ~whole).select("doc_id", "text"), total)
    hits = _hits(packs, total, length, hot_docs)
    spans = _by_pack(_spans(packs, hits, total, length), "spans", "spans", total)
    cut = packs.join(spans, "pack", "left").mapInArrow(_cut, KEPT)
    span: Column = F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end"))
    plain = marked.where(~able | whole).select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.array(span)).otherwise(F.array().cast("array<struct<start:long,end:long>>")).alias("spans"),
        F.when(whole, F.lit("")).otherwise(F.col("text")).cast("binary").alias("kept"),
    )
    return cut.unionByName(plain)

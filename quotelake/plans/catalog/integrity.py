"""Content hashes, manifests, log rules and custody."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.operators import integrity, snapshots
from quotelake.plans import testbed as tb
from quotelake.plans.bronze import SNAPSHOTS, land_snapshot, land_snapshots
from quotelake.plans.catalog.registry import query
from quotelake.session import work_folder
from quotelake.sources import control
from quotelake.sources.files import read_bronze
from quotelake.sources.paths import listing, remove

_ROW = "md5(CAST(to_json({{'c_custkey': c_custkey, 'c_name': {name}, 'c_mktsegment': c_mktsegment}}) AS VARCHAR))"
_PARTS = " || ':' || ".join(
    f"CAST(sum(CAST(('0x' || substr(d, {1 + 8 * i}, 8)) AS HUGEINT)) AS VARCHAR)" for i in range(4)
)


def _digests(name: str, where: str = "TRUE") -> str:
    return f"""SELECT c_mktsegment, md5(CAST(count(*) AS VARCHAR) || ':' || {_PARTS}) AS content_hash
        FROM (SELECT c_mktsegment, {_ROW.format(name=name)} AS d FROM customer WHERE {where}) GROUP BY 1"""


_CHANGED_NAME = "CASE WHEN c_mktsegment = 'MACHINERY' AND c_custkey = (SELECT max(c_custkey) FROM customer WHERE c_mktsegment = 'MACHINERY') THEN c_name || '*' ELSE c_name END"


def _snapshot(spark, folder):
    return snapshots.tag_extraction(tb.table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment"))


def _second_run(spark, folder):
    """One customer of one segment changed."""
    first = _snapshot(spark, folder)
    last = first.where(F.col("c_mktsegment") == "MACHINERY").agg(F.max("c_custkey")).scalar()
    changed = (F.col("c_mktsegment") == "MACHINERY") & (F.col("c_custkey") == last)
    return first.withColumn("c_name", F.when(changed, F.concat("c_name", F.lit("*"))).otherwise(F.col("c_name")))


_KEY = ["c_mktsegment"]


@query(_digests("c_name"))
def snapshot_hash(spark, folder):
    return snapshots.content_digests(_snapshot(spark, folder), _KEY)


@query(f"""SELECT n.c_mktsegment, n.content_hash, CASE WHEN o.content_hash IS NULL THEN 'new'
    WHEN o.content_hash = n.content_hash THEN 'unchanged' ELSE 'changed' END AS status
    FROM ({_digests(_CHANGED_NAME)}) n LEFT JOIN ({_digests('c_name', "c_mktsegment <> 'HOUSEHOLD'")}) o
    ON n.c_mktsegment = o.c_mktsegment""")
def changed_snapshots(spark, folder):
    """One segment new, one changed, the others unchanged."""
    first = _snapshot(spark, folder).where(F.col("c_mktsegment") != "HOUSEHOLD")
    before = snapshots.content_digests(first, _KEY)
    return snapshots.compare_digests(snapshots.content_digests(_second_run(spark, folder), _KEY), before, _KEY)


@query("""SELECT c_mktsegment, CAST(count(*) * CASE c_mktsegment WHEN 'MACHINERY' THEN 2 ELSE 1 END AS BIGINT) AS rows
    FROM customer GROUP BY c_mktsegment""")
def snapshots_landed_when_changed(spark, folder):
    """Two landing runs; the second writes only the changed segment."""
    root = work_folder(spark, "bronze")
    for run in (_snapshot, _second_run):
        land_snapshot(run(spark, folder).drop(snapshots.EXTRACTED), root, "market", "segment", "c_mktsegment")
    return read_bronze(spark, root, "market", "segment").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("rows"))


# kind: table, the column that is its key, and which keys change before the second run
_KINDS = {
    "info": ("nation", "n_name", "n_name < 'C'", "n_regionkey"),
    "status": ("region", "r_name", "r_name = 'ASIA'", "r_regionkey"),
    "summary": ("customer", "c_mktsegment", "c_mktsegment = 'MACHINERY'", "c_custkey"),
    "industry": ("part", "p_type", "p_type LIKE 'SMALL%'", "p_partkey"),
    "calendar": ("orders", "o_orderstatus", "o_orderstatus = 'F'", "o_orderkey"),
    "funds": ("events", "event_type", "event_type < 'd'", "event_id"),
}


@query(" UNION ALL ".join(
    f"SELECT '{kind}' AS kind, {key} AS key, CAST(count(*) * CASE WHEN {changed} THEN 2 ELSE 1 END AS BIGINT) AS rows FROM {table} WHERE {key} IS NOT NULL GROUP BY {key}"
    for kind, (table, key, changed, _) in _KINDS.items()))
def snapshot_kinds_landed(spark, folder):
    """Two landing runs of several kinds at once; the second writes the changed keys only."""
    root = work_folder(spark, "bronze")
    for step in (0, 1):
        land_snapshots({
            kind: tb.table(spark, folder, table).where(f"{key} IS NOT NULL").selectExpr(f"{key} AS {SNAPSHOTS[kind][1]}", f"{value} + CASE WHEN {changed} THEN {step} ELSE 0 END AS content")
            for kind, (table, key, changed, value) in _KINDS.items()
        }, root)
    counts = [
        read_bronze(spark, root, SNAPSHOTS[kind][0], kind).groupBy(F.col(SNAPSHOTS[kind][1]).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(kind).alias("kind"), "key", "rows")
        for kind in _KINDS
    ]
    return reduce(DataFrame.unionAll, counts)


@query()
def manifest_files(spark, folder):
    """Path and sha256 of every file of the given tables."""
    return integrity.file_hashes(spark, folder)


@query()
def manifest_build(spark, folder):
    """Composite hash and number of files."""
    return integrity.manifest_hash(integrity.file_hashes(spark, folder))


@query()
def manifest_verify(spark, folder):
    """A recorded list with an altered and an extra entry, against the files."""
    found = integrity.file_hashes(spark, folder).select("path", "sha256")
    altered = F.when(F.col("path").endswith("orders.parquet"), F.reverse("sha256")).otherwise(F.col("sha256"))
    recorded = found.select("path", altered.alias("sha256")).where(~F.col("path").endswith("part.parquet"))
    gone = found.where(F.col("path").endswith("nation.parquet")).withColumn("path", F.concat(F.lit("gone/"), "path"))
    return integrity.compare_files(recorded.unionAll(gone), found)


_TEXT = "string_agg(c_name, ',' ORDER BY c_name) || chr(10)"
_FILES = f"SELECT c_mktsegment AS path, sha256({_TEXT}) AS sha256, CAST(strlen({_TEXT}) AS BIGINT) AS length FROM customer GROUP BY 1"
_HEAD = f"""SELECT sha256(string_agg(line, chr(10) ORDER BY line)) AS manifest_hash, CAST(sum(n) AS BIGINT) AS file_count FROM (
    SELECT bucket || ':' || sha256(string_agg(line, chr(10) ORDER BY line)) AS line, count(*) AS n
    FROM (SELECT substr(md5(path), 1, 4) AS bucket, path || ':' || sha256 AS line FROM ({_FILES})) GROUP BY bucket)"""


def _text_files(spark, folder, name="c_name"):
    """The customers of each segment as one text file; paths cut down to the segment."""
    root = work_folder(spark, "texts")
    names = F.array_join(F.sort_array(F.collect_list(name)), ",").alias("value")
    tb.table(spark, folder, "customer").groupBy(F.col("c_mktsegment").alias("key")).agg(names).write.partitionBy("key").text(root)
    return integrity.file_hashes(spark, root, "*.txt").withColumn("path", F.regexp_extract("path", "key=([^/]+)/", 1))


@query(_FILES)
def manifest_of_texts(spark, folder):
    return _text_files(spark, folder)


@query(_HEAD)
def manifest_hash_of_texts(spark, folder):
    return integrity.manifest_hash(_text_files(spark, folder))


@query("""SELECT c_mktsegment AS path, CASE c_mktsegment WHEN 'MACHINERY' THEN 'tampered' WHEN 'BUILDING' THEN 'unlisted' ELSE 'ok' END AS status
    FROM customer GROUP BY 1 UNION ALL SELECT 'gone', 'missing'""")
def manifest_check_of_texts(spark, folder):
    """One segment's file changed after it was listed, one was never listed, one listed file is gone."""
    recorded = _text_files(spark, folder).where("path <> 'BUILDING'").select("path", "sha256")
    gone = recorded.limit(1).withColumn("path", F.lit("gone"))
    changed = F.when(F.col("c_mktsegment") == "MACHINERY", F.concat("c_name", F.lit("*"))).otherwise(F.col("c_name"))
    return integrity.compare_files(recorded.unionAll(gone), _text_files(spark, folder, changed))


@query()
def custody_append(spark, folder):
    """Manifest, log scan, custody record; the entry as stored."""
    root = work_folder(spark, "control")
    control.build_manifest(spark, folder, root, "bronze")
    control.record_custody(spark, root, "bronze", _log(spark, folder).select("line"))
    return control.custody_tail(spark, root, 5).select("stage", "file_count", "log_analysis", "issue_count", "verdict")


_MARK = """CASE WHEN turn % 5 = 0 THEN 'wrote 0 Rows ' WHEN turn % 5 = 1 THEN 'wrote 250 rows '
    WHEN conv_id % 17 = 0 THEN 'Fatal: ' WHEN conv_id % 19 = 0 THEN 'ValueException: ' ELSE '' END"""
_LINES = f"""SELECT conv_id, turn, unnest(string_split(replace(replace(t, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10)))
    AS line FROM (SELECT conv_id, turn, {_MARK} || text AS t FROM conversations)"""
_HIT = """(lower(line) LIKE '%fatal%' OR lower(line) LIKE '%critical%' OR lower(line) LIKE '%traceback%'
    OR lower(line) LIKE '%exception:%' OR lower(line) LIKE '%permissionerror%' OR lower(line) LIKE '%connectionrefused%'
    OR regexp_matches(line, '(?i)\\b0 rows\\b'))"""


def _log(spark, folder):
    """Conversation texts as logs, with severity words in front of some."""
    mark = (
        F.when(F.col("turn") % 5 == 0, "wrote 0 Rows ")
        .when(F.col("turn") % 5 == 1, "wrote 250 rows ")
        .when(F.col("conv_id") % 17 == 0, "Fatal: ")
        .when(F.col("conv_id") % 19 == 0, "ValueException: ")
        .otherwise("")
    )
    texts = tb.table(spark, folder, "conversations")
    return integrity.text_lines(texts.select("conv_id", "turn", F.concat(mark, "text").alias("text")))


@query(f"SELECT conv_id, turn, trim(line) AS line FROM ({_LINES}) WHERE {_HIT}")
def log_scan(spark, folder):
    return integrity.log_issues(_log(spark, folder))


@query(f"""SELECT 'bronze' AS stage, (SELECT count(DISTINCT c_mktsegment) FROM customer) AS file_count,
    CASE WHEN issues > 0 THEN 'CRITICAL' ELSE 'OK' END AS log_analysis, issues AS issue_count,
    CASE WHEN issues > 0 THEN 'FAILED' ELSE 'PASSED' END AS verdict
    FROM (SELECT count(*) FILTER (WHERE {_HIT}) AS issues FROM ({_LINES}))""")
def custody_of_segments(spark, folder):
    """A file per segment, their manifest, the log scan and the custody record; the entry as stored."""
    root, data = work_folder(spark, "control"), work_folder(spark, "segments")
    tb.table(spark, folder, "customer").repartition("c_mktsegment").write.partitionBy("c_mktsegment").parquet(data)
    control.build_manifest(spark, data, root, "bronze")
    control.record_custody(spark, root, "bronze", _log(spark, folder).select("line"))
    return control.custody_tail(spark, root, 5).select("stage", "file_count", "log_analysis", "issue_count", "verdict")


@query(f"""SELECT CASE WHEN issues > 0 THEN 'stopped' ELSE 'passed' END AS verdict FROM (SELECT count(*) FILTER (WHERE {_HIT}) AS issues FROM ({_LINES}))
    UNION ALL SELECT 'passed'""")
def gate_verdicts(spark, folder):
    """The gate with the log as it is, and with the log's critical lines taken out."""
    root, data = work_folder(spark, "control"), work_folder(spark, "segments")
    tb.table(spark, folder, "customer").write.parquet(data)
    control.build_manifest(spark, data, root, "bronze")
    log, verdicts = _log(spark, folder).select("line"), []
    for lines in (log, log.where(~integrity.is_critical(F.col("line")))):
        try:
            control.gate(spark, root, "bronze", lines)
            verdicts.append("passed")
        except integrity.IntegrityError:
            verdicts.append("stopped")
    return spark.createDataFrame([(v,) for v in verdicts], "verdict string")


@query(f"""SELECT CASE WHEN count(*) FILTER (WHERE {_HIT}) > 0 THEN 'CRITICAL' ELSE 'OK' END AS status,
    count(*) FILTER (WHERE {_HIT}) AS issues FROM ({_LINES})""")
def log_status(spark, folder):
    return integrity.log_status(_log(spark, folder))


_CHANGED = "CASE WHEN c_mktsegment = 'MACHINERY' THEN c_name || '*' ELSE c_name END"
_LATER = f"""SELECT c_mktsegment AS path, sha256(string_agg(n, ',' ORDER BY n) || chr(10)) AS sha256
    FROM (SELECT c_mktsegment, {_CHANGED} AS n FROM customer WHERE c_mktsegment <> 'HOUSEHOLD') GROUP BY 1"""


def _write_segment(spark, folder, root, segments, name="c_name"):
    names = F.array_join(F.sort_array(F.collect_list(name)), ",").alias("value")
    rows = tb.table(spark, folder, "customer").where(segments)
    rows.groupBy(F.col("c_mktsegment").alias("key")).agg(names).write.mode("append").partitionBy("key").text(root)


@query(f"""SELECT 'first' AS build, path, sha256, CAST((SELECT count(DISTINCT c_mktsegment) - 1 FROM customer) AS BIGINT) AS hashed
    FROM ({_FILES}) WHERE path <> 'BUILDING'
    UNION ALL SELECT 'second', path, sha256, 2 FROM ({_LATER})
    UNION ALL SELECT 'third', path, sha256, 0 FROM ({_LATER})""")
def manifest_follows_changes(spark, folder):
    """Three builds: all files but one; then one file more, one changed and one gone; then nothing new. Only what changed is hashed."""
    data, root = work_folder(spark, "texts"), work_folder(spark, "control")
    key = F.col("c_mktsegment")
    _write_segment(spark, folder, data, key != "BUILDING")
    builds = []
    for name in ("first", "second", "third"):
        if name == "second":
            _write_segment(spark, folder, data, key == "BUILDING")
            for r in listing(spark, data, "*.txt").collect():
                if "key=MACHINERY" in r["path"] or "key=HOUSEHOLD" in r["path"]:
                    remove(spark, f"{data}/{r['path']}")
            _write_segment(spark, folder, data, key == "MACHINERY", F.concat("c_name", F.lit("*")))
        control.build_manifest(spark, data, root, "bronze", "*.txt")
        head, files = control.load_manifest(spark, root, "bronze")
        control.verify_manifest(spark, root, "bronze", pattern="*.txt")
        segment = F.regexp_extract("path", "key=([^/]+)/", 1).alias("path")
        builds.append(files.select(F.lit(name).alias("build"), segment, "sha256", F.lit(head["hashed"]).cast("bigint").alias("hashed")))
    return builds[0].unionAll(builds[1]).unionAll(builds[2])

"""The queries over the operators of this subpackage, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.llm import hmm, html_graph, isolation, jaccard, mixing, mtree, packing, pii, ranked, repeats, resampling, rule_ensemble, sharding
from quotelake.llm.samples import bounded_batches
from quotelake.session import prepare, work_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bounded_batches(prepare(spark)).read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op2_fair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.schedule(docs).select("doc_id", "size", "source_size", "target", "taken", "copies", "finish")


@query
def op5_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    stored = sharding.write_shards(docs, work_folder(spark, "sharded"), 24)
    return stored.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op8_isolation_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = isolation.judge(docs, isolation.fit(docs, table(spark, sf_dir, "labels")))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly"
    )


@query
def op4_least_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(packing.pieces(table(spark, sf_dir, "documents")))


@query
def op1_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))


@query
def op10_hidden_markov_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.scored(table(spark, sf_dir, "documents"))


@query
def op3_size_aware_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.grouped(table(spark, sf_dir, "documents"))


@query
def op6_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    scored = rule_ensemble.scored(docs, rule_ensemble.fit(docs, labels.where(third != 1)))
    return scored.select(
        "doc_id",
        F.coalesce(third == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op7_mtree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = mtree.prepared(table(spark, sf_dir, "embeddings"))
    return mtree.top_k(vectors, vectors.where("vec_id % 20 = 0"), 20)


ORACLES["op7_mtree_search"] = """
with v as (
  select vec_id, [floor(64 * x::double)::bigint for x in embedding] as v
  from embeddings
  where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0 and len(embedding) > 0
), s as (
  select q.vec_id as query_id, c.vec_id as vec_id, list_sum([q.v[i] * c.v[i] for i in range(1, len(q.v) + 1)])::bigint as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0
), r as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s
)
select query_id, rank::int as rank, vec_id, score from r where rank <= 20
"""


@query
def op9_dom_tree_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_graph.extract(pages, html_graph.fit(pages))


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = f"regexp_extract_all({_LOWER}, '" + r"[^\x{0}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+')"
# CRC-32 of a word: a table made of the polynomial, then one step per byte.
_CRC = """crc_table as (
  select list(c order by i) as t from (
    select i, list_reduce([i::bigint, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: case when c % 2 = 1 then xor(3988292384::bigint, c >> 1) else c >> 1 end) as c
    from range(256) r(i))
), hashed as (
  select w, xor(list_reduce(list_concat([4294967295::bigint], [('0x' || substr(hex(encode(w)), 2 * k + 1, 2))::bigint for k in range(octet_length(encode(w)))]),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 as bucket
  from (select distinct w from features union select distinct w from wanted), crc_table
)"""


@query
def op11_induced_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = repeats.without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["start"])
    return made.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


ORACLES["op11_induced_suffixes"] = """
with docs as (select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents),
strings as (select r, doc_id, k, substr(h, 2 * k + 1, 100) as s from (select *, unnest(range(greatest(length(h) // 2 - 49, 0))) as k from docs)),
firsts as (select s, min(doc_id) as first from strings group by s),
starts as (select r, k from strings join firsts using (s) where first < doc_id),
spans as (
  select r, min(k) as a, max(k) + 50 as b from (
    select r, k, sum(new) over (partition by r order by k) as g
    from (select r, k, (k - coalesce(lag(k) over (partition by r order by k), -51) > 50)::int as new from starts))
  group by r, g
), parts as (
  select r, a, b, substr(h, 2 * coalesce(lag(b) over (partition by r order by a), 0) + 1, 2 * (a - coalesce(lag(b) over (partition by r order by a), 0))) as kept
  from spans join docs using (r)
), whole as (select r, count(*) as n_spans, sum(b - a)::bigint as n_removed, max(b) as last, string_agg(kept, '' order by a) as kept from parts group by r)
select doc_id, (length(h) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
  sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) as kept_sha256
from docs left join whole using (r)
"""


@query
def op12_geometric_blocking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op12_geometric_blocking"] = f"""
with docs as (
  select row_number() over () as r, doc_id, {_TERMS} as terms from documents
), held as (
  select r, t, count(*) as tf from (select r, unnest(terms) as t from docs) group by r, t
), asked as (
  select item_id, t, count(*) as times from (select item_id, unnest({_TERMS}) as t from benchmark) group by item_id, t
), whole as (select count(*) as n, sum(len(terms))::bigint as l from docs where len(terms) > 0),
weights as (
  select t, floor(1000 * ln((2 * (select n from whole) + 2)::double / (2 * count(*) + 1)))::bigint as w from held group by t
), scored as (
  select item_id, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * len(terms)::bigint * whole.n) // whole.l)))))::bigint as score
  from asked join held using (t) join weights using (t) join docs using (r) cross join whole group by item_id, r
)
select item_id, row_number() over (partition by item_id order by score desc, doc_id) as rank, doc_id, score from scored join docs using (r) where score > 0
qualify rank <= 20
"""


@query
def op13_length_bucketed_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op13_length_bucketed_resampling"] = f"""
with docs as (
  select row_number() over () as r, doc_id, coalesce({_TERMS}, []) as words from documents
), features as (select r, unnest(words) as w from docs),
wanted as (
  select unnest({_TERMS}) as w from benchmark
), {_CRC}, s as (select bucket, count(*) as n from features join hashed using (w) group by 1),
t as (select bucket, count(*) as n from wanted join hashed using (w) group by 1),
gain as (
  select b as bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::double * ((select count(*) from features) + 10000)
    / ((coalesce(s.n, 0) + 1)::double * ((select count(*) from wanted) + 10000))))::bigint as g
  from range(10000) x(b) left join s on s.bucket = b left join t on t.bucket = b
), weights as (
  select r, count(*) as n, floor(sum(g)::double / count(*))::bigint as w from features join hashed using (w) join gain using (bucket) group by 1
), scored as (
  select r, doc_id, len(words)::bigint as n_features, coalesce(weights.w, 0) as weight, len(words) >= 20 as eligible,
    coalesce(weights.w, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id::varchar), 1, 8))::bigint + 0.5::double) / 4294967296::double)))::bigint as score
  from docs left join weights using (r)
), ranked as (
  select *, row_number() over (partition by eligible order by score desc, doc_id) as k, sum(eligible::int) over () as n from scored
)
select doc_id, n_features, weight, score, case when eligible and k <= 10 * n // 100 then k end::bigint as rank from ranked
"""

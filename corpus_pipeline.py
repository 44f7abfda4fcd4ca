"""Documents to training sequences: quality rules, near copies, personal data, mixing, packing.

Each stage works on all documents that the one before has kept, and its decisions take effect: rejected documents and all but one of each
group of near copies go, personal data is replaced by its kind, the mixture repeats and leaves out documents as its targets
say (a copy is a row), and what it gives is packed. All but the last stage return the columns of documents. Each stage is written as Parquet to the shared
folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quotelake.llm import isolation, jaccard, mixing, packing, pii
from quotelake.llm.samples import bounded_batches
from quotelake.session import prepare, work_folder

# Near copies share this much of their word shingles. The query op3 has its own contract: 4 words and 85%.
SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = bounded_batches(prepare(spark)).read.parquet(f"{sf_dir}/labels.parquet")
    return isolation.kept_documents(docs, isolation.fit(docs, labels))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(prepare(spark))
    return jaccard.first_of_groups(docs, n=SHINGLE_WORDS, part=SIMILAR_PERCENT, whole=100)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(prepare(spark))
    return pii.masked(docs, pii.fit(docs))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(prepare(spark))
    return mixing.mixed(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(prepare(spark))
    return packing.packed(packing.pieces(docs))


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("personal_data", personal_data),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

# The anomaly scores, the random field and the tokenizer are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bounded_batches(prepare(spark)).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        folder = work_folder(spark, name)
        made.write.parquet(folder)
        docs = spark.read.schema(made.schema).parquet(folder)
    return docs

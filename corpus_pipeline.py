"""The corpus pipeline: stages over the documents table, each written as Parquet and read again as the next one's input.

1. ``toxicity`` drops the documents that the string-kernel machine, trained on the labels, calls toxic.
2. ``near_duplicates`` keeps one document of each group that links of fingerprints connect (SimHash of three-word shingles, at
   most three bits apart), that with the smallest doc_id.
3. ``long_passages`` cuts passages of 50 bytes or more that start in an earlier document.
4. ``mixture`` repeats or leaves out documents so that each source comes near its target.
5. ``packing`` cuts and packs what is left into sequences of 4096 tokens.

A stage works on all that the one before kept. Null texts are empty texts, null ids and sources are values of their own,
an empty table runs through to an empty result; see the operators for the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import llm
from tidemark.llm import mixing, packing_histogram, run_index, simhash_trie
from tidemark.llm import toxicity as kernel
from tidemark.plans.staging import stage
from tidemark.queries.registry import Query
from tidemark.session import prepared

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = prepared(spark).read.parquet(f"{sf_dir}/labels.parquet")
    model = kernel.fit(kernel.training_texts(docs, labels))
    return kernel.scored(docs.select(*COLUMNS), model, *COLUMNS).filter("score < 0.5").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_trie.one_of_each(docs.select(*COLUMNS), shingle=3)


def long_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = run_index.deduplicated(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs.select(*COLUMNS), mixing.words())


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing_histogram.pack(docs, packing_histogram.tokenizer_definition())


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("long_passages", long_passages),
    ("mixture", mixture),
    ("packing", packing),
]
#: Kernel machines, fingerprints and tokenizers have no SQL; the tests compare stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


def all_queries() -> dict[str, Query]:
    return llm.all_queries() | {"pipeline": Query(run, ORACLE_SQL)}

"""Corpus jobs: shard plans, splits, budgets, batches, isolation and checks before publishing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.text import PERSONAL_DATA, personal_data_hits
from tidemark.functions.tokens import CHAR_BUDGET, DOC_CAP, DOCS_PER_BATCH, capped, pretokens
from tidemark.plans.ordered import keep_until, number, order_rows

# The number of the last shard, which is the pinned validation shard, and shard file names.
LAST_SHARD = 6_542
SHARD_FILE = "shard_%05d.parquet"

ORDER = ("shard", "doc_id")


def planned_shards(spark: SparkSession, n: int, pinned: Column | int = LAST_SHARD, last: int = LAST_SHARD) -> DataFrame:
    """Shard ids to hold: the first ``n`` (-1: all) and the pinned one, each once."""
    first = spark.range(last if n == -1 else min(n, last)).select(F.col("id").cast("int").alias("shard"))
    one = spark.range(1).select((F.lit(pinned) if isinstance(pinned, int) else pinned).cast("int").alias("shard"))
    return first.union(one).distinct().withColumn("file_name", F.format_string(SHARD_FILE, F.col("shard")))


def present_shards(corpus: DataFrame) -> DataFrame:
    return corpus.groupBy("shard").agg(F.count(F.lit(1)).alias("n_docs"))


def missing_shards(planned: DataFrame, present: DataFrame) -> DataFrame:
    return planned.join(present, "shard", "left_anti")


def manifest(planned: DataFrame, present: DataFrame, pinned: Column) -> DataFrame:
    rows = planned.join(present, "shard", "left")
    return rows.select(
        "shard",
        "file_name",
        (F.col("shard") == pinned).alias("is_val"),
        F.col("n_docs").isNotNull().alias("present"),
        F.coalesce("n_docs", F.lit(0)).cast("bigint").alias("n_docs"),
    )


def completeness(manifest: DataFrame) -> DataFrame:
    return manifest.agg(F.count_if("present").alias("ok"), F.count(F.lit(1)).alias("total"))


def with_split(corpus: DataFrame, pinned: Column) -> DataFrame:
    """``val`` for documents of the pinned shard, ``train`` for all others."""
    return corpus.withColumn("split", F.when(F.col("shard") == pinned, "val").otherwise("train"))


def last_shard(corpus: DataFrame) -> Column:
    """The highest shard number of a corpus, as a scalar subquery."""
    return corpus.agg(F.max("shard")).scalar()


def input_facts(corpus: DataFrame) -> DataFrame:
    """What a run needs at least: two shards, and documents in both splits."""
    shards = corpus.groupBy("shard", "split").agg(F.count(F.lit(1)).alias("n"))
    out = shards.agg(
        F.count(F.lit(1)).alias("n_shards"),
        F.sum(F.when(F.col("split") == "train", F.col("n"))).alias("n_train"),
        F.sum(F.when(F.col("split") == "val", F.col("n"))).alias("n_val"),
    )
    enough = (F.col("n_shards") >= 2) & (F.col("n_train") > 0) & (F.col("n_val") > 0)
    return out.withColumn("enough", F.coalesce(enough, F.lit(False)))


def require_input(corpus: DataFrame) -> DataFrame:
    """The corpus itself, or an error when there is too little of it."""
    facts = input_facts(corpus).head()
    if not facts.enough:
        raise ValueError(f"need two shards and documents in both splits, got {facts.asDict()}")
    return corpus


def first_documents(corpus: DataFrame, n: int, order: Sequence[str] = ORDER) -> DataFrame:
    """The first ``n`` documents in corpus order."""
    return keep_until(corpus, order, F.lit(1), n)


def character_budget(
    corpus: DataFrame, max_chars: int = CHAR_BUDGET, cap: int = DOC_CAP, order: Sequence[str] = ORDER
) -> DataFrame:
    """Documents in corpus order, cut at ``cap`` characters, until their lengths reach ``max_chars``."""
    rows = keep_until(corpus, order, F.length(capped(F.col("text"), cap)), max_chars)
    return rows.withColumn("text", capped(F.col("text"), cap))


def document_batches(
    corpus: DataFrame, size: int = DOCS_PER_BATCH, epochs: int = 1, within: Sequence[str] = ("shard",), key: str = "doc_id"
) -> DataFrame:
    """Batch the documents of each row group by their position in it; repeated once per epoch from 1.

    A corpus with ``row_group`` and ``group_row`` (``in_row_groups``) starts a new batch with each row group, and
    batches are numbered over the shard. One with a ``row_index`` only is one row group per shard. Otherwise
    documents are numbered by ``key``. Stored positions need no shuffle of the documents.
    """
    if "row_group" in corpus.columns:
        sizes = corpus.groupBy(*within, "row_group").agg((F.floor(F.max("group_row") / size) + 1).alias("_batches"))
        upto = Window.partitionBy(*within).orderBy("row_group").rowsBetween(Window.unboundedPreceding, -1)
        first = sizes.select(*within, "row_group", F.coalesce(F.sum("_batches").over(upto), F.lit(0)).alias("_first"))
        rows = corpus.join(first, [*within, "row_group"])  # one small row per row group
        rows = rows.withColumn("batch", (F.col("_first") + F.floor(F.col("group_row") / size)).cast("bigint")).drop("_first")
    else:
        numbered = "row_index" in corpus.columns
        rows = corpus if numbered else order_rows(corpus, within, [key]).scan(row_index=number(0)).rows()
        rows = rows.withColumn("batch", F.floor(F.col("row_index") / size).cast("bigint"))
    return rows.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))


def word_counts(texts: DataFrame, text: Column, by: Sequence[str] = ()) -> DataFrame:
    """Pre-tokens and how often each occurs; counted inside each input partition before the shuffle."""
    words = texts.select(*by, F.explode(pretokens(text)).alias("word"))
    return words.groupBy(*by, "word").agg(F.count(F.lit(1)).alias("cnt"))


def leaked_texts(corpus: DataFrame, max_broadcast: int = 200_000) -> DataFrame:
    """Texts found in both splits, with how many documents of each split hold them.

    The validation split is one shard. While it has few distinct texts, only documents that hold one of them are
    shuffled. Copies are counted per text inside each input partition, so a large group of copies stays one row.
    """
    hashed = corpus.select("split", F.sha2("text", 256).alias("text_hash"))
    val = hashed.filter(F.col("split") == "val").select("text_hash").distinct()
    if val.limit(max_broadcast + 1).count() <= max_broadcast:
        hashed = hashed.join(F.broadcast(val), "text_hash", "left_semi")
    texts = hashed.groupBy("text_hash").agg(
        F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "val").alias("n_val")
    )
    return texts.filter("n_train > 0 and n_val > 0")


def personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """Hits per kind of personal data, and whether a document has any."""
    hits = {f"n_{kind}": personal_data_hits(F.col(text), kind) for kind in PERSONAL_DATA}
    out = docs.withColumns(hits)
    return out.withColumn("flagged", sum((F.col(name) for name in hits), F.lit(0)) > 0)

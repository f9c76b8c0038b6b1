"""Importance resampling of documents towards a target distribution, on hashed n-gram features.

Words are runs of ASCII letters (A-Z lowered), digits and non-ASCII characters; features are runs of 1 to ``n`` words. A
feature falls into the bucket that the CRC-32 of its bytes names. The CRCs of a chunk of text are taken of its distinct
features only: those of equal length form the rows of a two-dimensional array of bytes, all CRCs of the array are updated
column by column, and the buckets are scattered back to the places where the features occur.

A bucket's gain is the log ratio of its smoothed frequencies in the target and in the corpus, a document's weight the sum
over its features, and its score the weight with Gumbel noise that its id sets. The documents with the highest scores among
those with enough words are drawn, without replacement.

The corpus is tokenised once; what the later steps read is a written table of bucket numbers. Bucket counts are summed before
they are shuffled, the driver sees one gain per bucket (a parameter), and ranks come from ranges of rows of about equal size
and the number of rows in the ranges before, so no task sorts the table.

Defined cases: a null or wordless text has no features and weight 0; a null id makes its noise from the seed alone and comes
last among equal scores; repeated rows and ids are scored and drawn one by one; an empty table gives no rows, an empty target
makes all counts of it 0; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.registry import query, table
from tidemark.plans.staging import stage

BUCKETS = 10_000
SEED = "2024"
DRAWN_PERCENT, LEAST_WORDS = 10, 20
#: Bytes of text whose features are hashed together.
CHUNK_BYTES = 4_000_000
#: Cells of one array of bytes.
CELLS = 2_000_000
#: Longer features are too few for columns to pay; they are hashed one by one, with the same result.
LONGEST_ROW = 512
ROWS_PER_RANGE = 1_000_000


# --------------------------------------------------------------------------- features and their CRCs


def _crc_table() -> np.ndarray:
    entries = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        entries = np.where(entries & 1, (entries >> 1) ^ np.uint32(0xEDB88320), entries >> 1)
    return entries


CRC_TABLE = _crc_table()
#: A-Z to lower case, all other ASCII but digits and lower-case letters to a space.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def crc32s(features: list[bytes]) -> np.ndarray:
    """The CRC-32 of each feature, by arrays of features of equal length."""
    lengths = np.fromiter(map(len, features), np.int64, len(features))
    crcs = np.zeros(len(features), np.uint32)
    for i in np.flatnonzero(lengths > LONGEST_ROW):
        crcs[i] = zlib.crc32(features[i])
    data = np.frombuffer(b"".join(features), np.uint8)
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths[(lengths > 0) & (lengths <= LONGEST_ROW)]):
        rows = np.flatnonzero(lengths == length)
        for part in np.array_split(rows, len(rows) * length // CELLS + 1):
            cells = data[starts[part][:, None] + np.arange(length)]
            crc = np.full(len(part), 0xFFFFFFFF, np.uint32)
            for column in cells.T:
                crc = CRC_TABLE[(crc ^ column) & 0xFF] ^ (crc >> np.uint32(8))
            crcs[part] = ~crc
    return crcs


def features_of(text: bytes, n: int) -> Iterator[tuple[int, list[bytes]]]:
    """(words, features) of each chunk of a text; runs that cross chunks are made in the later one."""
    before: list[bytes] = []
    at = 0
    while at < len(text):
        end = at + CHUNK_BYTES
        if end < len(text):
            end = text.find(b" ", end) if text.rfind(b" ", at, end) <= at else text.rfind(b" ", at, end)
            end = len(text) if end < 0 else end
        words = text[at:end].split()
        at = end
        line, features = before + words, list(words)
        for size in range(2, n + 1):
            first = max(0, len(before) - size + 1)
            features += [b" ".join(line[i : i + size]) for i in range(first, len(line) - size + 1)]
        before = line[len(line) - n + 1 :] if n > 1 else []
        yield len(words), features


def _buckets(features: list[bytes], buckets: int) -> np.ndarray:
    distinct = list(set(features))
    of_distinct = (crc32s(distinct) % np.uint32(buckets)).astype(np.int32)
    place = dict(zip(distinct, range(len(distinct))))
    return of_distinct[np.fromiter(map(place.__getitem__, features), np.int64, len(features))]


def hashed(docs: DataFrame, n: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """The columns of ``docs`` without its ``text``, with n_words and the buckets of all features of the whole text."""
    others = [c for c in docs.columns if c not in ("text", "n_words", "buckets")]

    def together(batch: pa.RecordBatch, rows: list[int], parts: list[tuple[int, list[bytes]]], owner: list[int]) -> pa.RecordBatch:
        """Rows of ``batch`` with the features of ``parts``, of which several may belong to one row."""
        found = _buckets(list(chain.from_iterable(features for _, features in parts)), buckets)
        sizes = np.zeros(len(rows) + 1, np.int64)
        words = np.zeros(len(rows), np.int64)
        for row, (count, features) in zip(owner, parts):
            sizes[row + 1] += len(features)
            words[row] += count
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes).astype(np.int32)), pa.array(found))
        kept = [c.take(pa.array(rows, pa.int64())) for c in batch.columns[1:]]
        return pa.RecordBatch.from_arrays([*kept, pa.array(words), lists], names=[*others, "n_words", "buckets"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, parts, owner, held = [], [], [], 0
            for i, value in enumerate(batch.column(0)):
                text = value.as_buffer().to_pybytes().translate(WORD_BYTES) if value.is_valid else b""
                if rows and held + len(text) > CHUNK_BYTES:
                    yield together(batch, rows, parts, owner)
                    rows, parts, owner, held = [], [], [], 0
                rows.append(i)
                held += len(text)
                if len(text) > CHUNK_BYTES:  # hashed chunk by chunk, so that its features are not all held at once
                    whole = [(count, _buckets(features, buckets)) for count, features in features_of(text, n)]
                    found = pa.array(np.concatenate([b for _, b in whole]) if whole else np.zeros(0, np.int32))
                    lists = pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), found)
                    kept = [c.slice(i, 1) for c in batch.columns[1:]]
                    words = pa.array([sum(count for count, _ in whole)], pa.int64())
                    yield pa.RecordBatch.from_arrays([*kept, words, lists], names=[*others, "n_words", "buckets"])
                    rows, parts, owner, held = [], [], [], 0
                else:
                    for part in features_of(text, n):
                        owner.append(len(rows) - 1)
                        parts.append(part)
            if rows:
                yield together(batch, rows, parts, owner)

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others]
    return docs.select("text", *others).mapInArrow(run, ", ".join([*fields, "n_words bigint", "buckets array<int>"]))


# --------------------------------------------------------------------------- gains and weights


def bucket_counts(features: DataFrame) -> DataFrame:
    """bucket and n, the features of all rows in it."""
    return features.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket, in thousandths; ``corpus`` and ``target`` are written tables of ``hashed``."""
    held = bucket_counts(corpus).withColumnRenamed("n", "s").join(bucket_counts(target).withColumnRenamed("n", "t"), "bucket", "full")
    rows = held.select("bucket", F.coalesce("s", F.lit(0)), F.coalesce("t", F.lit(0))).collect()  # one row per bucket
    s, t = np.zeros(buckets), np.zeros(buckets)
    for bucket, in_corpus, in_target in rows:
        s[bucket], t[bucket] = in_corpus, in_target
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighted(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """``features`` with n_features and weight, the sum of the gains of its buckets, in place of the buckets."""
    others = [c for c in features.columns if c not in ("buckets", "n_features", "weight")]
    shared = features.sparkSession.sparkContext.broadcast(gain)  # one number per bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            edges = lists.offsets.to_numpy()
            values = lists.values.to_numpy()[edges[0] : edges[-1]]
            running = np.concatenate([[0], np.cumsum(shared.value[values])])
            edges = edges - edges[0]
            found = [pa.array(np.diff(edges).astype(np.int64)), pa.array(running[edges[1:]] - running[edges[:-1]])]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *found], names=[*others, "n_features", "weight"])

    fields = [f"`{c}` {features.schema[c].dataType.simpleString()}" for c in others]
    schema = ", ".join([*fields, "n_features bigint", "weight bigint"])
    return features.select("buckets", *others).mapInArrow(run, schema)


def scored(rows: DataFrame, seed: str = SEED) -> DataFrame:
    """``rows`` with score: the weight plus Gumbel noise of the document's id, in thousandths."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(4294967296.0)
    return rows.withColumn("score", F.col("weight") + F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))))


# --------------------------------------------------------------------------- drawing


def drawn(rows: DataFrame, percent: int = DRAWN_PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, n_features, weight, score and rank, null for a document that is not drawn.

    ``percent`` of the rows with ``least_words`` words, rounded down, are drawn: those with the highest scores, ties to the
    smaller doc_id. The sorted rows are written with their range and their place in it, which makes ranks reproducible when
    a task is repeated.
    """
    spark = rows.sparkSession
    rows = stage(rows.select("doc_id", "n_words", "n_features", "weight", "score"), "scored")
    counted = rows.agg(F.count("*"), F.count_if(F.col("n_words") >= least_words)).first()
    ranges = max(spark.sparkContext.defaultParallelism, counted[0] // ROWS_PER_RANGE)
    order = [F.desc("eligible"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]
    ordered = rows.withColumn("eligible", F.col("n_words") >= least_words).repartitionByRange(ranges, *order)
    ordered = ordered.sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    ordered = stage(ordered, "ranked")
    part = F.shiftright("at", 33)
    sizes = sorted(ordered.groupBy(part.alias("part")).count().collect())  # one row per range
    before = np.cumsum([0, *[n for _, n in sizes]]).tolist()
    offsets = spark.createDataFrame([(p, b) for (p, _), b in zip(sizes, before)], "part bigint, before bigint")
    place = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    rank = F.when(place <= F.lit(counted[1] * percent // 100), place).alias("rank")
    return ordered.withColumn("part", part).join(offsets, "part").select("doc_id", "n_features", "weight", "score", rank)


def resampled(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = BUCKETS, percent: int = DRAWN_PERCENT, seed: str = SEED) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with n_features, weight, score and its rank in the sample towards ``target`` (text)."""
    corpus = stage(hashed(docs.select("doc_id", "text"), n, buckets), "features")
    towards = stage(hashed(target.select("text"), n, buckets), "features")
    return drawn(scored(weighted(corpus, gains(corpus, towards, buckets)), seed), percent)


# --------------------------------------------------------------------------- the query

#: CTEs: the entries of the CRC table.
CRC_ENTRIES = """crc_table AS (
    SELECT i, list_reduce([i::UBIGINT, 0, 1, 2, 3, 4, 5, 6, 7],
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS entry
    FROM range(256) AS r(i)
), entries AS (SELECT list(entry ORDER BY i) AS entry FROM crc_table)"""


def crc_sql(digits: str) -> str:
    """The CRC-32 of bytes given in upper-case hexadecimal digits, where ``entry`` is in scope."""
    byte = f"(instr('0123456789ABCDEF', {digits}[2 * k + 1]) - 1) * 16 + instr('0123456789ABCDEF', {digits}[2 * k + 2]) - 1"
    listed = f"list_transform(range(0, length({digits}) // 2), lambda k: ({byte})::UBIGINT)"
    step = "xor(c // 256, entry[(xor(c, b) % 256 + 1)::BIGINT])"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {listed}), lambda c, b: {step}), 4294967295::UBIGINT)"


ORACLE = rf"""
WITH {CRC_ENTRIES},
words AS (
    SELECT 'd' AS side, doc_id AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents
    UNION ALL
    SELECT 'b', item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark
), used AS (SELECT side, id, word, count(*) AS n FROM words GROUP BY ALL),
spelled AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM used)),
hashed AS (
    SELECT word, {crc_sql('h')} % 10000 AS bucket
    FROM spelled, entries
), placed AS (SELECT side, id, bucket, n FROM used JOIN hashed USING (word)),
counts AS (
    SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t FROM placed GROUP BY bucket
), totals AS (SELECT coalesce(sum(s), 0)::DOUBLE AS all_s, coalesce(sum(t), 0)::DOUBLE AS all_t FROM counts),
gain AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (all_s + 10000) / ((s + 1)::DOUBLE * (all_t + 10000))))::BIGINT AS gain FROM counts, totals),
weights AS (SELECT id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM placed JOIN gain USING (bucket) WHERE side = 'd' GROUP BY id),
noise AS (
    SELECT doc_id, list_reduce(list_prepend(0::BIGINT, list_transform(range(1, 9),
        lambda k: (instr('0123456789abcdef', sha256('2024:' || doc_id)[k]) - 1)::BIGINT)), lambda a, b: 16 * a + b) AS h FROM documents
), scores AS (
    SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM noise LEFT JOIN weights ON id = doc_id
), ranks AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
        count(*) FILTER (n_features >= 20) OVER () AS eligible FROM scores
)
SELECT doc_id, n_features, weight, score,
    CASE WHEN n_features >= 20 AND place <= eligible * 10 // 100 THEN place END AS "rank"
FROM ranks
"""


@query("op11_crc_resampling", ORACLE)
def crc_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its weight towards the benchmark texts, and the ranks of the tenth that is drawn."""
    return resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))

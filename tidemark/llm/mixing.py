"""Mixing sources to target weights by Pareto order sampling.

A source of ``source_size`` words with a target of ``target`` words repeats its documents ``target / source_size`` times
on average. The whole part is certain: each document is taken that often. The rest is the inclusion probability ``p``
of one more copy. Documents are ranked by random odds over inclusion odds, ``(u / (1 - u)) / (p / (1 - p))``, with a
``u`` that only depends on the seed and the document, and are taken in that order until the words that are left are
filled; the document at the border is taken when more than half of it fits. So a source misses its target by at most
half a document.

``p`` is the same within a source, so the order there is that of ``u``, whose bits place the border: level by level, the
words per source and slot of 12 bits are summed, and only the slot that holds the border is looked at more closely. Where
very many rows have the same ``u``, as of one repeated id, the bits of a hash of their content and then of their place in
the table go on. No source is ever sorted or gathered, however many rows it holds.

Defined cases: a null text counts no words; a null source is a source of its own, last in order; a null id draws like
an empty one; rows that share an id are drawn one after another, in the order of a hash of their content, equal rows in any
order; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.registry import query, table
from tidemark.plans.ordered import number, order_rows
from tidemark.plans.staging import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MOST_REPEATS = 3
SEED = "mix"
#: A draw has 52 bits.
DRAW_BITS = 52
#: What each level looks at: a number of the row without its last bits. Rows are ordered by the numbers.
LEVELS = [("u", 40), ("u", 28), ("u", 16), ("u", 0), ("content", 36), ("content", 24), ("content", 12), ("content", 0)]
LEVELS += [("row", shift) for shift in (51, 39, 27, 15, 3, 0)]
#: Levels end when no source has more rows left.
BORDER_ROWS = 10_000


def draw(seed: str, doc_id: Column) -> Column:
    """A uniform integer below 2**52 for a document."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


def source_key(source: Column) -> Column:
    """A key without nulls, in code point order of the sources, null last."""
    return F.when(source.isNull(), "1").otherwise(F.concat(F.lit("0"), source.cast("string")))


def source_targets(sources: DataFrame, weights: Sequence[float], most_repeats: float) -> DataFrame:
    """Share all words among sources (``key``, ``source_size``) by weights that repeat in key order, up to the cap.

    Raising the common level until no source is above its cap needs one small aggregate per step.
    """
    ranked = order_rows(sources, [], ["key"]).scan(position=number(0)).rows()
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.col("position") % len(weights)).cast("int"))
    ranked = stage(ranked.withColumn("weight", weight).drop("position"), "sources")
    cap = F.col("source_size") * float(most_repeats)
    total, free = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.sum("weight")).first()
    level, before = (total / free if free else 0.0), None
    while level != before:
        above = F.col("weight") * F.lit(level) > cap
        capped, free = ranked.agg(
            F.coalesce(F.sum(F.when(above, F.col("source_size"))), F.lit(0)), F.sum(F.when(~above, F.col("weight")))
        ).first()
        before, level = level, ((total - most_repeats * capped) / free if free else level)
    share = F.col("weight") * F.lit(level)
    return ranked.select("key", "source_size", F.least(share, cap).alias("target"))


def _border(rows: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame, tuple[str, int]]:
    """Where each source's words fill up; the rows there; the level that was reached.

    The border has, per key, ``prefix``, the slot of the level, ``left``, the words left in it, and the whole numbers of the
    levels before.
    """
    border = sources.select("key", "left", *[F.lit(None).cast("bigint").alias(f"at_{c}") for c in ("u", "content", "row")])
    inside = rows
    for column, shift in LEVELS:
        slot = F.shiftright(column, shift)
        slots = inside.groupBy("key", slot.alias("slot")).agg(F.sum("size").alias("words"), F.count("*").alias("n"))
        before = F.sum("words").over(Window.partitionBy("key").orderBy("slot")) - F.col("words")
        reached = (
            slots.withColumn("before", before)
            .join(border.drop("prefix", "n"), "key")
            .filter((F.col("before") <= F.col("left")) & (F.col("left") < F.col("before") + F.col("words")))
            .withColumns({"left": F.col("left") - F.col("before"), f"at_{column}": F.col("slot")})
            .select("key", F.col("slot").alias("prefix"), "left", "n", "at_u", "at_content", "at_row")
        )
        border = stage(reached, "border")
        inside = inside.withColumn("prefix", slot).join(border.select("key", "prefix"), ["key", "prefix"], "left_semi").drop("prefix")
        if (border.agg(F.max("n")).first()[0] or 0) <= BORDER_ROWS:
            break
    return border.drop("n"), inside, (column, shift)


def _before_border(level: tuple[str, int]) -> Column:
    """Whether a row comes before the slot of the border."""
    column, shift = level
    out = F.shiftright(column, shift) < F.col("prefix")
    for earlier in reversed(["u", "content", "row"][: ["u", "content", "row"].index(column)]):
        at = F.col(f"at_{earlier}")
        out = (F.col(earlier) < at) | ((F.col(earlier) == at) & out)
    return out


def _decided(docs: DataFrame, size: Column, weights: Sequence[float], most_repeats: float, seed: str, whole: bool) -> DataFrame:
    """key, size and u of each document, with what its source gets, and copies; ``all``, its columns, if ``whole``."""
    content = F.xxhash64(*[c for c in ("doc_id", "text", "source") if c in docs.columns]).bitwiseAND(F.lit((1 << 48) - 1))
    columns = [
        source_key(F.col("source")).alias("key"), size.cast("bigint").alias("size"), draw(seed, F.col("doc_id")).alias("u"),
        content.alias("content"), "doc_id", F.monotonically_increasing_id().alias("row"),
    ]
    rows = stage(docs.select(*columns, *[F.struct("*").alias("all")] * whole), "mix")
    narrow = rows.select("key", "size", "u", "content", "row")
    sources = source_targets(narrow.groupBy("key").agg(F.sum("size").alias("source_size")), weights, most_repeats)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sources = sources.withColumn("whole", F.floor(ratio)).withColumn("p", ratio - F.col("whole"))
    sources = stage(sources.withColumn("left", F.col("target") - F.col("whole") * F.col("source_size")), "targets")
    border, inside, level = _border(narrow, sources)

    place = F.struct("u", "content", "row")
    near = Window.partitionBy("key").orderBy("u", "content", "row").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        inside.withColumn("before", F.coalesce(F.sum("size").over(near), F.lit(0)))
        .join(border, "key")
        .filter(F.col("before") + F.col("size") / 2 < F.col("left"))
        .groupBy("key")
        .agg(F.max(place).alias("last"))
    )
    known = sources.join(border.drop("left"), "key", "left").join(last, "key", "left")
    known = stage(known.withColumn("full", (F.col("left") > 0) & F.col("prefix").isNull()), "known")
    extra = F.col("full") | _before_border(level) | (place <= F.col("last"))
    return rows.join(known, "key").withColumn("copies", F.col("whole") + F.coalesce(extra, F.lit(False)).cast("bigint"))


def mix(
    docs: DataFrame,
    size: Column,
    weights: Sequence[float] = WEIGHTS,
    most_repeats: int = MOST_REPEATS,
    seed: str = SEED,
) -> DataFrame:
    """The documents with size, source_size, target, copies, p, pareto_rank and taken (copies times size)."""
    u = (F.col("u") + 0.5) / float(2**DRAW_BITS)
    return _decided(docs, size, weights, most_repeats, seed, whole=False).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "copies",
        "p",
        F.when(F.col("p") > 0, (u / (1 - u)) / (F.col("p") / (1 - F.col("p")))).alias("pareto_rank"),
    )


def mixed(
    docs: DataFrame,
    size: Column,
    weights: Sequence[float] = WEIGHTS,
    most_repeats: int = MOST_REPEATS,
    seed: str = SEED,
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    rows = _decided(docs, size, weights, most_repeats, seed, whole=True).filter("copies > 0")
    return rows.select("all", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))).select("all.*")


def words(column: str = "text") -> Column:
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0))


SQL = rf"""
WITH d AS (SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS k,
  len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
  ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT AS u FROM documents),
s AS (SELECT k, sum(size)::BIGINT AS z,
  CASE ((row_number() OVER (ORDER BY k)) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM d GROUP BY k),
r AS (SELECT *, sum(z) OVER () AS total, sum(w) OVER () AS weights,
  coalesce(sum(z) OVER (ORDER BY z / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS zb,
  coalesce(sum(w) OVER (ORDER BY z / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS wb FROM s),
l AS (SELECT arg_min(level, wb) AS level FROM (SELECT (total - 3 * zb)::DOUBLE / (weights - wb) AS level, w, z, wb FROM r) WHERE w * level <= 3 * z),
t AS (SELECT k, z, least(w * level, 3.0 * z)::DOUBLE AS target FROM s, l),
f AS (SELECT *, CASE WHEN z > 0 THEN floor(target / z)::BIGINT ELSE 0 END AS whole FROM t),
c AS (SELECT d.*, z, target, whole, target - whole * z AS rest,
  coalesce(sum(size) OVER (PARTITION BY d.k ORDER BY u, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN f ON d.k = f.k)
SELECT doc_id, size, z AS source_size, target,
  (size * (whole + CASE WHEN before + size / 2.0 < rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM c
"""


@query("op7_pareto_mix", SQL)
def pareto_mix(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed to the weights 5, 2, 1, repeating over the sources."""
    mixture = mix(table(spark, folder, "documents"), words())
    return mixture.select("doc_id", "size", "source_size", "target", "taken")

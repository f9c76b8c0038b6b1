"""Quality rules by robust multivariate outliers.

Each text gives a vector of transformed statistics: log mean word length, and square roots of the shares of symbols,
of repeated lines and of repeated words. For each language and source, location and scatter are minimum-covariance-
determinant estimates: of the share ``KEPT_SHARE`` of documents whose covariance has the least determinant. A document is
rejected when its Mahalanobis distance is beyond what a clean one shows.

The estimates are made as by the fast algorithm for large samples: every group is divided into subsets of bounded size,
each finds its best estimate from many random starts, and the best of these takes concentration steps over all rows of
the group, which are two aggregates each. Equal vectors are one weighted row of a subset, so that a group with a third of
all rows, or thousands of copies of one text, is many subsets of bounded size and partial aggregates.

The covariance of the nearest rows understates the spread of clean documents, and real statistics have longer tails than
normal ones. Distances are therefore divided by the group's own: the larger of what its median and its ``KEPT_SHARE``
quantile show beside those of normal vectors.

Most texts have no symbol and no repeated line at all, so a group's scatter can be zero in a direction. ``FLOORS`` is the
least deviation that counts: beside texts without any repetition, one with a fifth of its lines and words repeated is out.

Groups of fewer than ``LEAST_ROWS`` documents are pooled in the group ``*``, and judged by the sum of all groups' moments.

Defined cases: a null or blank text has no words and fails the base rule; null languages and sources are groups of their
own; null and repeated ids are rows like any other; with no document that passes the base rule there is no estimate and
nothing is kept; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.registry import query, table
from tidemark.plans.staging import stage

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
SYMBOLS = b"#*$%&|<>"
VECTOR = ("x0", "x1", "x2", "x3")
#: Least standard deviation of each statistic.
FLOORS = np.array([0.05, 0.03, 0.12, 0.12])
KEPT_SHARE = 0.75
SUBSET_ROWS, STARTS, STEPS = 2_000, 10, 3
LEAST_ROWS = 30
#: Normal quantiles: of the share of clean documents that the cut-off may reject, one in a thousand, and of ``KEPT_SHARE``.
QUANTILE, KEPT_QUANTILE = 3.0902, 0.6745
POOLED = "*"


# --------------------------------------------------------------------------- statistics of a text


def text_counts(text: bytes) -> tuple[int, ...]:
    """The ``COUNTS`` of a UTF-8 text."""
    words = text.split()  # at ASCII white space
    n = len(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeated = 0
    if n >= 3:
        known: dict[bytes, int] = {}
        ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
        _, pair = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)
        _, window, count = np.unique(pair[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
        often = count[window] > 1
        covered = np.zeros(n, bool)
        for shift in range(3):
            covered[shift : n - 2 + shift] |= often
        repeated = int(covered.sum())
    chars = len(b"".join(words).decode("utf-8", "replace"))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    return n, chars, symbols, len(lines) - len(set(lines)), repeated, len(lines)


def with_counts(docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, of which ``text`` gives way to the counts."""
    others = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_counts(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in batch.column(0)]
            counts = np.array(found, np.int64).reshape(-1, len(COUNTS)).T
            yield pa.record_batch([*batch.columns[1:], *map(pa.array, counts)], names=[*others, *COUNTS])

    schema = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others] + [f"{c} bigint" for c in COUNTS]
    return docs.select("text", *others).mapInArrow(run, ", ".join(schema))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def vector() -> dict[str, Column]:
    words, chars, lines = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "word_chars", "n_lines"))
    values = (
        F.log(chars / words),
        F.sqrt(F.col("n_symbols") / chars),
        F.sqrt(F.col("n_dup_lines") / lines),
        F.sqrt(F.col("n_repeat_words") / words),
    )
    return dict(zip(VECTOR, values))


# --------------------------------------------------------------------------- estimates


def _floored(cov: np.ndarray) -> np.ndarray:
    lacking = np.maximum(0.05 * FLOORS**2, FLOORS**2 - np.diag(cov))  # never zero, so no matrix is singular
    return cov + np.diag(lacking)


def _moments(x: np.ndarray, n: np.ndarray):
    mean = n @ x / n.sum()
    off = x - mean
    return mean, _floored((off * n[:, None]).T @ off / n.sum())


def _concentrate(x: np.ndarray, n: np.ndarray, h: float, mean: np.ndarray, cov: np.ndarray, steps: int):
    for _ in range(steps):
        off = x - mean
        distance = np.einsum("ij,ij->i", off @ np.linalg.inv(cov), off)
        order = np.argsort(distance, kind="stable")
        before = np.cumsum(n[order]) - n[order]
        near = order[before < h]
        weights = n[near].astype(float)
        weights[-1] = min(weights[-1], h - before[len(near) - 1])  # of equal rows, as many as are lacking
        mean, cov = _moments(x[near], weights)
    return mean, cov, np.linalg.slogdet(cov)[1]


def subset_estimate(x: np.ndarray, n: np.ndarray | None = None, seed: int = 0):
    """(mean, covariance, log determinant) of vectors that occur ``n`` times: the best that random starts lead to."""
    n = np.ones(len(x)) if n is None else n
    p, total = x.shape[1], n.sum()
    h, random = min(total, max((total + p + 1) // 2, np.ceil(KEPT_SHARE * total))), np.random.default_rng(seed)
    starts = []
    for _ in range(STARTS):
        some = x[random.permutation(len(x))[: p + 1]]
        mean, cov = _moments(some, np.ones(len(some)))
        starts.append(_concentrate(x, n, h, mean, cov, 2))
    best = sorted(starts, key=lambda s: s[2])[:3]
    return min((_concentrate(x, n, h, m, c, 10) for m, c, _ in best), key=lambda s: s[2])


#: A group's estimate, and the moments it was made from.
ESTIMATE = "g string, mean array<double>, inverse array<double>"
P = len(VECTOR)
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
MOMENTS = ["n", *(f"s{i}" for i in range(P)), *(f"s{i}{j}" for i, j in PAIRS)]
#: Median and ``KEPT_SHARE`` quantile of the squared length of a normal vector, and the cut-off.
EXPECTED = [P * (1 - 2 / (9 * P) + z * (2 / (9 * P)) ** 0.5) ** 3 for z in (0.0, KEPT_QUANTILE, QUANTILE)]


def _estimate_rows(g, means, covariances) -> pd.DataFrame:
    inverses = [np.linalg.inv(c).ravel().tolist() for c in covariances]
    return pd.DataFrame({"g": list(g), "mean": [m.tolist() for m in means], "inverse": inverses})


def _distance() -> Column:
    """Squared Mahalanobis distance of the vector columns, given ``mean`` and ``inverse``."""
    off = [F.col(c) - F.col("mean")[i] for i, c in enumerate(VECTOR)]
    terms = [off[i] * off[j] * F.col("inverse")[i * P + j] for i in range(P) for j in range(P)]
    return reduce(lambda a, b: a + b, terms)


def _from_moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if len(batch):
            n = batch["n"].to_numpy(float)[:, None]
            means = batch[[f"s{i}" for i in range(P)]].to_numpy() / n
            second = np.empty((len(batch), P, P))
            for i, j in PAIRS:
                second[:, i, j] = second[:, j, i] = batch[f"s{i}{j}"].to_numpy() / n[:, 0]
            covariances = [_floored(c) for c in second - means[:, :, None] * means[:, None, :]]
            yield _estimate_rows(batch["g"], means, covariances)


def _scaled(rows: DataFrame, now: DataFrame) -> DataFrame:
    """The estimates with ``scale``, by which the squared distances of their groups exceed normal ones."""
    shares = F.percentile_approx(_distance(), [0.5, KEPT_SHARE], 10_000)
    shown = rows.join(now, "g").groupBy("g").agg(shares.alias("q"))
    scale = F.greatest(F.lit(1.0), *[F.col("q")[k] / EXPECTED[k] for k in (0, 1)])
    return now.join(stage(shown.select("g", scale.alias("scale")), "estimates"), "g")


def estimates(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """g, mean, inverse and scale for each group ``g`` of ``rows``, and one row all_mean, all_inverse, all_scale.

    ``rows`` have g and the ``VECTOR``. What has one row per group is stored before a join, so that Spark knows its size:
    small ones are broadcast, and rows stay where they are.
    """
    vectors = stage(rows.groupBy("g", *VECTOR).agg(F.count("*").alias("times")), "vectors")
    sizes = stage(vectors.groupBy("g").agg(F.count("*").alias("n")), "sizes")
    subsets = F.ceil(F.col("n") / SUBSET_ROWS)
    divided = vectors.join(sizes, "g").withColumn("subset", F.pmod(F.xxhash64(*VECTOR), subsets))

    def fit(name: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(list(VECTOR))  # the result does not depend on the order of arrival
        mean, cov, det = subset_estimate(rows[list(VECTOR)].to_numpy(), rows["times"].to_numpy(float))
        return _estimate_rows([name[0]], [mean], [cov]).assign(det=det, subset=name[1])

    found = divided.groupBy("g", "subset").applyInPandas(fit, f"{ESTIMATE}, det double, subset bigint")
    best = found.groupBy("g").agg(F.min_by(F.struct("mean", "inverse"), F.struct("det", "subset")).alias("e"))
    now = stage(best.select("g", "e.*"), "estimates")
    for _ in range(STEPS):
        limit = F.percentile_approx(_distance(), KEPT_SHARE, 10_000)
        limits = stage(rows.join(now, "g").groupBy("g").agg(limit.alias("limit")), "limits")
        near = rows.join(now.join(limits, "g"), "g").filter(_distance() <= F.col("limit"))
        sums = [F.sum(VECTOR[i]).alias(f"s{i}") for i in range(P)]
        sums += [F.sum(F.col(VECTOR[i]) * F.col(VECTOR[j])).alias(f"s{i}{j}") for i, j in PAIRS]
        moments = stage(near.groupBy("g").agg(F.count("*").alias("n"), *sums), "moments")
        now = stage(moments.mapInPandas(_from_moments, ESTIMATE), "estimates")
    own = stage(_scaled(rows, now), "estimates")
    added = moments.agg(*[F.sum(c).alias(c) for c in MOMENTS]).filter("n > 0").withColumn("g", F.lit(POOLED))
    scale = own.join(moments.select("g", "n"), "g").agg((F.sum(F.col("n") * F.col("scale")) / F.sum("n")).alias("all_scale"))
    overall = added.mapInPandas(_from_moments, ESTIMATE).select(F.col("mean").alias("all_mean"), F.col("inverse").alias("all_inverse"))
    return own, stage(overall.crossJoin(scale), "estimates")  # one row each


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, kept, and distance, the squared one in units of its group's scatter."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
    columns = docs.select("doc_id", "text", F.concat_ws("\x1f", part("lang"), part("source")).alias("g"))
    rows = with_counts(columns).withColumn("base_failed", base_failed()).withColumns(vector())
    rows = stage(rows, "statistics")
    fit = rows.filter("NOT base_failed").select("g", *VECTOR)
    large = stage(fit.groupBy("g").count().filter(F.col("count") >= LEAST_ROWS).select("g", F.lit(True).alias("own")), "groups")
    group = F.when(F.col("own"), F.col("g")).otherwise(POOLED)
    own, overall = estimates(fit.join(large, "g", "left").select(group.alias("g"), *VECTOR))
    out = rows.join(own.filter(F.col("g") != POOLED), "g", "left").join(F.broadcast(overall), F.lit(True), "left")  # one row
    for name in ("mean", "inverse", "scale"):
        out = out.withColumn(name, F.coalesce(name, f"all_{name}"))
    out = out.withColumn("distance", _distance() / F.col("scale"))
    kept = F.when(F.col("base_failed"), False).otherwise(F.coalesce(F.col("distance") <= EXPECTED[2], F.lit(False)))
    return out.select("doc_id", *COUNTS, "base_failed", kept.alias("kept"), "distance")


@query("op6_robust_outliers")
def robust_outliers(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its counts and whether it is kept."""
    return judged(table(spark, folder, "documents")).drop("n_lines")

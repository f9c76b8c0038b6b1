"""Approximate nearest neighbours by learned partitions.

On a bounded sample, the graph of nearest neighbours is cut into balanced parts, and a small softmax classifier learns
the parts of a vector and its neighbours. The classifier puts every vector of the table into its most probable part,
and sends a query to several most probable ones, where all vectors are compared exactly. How many parts a query
visits is read off the sample: the fewest with which ``AIM`` of the sample's true neighbours are found, and always
enough to hold the neighbours asked for.

Equal vectors have equal scores, of which the smallest ids count, so of each distinct vector only as many rows are
candidates as one answer could hold. Large parts are divided into blocks, each searched on its own.

Fixed on a sample: ``SAMPLE_ROWS`` vectors, chosen by a hash of their ids. The number of parts grows with the table up
to ``MOST_PARTS``, which keeps the sample at a few dozen vectors a part.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no part, nor do those without an
id or of another length than the most frequent one; rows that repeat an id and vector count once, and rows with the
query's id are its own; ties go to the smaller id; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.registry import query, table
from tidemark.plans.staging import stage

SAMPLE_ROWS = 8_192
ROWS_PER_PART, MOST_PARTS = 1_024, 256
GRAPH_NEIGHBOURS = 10
#: Share of the sample's true neighbours that the visited parts must hold.
AIM = 0.95
LEAST_CANDIDATES = 64
BLOCK_ROWS = 20_000
QUERIES_AT_ONCE = 512
QUERIES_A_GROUP = 50_000


# --------------------------------------------------------------------------- fitting on the sample


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` nearest other rows of each unit row, nearest first."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for at in range(0, len(x), 1_024):
        score = x[at : at + 1_024] @ x.T
        score[np.arange(len(score)), np.arange(at, at + len(score))] = -np.inf
        near = np.argpartition(-score, k - 1, axis=1)[:, :k]
        out[at : at + 1_024] = np.take_along_axis(near, np.argsort(-np.take_along_axis(score, near, 1), axis=1), 1)
    return out


def _bisect(x: np.ndarray, graph: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Which half each of ``rows`` goes to: equal halves with few edges between them."""
    inside = np.full(len(graph), -1)
    inside[rows] = np.arange(len(rows))
    a = np.repeat(np.arange(len(rows)), graph.shape[1])
    b = inside[graph[rows]].ravel()
    a, b = a[b >= 0], b[b >= 0]
    centred = x[rows] - x[rows].mean(axis=0)
    side = np.zeros(len(rows), bool)
    side[np.argsort(centred @ np.linalg.svd(centred, full_matrices=False)[2][0], kind="stable")[len(rows) // 2 :]] = True
    cut, swap = np.sum(side[a] != side[b]), max(1, len(rows) // 16)
    while swap:
        across = np.where(side[a] != side[b], 1.0, -1.0)
        gain = np.bincount(a, across, len(rows)) + np.bincount(b, across, len(rows))
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        left = left[np.argsort(-gain[left], kind="stable")][:swap]
        right = right[np.argsort(-gain[right], kind="stable")][:swap]
        better = gain[left[: len(right)]] + gain[right[: len(left)]] > 0
        tried = side.copy()
        tried[left[: len(better)][better]], tried[right[: len(better)][better]] = True, False
        now = np.sum(tried[a] != tried[b])
        if better.any() and now < cut:
            side, cut = tried, now
        else:
            swap //= 2
    return side


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int) -> np.ndarray:
    """Part of each row, by halving the graph again and again; ``parts`` is a power of two."""
    label = np.zeros(len(x), np.int64)
    for _ in range(int(parts).bit_length() - 1):
        halves = np.empty_like(label)
        for old in np.unique(label):
            rows = np.flatnonzero(label == old)
            side = _bisect(x, graph, rows) if len(rows) > 1 else np.zeros(len(rows), bool)
            halves[rows] = 2 * old + side
        label = halves
    return label


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_classifier(x: np.ndarray, wanted: np.ndarray, steps: int = 150) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases of softmax regression towards ``wanted`` probabilities, by Adam on the whole sample."""
    theta = np.zeros((x.shape[1] + 1, wanted.shape[1]))
    xb = np.hstack([x, np.ones((len(x), 1))])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        gradient = xb.T @ (_softmax(xb @ theta) - wanted) / len(x) + 1e-5 * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta -= 0.3 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    return theta[:-1], theta[-1]


@dataclass(frozen=True)
class Router:
    """The fitted classifier, and how many parts a query visits."""

    weights: np.ndarray
    bias: np.ndarray
    probes: int

    def order(self, vectors: np.ndarray) -> np.ndarray:
        """Parts, most probable first, for each vector."""
        return np.argsort(-(_unit(vectors) @ self.weights + self.bias), axis=1, kind="stable")


def fit_router(sample: np.ndarray, parts: int, k: int = 5) -> Router:
    if parts < 2 or len(sample) <= parts:
        return Router(np.zeros((sample.shape[1], 1)), np.zeros(1), 1)
    x = _unit(sample.astype(np.float64))
    graph = neighbour_graph(x, GRAPH_NEIGHBOURS)
    label = balanced_parts(x, graph, parts)
    wanted = np.zeros((len(x), parts))
    np.add.at(wanted, (np.arange(len(x)), label), 1)
    for column in graph.T:
        np.add.at(wanted, (np.arange(len(x)), label[column]), 1)
    weights, bias = fit_classifier(x, wanted / wanted.sum(axis=1, keepdims=True))
    router = Router(weights, bias, parts)
    order = router.order(x)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None, :].repeat(len(x), 0), 1)
    needed = np.sort(np.take_along_axis(place, order[:, 0][graph[:, :k]], 1).ravel())  # visits until each true neighbour
    return Router(weights, bias, int(needed[min(len(needed) - 1, int(np.ceil(AIM * len(needed))) - 1)]) + 1)


# --------------------------------------------------------------------------- indexing and searching


def usable(column: Column) -> Column:
    """Whether a vector has only finite components, not all of them zero."""
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    return F.coalesce(F.forall(column, finite) & F.exists(column, lambda v: v != 0), F.lit(False))


def _few_of_each(rows: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` smallest ids of each distinct vector; a vector that very many rows share is thinned in slices first."""
    rows = rows.withColumn("_h", F.xxhash64("vector")).withColumn("_slice", F.pmod(F.xxhash64("vec_id"), F.lit(256)))
    for keys in (["_h", "vector", "_slice"], ["_h", "vector"]):
        nth = F.row_number().over(Window.partitionBy(*keys).orderBy("vec_id"))
        rows = rows.withColumn("_nth", nth).filter(F.col("_nth") <= keep).drop("_nth")
    return rows.drop("_h", "_slice")


def _routed(rows: DataFrame, router: Router, sizes: np.ndarray | None, least: int) -> DataFrame:
    """vec_id, vector and part: the most probable one, or with the parts' sizes those that a query visits."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            order = router.order(np.stack(batch["vector"].to_numpy()).astype(np.float64))
            if sizes is None:
                yield batch.assign(part=order[:, 0])
                continue
            before = np.cumsum(sizes[order], axis=1) - sizes[order]
            visit = (np.arange(order.shape[1])[None, :] < router.probes) | (before < least)
            visit &= sizes[order] > 0
            row, column = np.nonzero(visit)
            yield batch.iloc[row].assign(part=order[row, column])

    return rows.select("vec_id", "vector").mapInPandas(run, "vec_id bigint, vector array<float>, part bigint")


def _best(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int) -> pd.DataFrame:
    """The exact ``k`` best of the rows for each query. Products over all rows only choose what is scored exactly."""
    norm = lambda m: np.sqrt(np.einsum("ij,ij->i", m, m))
    nx, nq, out = norm(x), norm(q), []
    rough = (q / nq[:, None]) @ (x / nx[:, None]).T
    rough[query_ids[:, None] == ids[None, :]] = -np.inf
    kth = np.partition(rough, -min(k, len(ids)), axis=1)[:, -min(k, len(ids))]
    near = (rough >= kth[:, None] - 1e-9) & (rough > -np.inf)
    for i in range(len(q)):
        at = np.flatnonzero(near[i])
        score = np.einsum("ij,ij->i", x[at], np.broadcast_to(q[i], (len(at), q.shape[1]))) / (nx[at] * nq[i])
        best = np.lexsort((ids[at], -score))[:k]
        out.append((np.full(len(best), query_ids[i]), ids[at[best]], score[best]))
    query_id, vec_id, score = (np.concatenate(c) for c in zip(*out))
    return pd.DataFrame({"query_id": query_id, "vec_id": vec_id, "score": score})


def nearest(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest rows found for each row that ``is_query``.

    ``vectors`` has vec_id and embedding.
    """
    spark = vectors.sparkSession
    rows = vectors.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<float>").alias("vector")
    )
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    lengths = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head()
    if lengths is None:
        return spark.createDataFrame([], schema)
    rows = rows.filter(F.size("vector") == lengths["d"])
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").select("vector").limit(SAMPLE_ROWS).collect()
    parts = 1 << max(0, (min(MOST_PARTS, lengths["count"] // ROWS_PER_PART)).bit_length() - 1)
    router = fit_router(np.array([r["vector"] for r in sample], np.float64), parts, k)

    index = stage(_routed(_few_of_each(rows, k + 1), router, None, 0), "index")
    sizes = np.zeros(len(router.bias), np.int64)
    for row in index.groupBy("part").count().collect():  # one row per part
        sizes[row["part"]] = row["count"]
    blocks = F.get(F.array(*[F.lit(int(-(-n // BLOCK_ROWS) or 1)) for n in sizes]), F.col("part").cast("int"))
    index = index.withColumn("block", F.pmod(F.xxhash64("vec_id"), blocks).cast("int"))
    asked = _routed(rows.filter(is_query).distinct(), router, sizes, max(LEAST_CANDIDATES, 2 * k + 2))

    def search(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        ids, x = left["vec_id"].to_numpy(), np.stack(left["vector"].to_numpy()).astype(np.float64)
        found = []
        for at in range(0, len(right), QUERIES_AT_ONCE):
            some = right.iloc[at : at + QUERIES_AT_ONCE]
            q = np.stack(some["vector"].to_numpy()).astype(np.float64)
            found.append(_best(ids, x, some["vec_id"].to_numpy(), q, k))
        return pd.concat(found)

    asked = stage(asked.withColumn("block", F.explode(F.sequence(F.lit(0), blocks.cast("int") - 1))), "asked")
    # Queries of one block come in portions too, so that neither side of a group grows with the table.
    per_part = asked.groupBy("part", "block").count().agg(F.max("count")).first()[0] or 0
    portions = F.lit(-(-per_part // QUERIES_A_GROUP) or 1).cast("bigint")
    asked = asked.withColumn("portion", F.pmod(F.xxhash64("vec_id", F.lit(1)), portions))
    index = index.withColumn("portion", F.explode(F.sequence(F.lit(0).cast("bigint"), portions - 1)))
    keys = ["part", "block", "portion"]
    found = index.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(search, "query_id bigint, vec_id bigint, score double")
    # At most k rows for each visited block of a query.
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.distinct().withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@query("op10_learned_partitions")
def learned_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest rows of every row whose id is divisible by 50."""
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)

"""SimHash near-duplicates by a self-join of binary tries.

A fingerprint has 64 bits, set by the majority of the hashes of a text's word shingles. Two fingerprints that differ in
at most three bits agree on one of four blocks of 16 bits, so each distinct fingerprint goes to four groups, one per
block. In a group, a binary trie is joined with itself: pairs of nodes are traversed together from the root, a bit that
differs costs one of the error budget, and a pair is pruned when the budget is exceeded, or when everything below it is
already known to be connected. A group that is too large for one task is divided by the blocks of its other bits in the
same way, again and again, so no link is lost and no task gets an unbounded group.

A group returns links between each fingerprint and the representative of its connected part, never all pairs; stars of
minima join the parts over all groups.

Defined cases: a null or blank text has fingerprint zero, which links like any other; texts shorter than a shingle hash
as one sequence; a null id takes part but never names a component unless all of its documents have none; repeated rows
stay; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.registry import query, table
from tidemark.llm.worker_memory import forget, frugal
from tidemark.plans.staging import stage

#: Blocks into which the open bits are divided: one more than the bits that may differ.
BUDGET, BLOCKS = 3, 4
#: A group of more fingerprints is divided further.
GROUP_ROWS = 20_000
#: Fingerprints (times blocks) a task joins.
TASK_ROWS = 200_000
#: Node pairs of this many leaf pairs or fewer are compared outright.
LEAF_PAIRS = 64
PAIRS_AT_ONCE = 1_000_000


# --------------------------------------------------------------------------- fingerprints


def simhash(words: list[bytes], shingle: int, seed: int = 42) -> int:
    """The majority bits of the XXH64 of all shingles of space-joined words; zero for no words."""
    if not words:
        return 0
    hashed = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return hashed(b" ".join(words), seed)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    count = len(words) - shingle + 1
    pieces = zip(starts[:count].tolist(), ends[shingle - 1 :].tolist())
    ones = np.zeros(64, np.int64)
    hashes = np.fromiter((hashed(line[a:b], seed) for a, b in pieces), np.uint64, count)
    for at in range(0, count, 65_536):
        bits = np.unpackbits(hashes[at : at + 65_536].astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """The columns of ``docs``, of which ``text`` gives way to ``fp``, the fingerprint as a signed 64-bit integer."""
    others = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            found = []
            for text in batch.column(0):
                data = (text.as_buffer().to_pybytes() if text.is_valid else b"").lower()
                found.append(simhash(data.split(), shingle))
            fp = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.record_batch([*batch.columns[1:], fp], names=[*others, "fp"])

    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others), "fp bigint"])
    return docs.select("text", *others).mapInArrow(frugal(run), schema)


# --------------------------------------------------------------------------- the trie join


def _labels(count: int, left: np.ndarray, right: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of ``count`` nodes, given labels of what is known already."""
    while True:
        a, b = labels[left], labels[right]
        low = np.minimum(a, b)
        if np.array_equal(a, b):
            return labels
        np.minimum.at(labels, a, low)
        np.minimum.at(labels, b, low)
        while True:
            jumped = labels[labels]
            if np.array_equal(jumped, labels):
                break
            labels = jumped


def trie_links(group: np.ndarray, fp: np.ndarray, budget: int = BUDGET) -> np.ndarray:
    """For rows sorted by (group, fp), distinct: the first row that each is connected to within its group.

    Nodes of the tries are row ranges. A growing budget finds the close links first, so that the pairs below nodes that
    are connected throughout need no visit with the larger one.
    """
    count = len(fp)
    labels = np.arange(count)
    if count < 2:
        return labels
    edge = np.flatnonzero(np.diff(group)) + 1
    starts, ends = np.concatenate([[0], edge]), np.concatenate([edge, [count]])
    many = ends - starts > 1
    roots = np.stack([starts[many], ends[many], starts[many], ends[many], np.zeros(many.sum(), np.int64)])
    zeros = {}
    for bit in range(63, -1, -1):
        is_zero = ((fp >> np.uint64(bit)) & np.uint64(1)) == 0
        zeros[bit] = np.concatenate([[0], np.cumsum(is_zero)]).astype(np.int32)
    for allowed in range(1, budget + 1):
        stack = [(63, part) for part in np.array_split(roots, max(1, roots.shape[1] // 50_000 + 1), axis=1)]
        while stack:
            bit, pairs = stack.pop()
            breaks = np.concatenate([[0], np.cumsum(labels[1:] != labels[:-1])])
            alo, ahi, blo, bhi, spent = pairs
            same = (labels[alo] == labels[blo]) & (breaks[ahi - 1] == breaks[alo]) & (breaks[bhi - 1] == breaks[blo])
            pairs = pairs[:, ~same]
            alo, ahi, blo, bhi, spent = pairs
            small = (ahi - alo) * (bhi - blo) <= LEAF_PAIRS
            small |= bit < 0
            labels = _compare(fp, pairs[:, small], allowed, labels)
            pairs = pairs[:, ~small]
            if not pairs.shape[1]:
                continue
            alo, ahi, blo, bhi, spent = pairs
            at = zeros[bit]
            amid, bmid = alo + at[ahi] - at[alo], blo + at[bhi] - at[blo]
            own = alo == blo  # a node with itself: the mixed pair counts once
            below = np.concatenate(
                [
                    np.stack([alo, amid, blo, bmid, spent]),
                    np.stack([amid, ahi, bmid, bhi, spent]),
                    np.stack([alo, amid, bmid, bhi, spent + 1]),
                    np.stack([amid, ahi, blo, bmid, spent + 1])[:, ~own],
                ],
                axis=1,
            )
            below = below[:, (below[1] > below[0]) & (below[3] > below[2]) & (below[4] <= allowed)]
            for part in np.array_split(below, below.shape[1] // PAIRS_AT_ONCE + 1, axis=1):
                if part.shape[1]:
                    stack.append((bit - 1, part))
    return labels


def _compare(fp: np.ndarray, pairs: np.ndarray, allowed: int, labels: np.ndarray) -> np.ndarray:
    """Labels after all pairs of leaves below the node pairs."""
    for part in np.array_split(pairs, pairs.shape[1] // 50_000 + 1, axis=1):
        alo, ahi, blo, bhi, _ = part
        width = bhi - blo
        sizes = (ahi - alo) * width
        owner = np.repeat(np.arange(len(sizes)), sizes)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        left, right = alo[owner] + at // width[owner], blo[owner] + at % width[owner]
        keep = left < right
        left, right = left[keep], right[keep]
        near = np.bitwise_count(fp[left] ^ fp[right]) <= allowed
        labels = _labels(len(fp), left[near], right[near], labels)
    return labels


def _divided(mask: int) -> list[int]:
    """``mask`` with one of the blocks of its open bits added, for each block."""
    open_bits = [b for b in range(64) if not mask >> b & 1]
    return [mask | sum(1 << int(b) for b in block) for block in np.array_split(open_bits, BLOCKS) if len(block)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _grouped(fps: DataFrame) -> DataFrame:
    """fp, mask and part: the groups, all small enough, in which linked fingerprints meet at least once."""
    arrays = lambda masks: F.array(*[F.lit(_signed(m)) for m in masks])
    masks = _divided(0)
    rows = fps.select("fp", F.explode(arrays(masks)).alias("mask")).withColumn("part", F.col("fp").bitwiseAND(F.col("mask")))
    ready = []
    while True:
        large = stage(rows.groupBy("mask", "part").count().filter(F.col("count") > GROUP_ROWS).drop("count"), "large")
        if large.isEmpty():
            break
        ready.append(rows.join(large, ["mask", "part"], "left_anti"))
        children = F.create_map(*[c for m in masks for c in (F.lit(_signed(m)), arrays(_divided(m)))])
        rows = (
            rows.join(large, ["mask", "part"], "left_semi")
            .select("fp", F.explode(children[F.col("mask")]).alias("mask"))
            .withColumn("part", F.col("fp").bitwiseAND(F.col("mask")))
        )
        masks = sorted({c for m in masks for c in _divided(m)})
    for more in ready:
        rows = rows.unionByName(more)
    return rows


def links(fps: DataFrame) -> DataFrame:
    """a and b for distinct fingerprints ``fp``: enough links to connect all that differ in at most ``BUDGET`` bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [tuple(c.to_numpy() for c in batch.columns) for batch in batches]
        if not held:
            return
        fp, mask, part = (np.concatenate(c) for c in zip(*held))
        fp = fp.view(np.uint64)
        order = np.lexsort((fp, part, mask))
        fp, mask, part = fp[order], mask[order], part[order]
        group = np.concatenate([[0], np.cumsum((np.diff(mask) != 0) | (np.diff(part) != 0))])
        labels = trie_links(group, fp)
        moved = np.flatnonzero(labels != np.arange(len(fp)))
        a, b = fp[moved].view(np.int64), fp[labels[moved]].view(np.int64)
        for at in range(0, len(a), 100_000):
            yield pa.record_batch([pa.array(a[at : at + 100_000]), pa.array(b[at : at + 100_000])], names=["a", "b"])

    tasks = max(fps.sparkSession.sparkContext.defaultParallelism, -(-fps.count() * BLOCKS // TASK_ROWS))
    rows = _grouped(fps).repartition(tasks, "mask", "part").select("fp", "mask", "part")
    return rows.mapInArrow(frugal(run), "a bigint, b bigint").distinct()


# --------------------------------------------------------------------------- components


def stars(edges: DataFrame) -> DataFrame:
    """node and root, the smallest node it is connected to, for every node of ``edges`` (a, b) that is not a root.

    Alternating stars: every node hands its larger, then its smaller, neighbours to the smallest one. Only minima are
    aggregated, so a node with very many neighbours is never gathered.
    """

    def minima(rows: DataFrame) -> DataFrame:
        return rows.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))

    edges = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(minima(both), "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = stage(large.distinct(), "edges")
        low = minima(large)
        small = large.join(low, "a").filter("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = stage(small.unionByName(low.select("a", F.col("low").alias("b"))).distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def near_duplicates(docs: DataFrame, shingle: int) -> DataFrame:
    """The columns of ``docs`` without its text, fp, root (a fingerprint that names the component) and component_id.

    The smallest doc_id that links of at most ``BUDGET`` bits reach is the component_id.
    """
    prints = stage(fingerprints(docs, shingle), "fingerprints")
    firsts = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = stars(links(firsts.select("fp")))
    members = firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    members = members.withColumn("root", F.coalesce("root", "fp"))
    least = members.groupBy("root").agg(F.min("first").alias("component_id"))
    return prints.join(members.join(least, "root").select("fp", "root", "component_id"), "fp")


def row_key() -> list[Column]:
    """_k and _h, by which the first row of a group is chosen: the doc_id (null last) and the hash of the text."""
    return [F.coalesce("doc_id", F.lit(2**63 - 1)).alias("_k"), F.xxhash64("text").alias("_h")]


def first_of_each(docs: DataFrame, near: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``row_key`` is the smallest of a root of ``near`` (_k, _h, root)."""
    chosen = near.groupBy("root").agg(F.min(F.struct("_k", "_h")).alias("least")).select("least.*").distinct()
    kept = docs.select("*", *row_key()).join(chosen, ["_k", "_h"], "left_semi")
    # The join has dealt and sorted the rows by these keys already.
    order = Window.partitionBy("_k", "_h").orderBy("_k")
    return kept.withColumn("_nth", F.row_number().over(order)).filter("_nth = 1").select(*docs.columns)


def one_of_each(docs: DataFrame, shingle: int) -> DataFrame:
    """The rows of ``docs``, one for each group of near-duplicates: that with the smallest doc_id (null last).

    If several rows share it, that with the smallest hash of its text stays; of rows that share both, any one.
    """
    return first_of_each(docs, near_duplicates(docs.select("doc_id", "text", *row_key()), shingle))


@query("op8_simhash_trie")
def simhash_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its fingerprint over 3-word shingles and its component."""
    found = near_duplicates(table(spark, folder, "documents").select("doc_id", "text"), shingle=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

"""Packing documents into rows of one length: best fit, no padding, every row begins with a document.

``packed`` runs several loaders side by side, each over its range of the corpus. ``packed_in_order`` gives the rows of one
loader over all of it, however large: where a document goes depends on the lengths of documents only, so the lengths are
planned range by range, each range beginning with the stored buffer of the one before, and the tokens are put together
afterwards, in parallel.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections import deque
from collections.abc import Iterator
from functools import reduce
from itertools import chain, groupby, islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.evaluation import eval_rows
from tidemark.plans.ordered import following, keep_until, number, order_rows
from tidemark.plans.staging import stage
from tidemark.schemas import PACKED

# Fixed value: documents a packer holds at least.
BUFFER_DOCS = 1_000
#: Packers by default. The rows depend on this number, so it is a parameter and never follows the cluster or the files.
PACKERS = 8
ORDER = ("epoch", "shard", "batch", "doc_id")


def with_packer(docs: DataFrame, packers: int) -> DataFrame:
    """``packer``: which contiguous range of the corpus's batches a document belongs to, the same in every epoch.

    Batches are numbered over all shards in order. There is one small row per shard.
    """
    shards = docs.groupBy("shard").agg((F.max("batch") + 1).alias("_batches"))
    upto = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.withColumn("_before", F.coalesce(F.sum("_batches").over(upto), F.lit(0)))
    shards = shards.withColumn("_total", F.sum("_batches").over(Window.partitionBy(F.lit(0))))
    place = F.expr(f"((_before + batch) * {int(packers)}) div _total")
    return docs.join(shards, "shard").withColumn("packer", place).drop("_batches", "_before", "_total")


def packed(
    docs: DataFrame, ids: Column, row_tokens: int, buffer: int = BUFFER_DOCS, packers: int = PACKERS
) -> DataFrame:
    """Rows of exactly ``row_tokens`` tokens from documents (epoch, shard, doc_id, batch, ...).

    ``ids`` is the column expression of a document's tokens, the first of which begins a document. Each of ``packers``
    takes a contiguous range of the corpus's batches and reads it in order, epoch after epoch, as one of that many
    loaders; one packer gives exactly the rows of a single loader. Rows depend only on the documents and these
    parameters. A packer holds ``buffer`` documents, refilled by whole batches. It places the largest document that
    fits, the first of equal ones. When none fits it cuts the shortest to the space that is left and drops the rest
    of it. Rows made after the last batch was read are marked ``drain``; a last row that cannot be filled is left out.
    """
    rows = with_packer(docs, packers).select("packer", *ORDER, ids.alias("ids"))
    rows = rows.repartitionById(packers, F.col("packer").cast("int")).sortWithinPartitions("packer", *ORDER)
    return rows.mapInPandas(_packer(row_tokens, buffer), PACKED)


def _packer(row_tokens: int, buffer: int):
    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def documents():
            for frame in frames:
                yield from zip(
                    frame["packer"], frame["epoch"], frame["shard"], frame["batch"], frame["ids"], strict=True
                )

        def rows_of(packer, docs):
            batches = (list(group) for _, group in groupby(docs, key=lambda d: d[1:4]))
            queues, lengths = {}, []  # documents of each length in order of arrival; the lengths held, sorted
            held, more, epoch, row_no = 0, True, 1, 0

            def take(at):
                length = lengths[at]
                doc = queues[length].popleft()
                if not queues[length]:
                    del queues[length], lengths[at]
                return doc

            while True:
                row, room, n_docs, cropped = [], row_tokens, 0, 0
                while room:
                    while more and held < buffer:
                        batch = next(batches, None)
                        more = batch is not None
                        for _, doc_epoch, _, _, ids in batch or ():
                            if len(ids) not in queues:
                                queues[len(ids)] = deque()
                                insort(lengths, len(ids))
                            queues[len(ids)].append(ids)
                            held, epoch = held + 1, doc_epoch
                    if not held:
                        return
                    fits = bisect_right(lengths, room) - 1
                    doc = take(max(fits, 0))
                    cropped += max(len(doc) - room, 0)
                    row.append(doc[:room])
                    room -= min(len(doc), room)
                    held, n_docs = held - 1, n_docs + 1
                yield packer, row_no, np.concatenate(row), epoch, not more, n_docs, cropped
                row_no += 1

        made = chain.from_iterable(
            rows_of(packer, docs) for packer, docs in groupby(documents(), key=lambda d: d[0])
        )
        names = ["packer_id", "row_id", "tokens", "epoch", "drain", "docs", "cropped"]
        while chunk := list(islice(made, 256)):
            yield pd.DataFrame(chunk, columns=names)

    return pack


# --------------------------------------------------------------------------- one loader, range by range

#: Documents planned by one task. Any number gives the same rows.
RANGE_DOCS = 500_000
PLAN = (
    "kind string, row_id bigint, slot bigint, place bigint, length bigint, taken bigint, "
    "epoch bigint, drain boolean, docs bigint, cropped bigint, room bigint, whole_batch boolean"
)


class Loader:
    """One loader's buffer of document lengths, and the row it is filling.

    It reads whole batches while it holds fewer than ``buffer`` documents, places the largest that fits, the first of equal
    ones, and when none fits cuts the shortest.
    """

    def __init__(self, row_tokens: int, buffer: int, held: list[tuple[int, int]] = (), row: tuple | None = None) -> None:
        self.row_tokens, self.buffer = row_tokens, buffer
        self.queues: dict[int, deque[int]] = {}
        self.lengths: list[int] = []
        self.held = 0
        for place, length in held:
            self.add(place, length)
        self.row_id, self.room, self.docs, self.cropped, self.epoch, self.whole_batch = row or (0, row_tokens, 0, 0, 1, True)

    def add(self, place: int, length: int) -> None:
        if length not in self.queues:
            self.queues[length] = deque()
            insort(self.lengths, length)
        self.queues[length].append(place)
        self.held += 1

    def take(self) -> tuple[int, int]:
        at = max(bisect_right(self.lengths, self.room) - 1, 0)
        length = self.lengths[at]
        place = self.queues[length].popleft()
        if not self.queues[length]:
            del self.queues[length], self.lengths[at]
        self.held -= 1
        return place, length

    def plan(self, docs: Iterator[tuple[int, int, int, bool]], last: bool) -> Iterator[tuple]:
        """Rows of ``PLAN``: placements, finished rows, and, when the documents of a range that is not the last are read, the state."""
        more = True
        while True:
            while more and (self.held < self.buffer or not self.whole_batch):
                doc = next(docs, None)
                if doc is None and not last:
                    yield from self.state()
                    return
                more = doc is not None
                if more:
                    place, length, self.epoch, self.whole_batch = doc
                    self.add(place, length)
            if not self.held:
                return
            place, length = self.take()
            taken = min(length, self.room)
            yield "place", self.row_id, self.docs, place, length, taken, *[None] * 6
            self.room, self.docs, self.cropped = self.room - taken, self.docs + 1, self.cropped + length - taken
            if not self.room:
                yield "row", self.row_id, *[None] * 4, self.epoch, not more, self.docs, self.cropped, None, None
                self.row_id, self.room, self.docs, self.cropped = self.row_id + 1, self.row_tokens, 0, 0

    def state(self) -> Iterator[tuple]:
        yield "state", self.row_id, *[None] * 4, self.epoch, None, self.docs, self.cropped, self.room, self.whole_batch
        for place, length in sorted((p, n) for n, places in self.queues.items() for p in places):  # in order of arrival
            yield "held", None, None, place, length, *[None] * 7


def _loader(row_tokens: int, buffer: int, rows: list) -> Loader:
    held = sorted((r.place, r.length) for r in rows if r.kind == "held")
    row = next(((r.row_id, r.room, r.docs, r.cropped, r.epoch, r.whole_batch) for r in rows if r.kind == "state"), None)
    return Loader(row_tokens, buffer, held, row)


def packing_plan(lengths: DataFrame, row_tokens: int, buffer: int = BUFFER_DOCS, range_docs: int = RANGE_DOCS) -> DataFrame:
    """Placements and rows of one loader from (place, length, epoch, whole_batch), places counting from 0 in reading order.

    A range is one task over its lengths. What it hands on, about ``buffer`` documents and the unfinished row, is stored with
    its plan; a task that is repeated begins with what the range before has stored.
    """
    spark = lengths.sparkSession
    count = lengths.count()
    ranges = max(1, -(-count // range_docs))
    parts, state = [], []
    for i in range(ranges):
        mine = lengths.filter((F.col("place") >= i * range_docs) & (F.col("place") < (i + 1) * range_docs))
        mine = mine.select("place", "length", "epoch", "whole_batch").coalesce(1).sortWithinPartitions("place")
        part = stage(mine.mapInPandas(_planner(row_tokens, buffer, state, i == ranges - 1), PLAN), f"packing-{i}")
        state = part.filter("kind IN ('held', 'state')").collect()  # a buffer at most
        parts.append(part.filter("kind IN ('place', 'row')"))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], PLAN)


def _planner(row_tokens: int, buffer: int, state: list, last: bool):
    names = [f.split()[0] for f in PLAN.split(", ")]

    def plan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        docs = chain.from_iterable(f.itertuples(index=False, name=None) for f in frames)
        made = _loader(row_tokens, buffer, state).plan(docs, last)
        while chunk := list(islice(made, 10_000)):
            yield pd.DataFrame(chunk, columns=names, dtype=object)

    return plan


def packed_in_order(
    docs: DataFrame, ids: Column, row_tokens: int, buffer: int = BUFFER_DOCS, range_docs: int = RANGE_DOCS
) -> DataFrame:
    """The rows of ``packed`` with one packer, for a corpus of any size and any number of ranges."""
    texts = stage(docs.select(*ORDER, ids.alias("ids")), "encoded")
    narrow = stage(texts.select(*ORDER, F.size("ids").cast("bigint").alias("length")), "lengths")
    batch = F.struct("epoch", "shard", "batch")
    ordered = order_rows(narrow, (), ORDER).scan(place=number(0), next=following(batch)).rows()
    ends = ~F.coalesce(F.col("next").eqNullSafe(batch), F.lit(False))
    ordered = stage(ordered.withColumn("whole_batch", ends).drop("next"), "ordered")
    lengths = ordered.select("place", "length", F.col("epoch").cast("bigint").alias("epoch"), "whole_batch")
    plan = packing_plan(lengths, row_tokens, buffer, range_docs)
    rows = plan.filter("kind = 'row'").select("row_id", "epoch", "drain", "docs", "cropped")
    pieces = plan.filter("kind = 'place'").select("row_id", "slot", "place", "taken").join(ordered.select("place", *ORDER), "place")
    pieces = pieces.join(texts, list(ORDER)).select("row_id", F.struct("slot", F.slice("ids", F.lit(1), F.col("taken").cast("int")).alias("ids")).alias("piece"))
    whole = pieces.groupBy("row_id").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))  # one row's tokens
    tokens = F.flatten(F.transform("pieces", lambda p: p["ids"])).alias("tokens")
    out = whole.join(rows, "row_id").select(F.lit(0).alias("packer_id"), "row_id", tokens, "epoch", "drain", "docs", "cropped")
    return out.select(*[F.col(name).cast(kind).alias(name) for name, kind in (f.split() for f in PACKED.split(", "))])


def packing_report(rows: DataFrame, row_tokens: int, bos: int) -> DataFrame:
    """Whether rows are full and begin with a document, documents per row, and tokens lost to cutting."""
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.size("tokens") == row_tokens).alias("full_rows"),
        F.count_if(F.get("tokens", F.lit(0)) == bos).alias("bos_rows"),
        F.sum("docs").cast("bigint").alias("placed_docs"),
        F.sum("cropped").cast("bigint").alias("cropped_tokens"),
        F.avg("docs").alias("docs_per_row"),
    )


def evaluation_rows(rows: DataFrame, batch_size: int, tokens: int, length: int) -> DataFrame:
    """The first packed rows an evaluation reads: whole batches within its token budget."""
    return keep_until(rows, ["packer_id", "row_id"], F.lit(1), eval_rows(batch_size, tokens, length))

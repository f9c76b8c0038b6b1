"""Row groups of parquet shards: found by reading footers, read one by one, and streamed in endless epochs.

A footer and a row group are read by ranges of their file, so files may be of any size. Spark lists the files, plans the
row groups as rows, and hands each to a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.corpus import DOCS_PER_BATCH
from tidemark.plans.ordered import number, order_rows
from tidemark.plans.staging import stage

#: Tasks of a micro-batch for each core, at most.
TASKS_PER_CORE = 2
#: Stores by the scheme of a path, where Hadoop's name for them is another than Arrow's.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def opened(path: str):
    """A file of any store, for reading by ranges."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if not rest or scheme == "file":
        return fs.LocalFileSystem().open_input_file("/" + (rest or path).lstrip("/"))
    store, name = fs.FileSystem.from_uri(f"{ARROW_SCHEMES.get(scheme, scheme)}:{rest}")
    return store.open_input_file(name)


def row_groups(spark: SparkSession, path: str) -> DataFrame:
    """path, shard, row_group, start (the position in its file of its first row) and n_rows of every row group.

    A file that has no footer fails, with its name in the error. A file without rows has no row group.
    """

    def footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import parquet

        for batch in batches:
            found = []
            for name in batch["path"]:
                with opened(name) as file:
                    try:
                        meta = parquet.read_metadata(file)
                    except pa.ArrowInvalid as e:
                        raise ValueError(f"no parquet file: {name}") from e
                start = 0
                for group in range(meta.num_row_groups):
                    rows = meta.row_group(group).num_rows
                    found.append((name, name.rsplit("/", 1)[-1], group, start, rows))
                    start += rows
            yield pd.DataFrame(found, columns=["path", "shard", "row_group", "start", "n_rows"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path")
    schema = "path string, shard string, row_group bigint, start bigint, n_rows bigint"
    return files.mapInPandas(footers, schema).filter("n_rows > 0")


def epoch_plan(spark: SparkSession, path: str, size: int = DOCS_PER_BATCH) -> DataFrame:
    """The row groups in the order of an epoch (shard, row group): ``position`` from 0, and the number in its shard of the
    first batch of each. Store it with the corpus: a stream keeps to the plan it began with.
    """
    groups = row_groups(spark, path).withColumn("batches", F.ceil(F.col("n_rows") / size))
    per_file = groups.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("row_group", "batches"))).alias("all"))
    before = F.aggregate(F.filter("all", lambda g: g.row_group < F.col("row_group")), F.lit(0).cast("bigint"), lambda n, g: n + g.batches)
    groups = groups.join(per_file, "path").withColumn("first_batch", before).drop("all", "batches")
    return order_rows(stage(groups, "groups"), [], ["shard", "row_group", "path"]).scan(position=number(0)).rows()


def read_groups(groups: DataFrame, text: str = "text", size: int = DOCS_PER_BATCH) -> DataFrame:
    """Rows of (epoch, path, shard, row_group, start, first_batch): epoch, path, shard, row_group, batch, row_index and text.

    A task holds a few batches of one row group at a time and reads no other column.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import parquet

        for path, groups in groupby((g for batch in batches for g in batch.to_pylist()), key=lambda g: g["path"]):
            with opened(path) as file:
                shard = parquet.ParquetFile(file)  # its footer, which grows with the file, is read once
                for group in groups:
                    at = 0
                    for part in shard.iter_batches(size, row_groups=[group["row_group"]], columns=[text]):
                        n = len(part)
                        rows = pa.array(range(at, at + n), pa.int64())
                        same = lambda name: pa.repeat(pa.scalar(group[name], pa.string() if name in ("path", "shard") else pa.int64()), n)  # noqa: B023, E731
                        numbers = [group["first_batch"] + r // size for r in range(at, at + n)]
                        where = pa.array([group["start"] + r for r in range(at, at + n)], pa.int64())
                        columns = [same("epoch"), same("path"), same("shard"), same("row_group"), pa.array(numbers, pa.int64()), where, part.column(0).cast(pa.string())]
                        yield pa.record_batch(columns, names=["epoch", "path", "shard", "row_group", "batch", "row_index", "text"])
                        at += len(rows)

    schema = "epoch bigint, path string, shard string, row_group bigint, batch bigint, row_index bigint, text string"
    return groups.select("epoch", "path", "shard", "row_group", "start", "first_batch").mapInArrow(read, schema)


def endless_epochs(spark: SparkSession, plan: DataFrame, groups_per_batch: int, text: str = "text", size: int = DOCS_PER_BATCH) -> DataFrame:
    """A stream that goes through the row groups of a stored ``epoch_plan`` again and again; it never ends by itself.

    Its source counts row groups. The count is the offset that a checkpoint stores, so a stream that is started again goes
    on with the next row group of the same epoch; a repeated micro-batch holds the same rows. A micro-batch is
    ``groups_per_batch`` row groups, read by a few tasks for each core; a task reads a file's footer once for all that it
    reads of it. Epochs are numbered from 1.
    """
    total = plan.count()
    if not total:
        raise ValueError("a plan without row groups has no epochs")
    tasks = min(groups_per_batch, TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", groups_per_batch).option("numPartitions", tasks).load()
    at = F.col("value")
    wanted = ticks.select((F.floor(at / total) + 1).cast("bigint").alias("epoch"), (at % total).alias("position"))
    return read_groups(wanted.join(plan, "position"), text, size)

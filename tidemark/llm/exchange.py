"""Exchanging arrays between blocks of rows and buckets of keys.

A block sends its keys to buckets and gets answers in the order that it sent them in. What Spark shuffles are a few rows
with compressed arrays in place of one row per key.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tidemark.llm.worker_memory import frugal, give_back
from tidemark.plans.staging import staged_path


def packed(x: np.ndarray) -> bytes:
    """An array as compressed bytes, whole numbers in the narrowest type that holds them."""
    if x.dtype.kind in "iu":
        top = int(x.max()) if len(x) else 0
        x = x.astype(next(t for t in ("u1", "u2", "u4", "u8") if top <= np.iinfo(t).max))
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.dtype.itemsize).T)
    return x.dtype.str.encode() + zstandard.ZstdCompressor(level=1).compress(planes)


def array(data: bytes, kind: str = "i8") -> np.ndarray:
    """What ``packed`` made bytes of, as ``kind``."""
    stored = np.dtype(data[:3].decode())
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[3:]), np.uint8)
    return np.ascontiguousarray(planes.reshape(stored.itemsize, -1).T).view(stored).reshape(-1).astype(kind)


def stage_arrays(df: DataFrame, name: str) -> DataFrame:
    """A written table of compressed arrays.

    Shuffles are kept until the driver's garbage collector finds that nothing refers to them; it has no reason to run
    while executors fill their disks, so it is asked to after each written table.
    """
    spark = df.sparkSession
    path = staged_path(spark, name)
    df.write.option("compression", "none").parquet(path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def ascending(x: np.ndarray) -> bytes:
    """Numbers that never fall, as compressed differences."""
    return packed(np.diff(x, prepend=0))


def distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, from 0 on, in rising order, and where each key is among them.

    A key and its place are sorted as one number, if they fit in one: that is several times as fast as sorting places by key.
    """
    bits = len(key).bit_length()
    if not len(key) or int(key.max()) >> (63 - bits):
        return np.unique(key, return_inverse=True)
    both = key << bits
    both |= np.arange(len(key))
    both.sort()
    place = both & ((1 << bits) - 1)
    both >>= bits
    new = np.concatenate([[True], both[1:] != both[:-1]])
    inverse = np.empty(len(key), np.int64)
    inverse[place] = np.cumsum(new) - 1
    return both[new], inverse


def divided(key: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, positions) of the keys, by bucket; positions keep their order."""
    bucket = (key % np.asarray(buckets, key.dtype)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        if len(part):
            yield int(bucket[part[0]]), part


def per_row(df: DataFrame, make, schema: str) -> DataFrame:
    """``make`` turns a row into rows, one row at a time."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(batch.num_rows):
                for found in make({n: c[i].as_py() for n, c in zip(batch.schema.names, batch.columns)}):
                    yield pa.RecordBatch.from_pylist([dict(zip(names, found))], schema=wanted)

    import pyspark.sql.pandas.types as arrow
    from pyspark.sql.types import _parse_datatype_string

    wanted = arrow.to_arrow_schema(_parse_datatype_string(schema))
    return df.mapInArrow(frugal(run), schema)


def per_group(df: DataFrame, key: str, make, schema: str) -> DataFrame:
    """``make`` turns the rows of a group, as a list of dicts, into rows."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(name: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        give_back()  # of the group before
        return pd.DataFrame(list(make(name[0], rows.to_dict("records"))), columns=names)

    return df.groupBy(key).applyInPandas(run, schema)

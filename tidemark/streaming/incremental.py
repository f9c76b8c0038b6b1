"""Streams that copy what is new."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def new_files(spark: SparkSession, folder: str, schema: str, pattern: str = "*.parquet", per_batch: int | None = None) -> DataFrame:
    """A stream of the parquet entries of a folder, files or folders of part files; each file is read once per checkpoint."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.parquet(f"{folder}/{pattern}")


def ingest_once(source: DataFrame, out: str, progress: str) -> None:
    """Copy what is new in the source to a table; files already taken are skipped on later runs."""
    query = (
        source.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()

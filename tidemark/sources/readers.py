"""Readers of files: text shards, listings, JSON records, result files, logs and metrics documents."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas


def text_shards(spark: SparkSession, path: str, text: str = "text") -> DataFrame:
    """One column of parquet shards with the file and row each text came from. Order is in those columns."""
    return spark.read.parquet(path).select(
        F.col("_metadata.file_name").alias("shard"), F.col("_metadata.row_index").alias("row_index"), F.col(text).alias("text")
    )


def spread(rows: DataFrame, split_bytes: int = 128 * 1024 * 1024) -> DataFrame:
    """Rows of a small input over all cores, for work that costs much per row; a large input stays where it is.

    A few small files make fewer tasks than there are cores. Only then are the rows shuffled.
    """
    spark = rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    files = rows.inputFiles()
    if not files or len(files) >= cores:
        return rows
    size = spark.read.format("binaryFile").load(files).agg(F.sum("length")).head()[0]
    return rows.repartition(cores) if size < cores * split_bytes else rows


def entries(spark: SparkSession, folder: str, pattern: str) -> tuple[list[str], Column]:
    """The path that names a folder's entries of ``pattern``, none when there are none, and the name of a row's entry.

    An entry is a file, or a folder of part files, as Spark writes a table; the row may come from any file in it.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    root = files.makeQualified(root)
    glob = spark._jvm.org.apache.hadoop.fs.Path(root, pattern)
    place = F.regexp_replace("_metadata.file_path", "^[^/]+:(//[^/]*)?", "")  # without scheme and host
    below = F.substring(place, len(root.toUri().getRawPath().rstrip("/")) + 2, 2**31 - 1)
    name = F.replace(F.substring_index(below, "/", 1), F.lit("+"), F.lit("%2B"))  # decoding takes a plus for a blank
    return [glob.toString()] if files.globStatus(glob) else [], F.url_decode(name)


def list_files(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """Entries of a folder by name and size, a table of part files by the size of these; their content is not read."""
    paths, name = entries(spark, folder, pattern)
    if not paths:
        return spark.createDataFrame([], "file_name string, path string, length bigint")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    files = files.select(name.alias("file_name"), "path", "length").filter("file_name NOT LIKE '%.tmp'")
    path = F.min(F.expr("left(path, length(path) - length(substring_index(path, concat('/', file_name), -1)))"))
    return files.groupBy("file_name").agg(path.alias("path"), F.sum("length").alias("length")).orderBy("file_name")


def folder_size(spark: SparkSession, folder: str) -> DataFrame:
    """Total size in MiB and number of all files under a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("length")
    return files.agg((F.sum("length") / F.lit(1024 * 1024)).alias("total_mb"), F.count(F.lit(1)).alias("n_files"))


def checked_shards(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """Row count of each parquet entry of a folder, a file or a folder of part files, by a scan that reads no column.

    A file that cannot be read fails the scan, with its name in the error.
    """
    listed = list_files(spark, folder, pattern).select("file_name")
    paths, name = entries(spark, folder, pattern)
    if not paths:
        return listed.withColumn("n_rows", F.lit(0).cast("bigint"))
    rows = spark.read.schema("_no_such_column string").option("recursiveFileLookup", True).parquet(*paths)
    counts = rows.groupBy(name.alias("file_name")).agg(F.count(F.lit(1)).alias("n_rows"))
    return listed.join(counts, "file_name", "left").select("file_name", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def in_row_groups(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``row_group`` of each row of ``text_shards``, and its position there as ``group_row``, by the ``row_groups`` of the shards."""
    starts = groups.groupBy("shard").agg(F.array_sort(F.collect_list("start")).alias("starts"))  # of one file each
    out = rows.join(starts, "shard")
    group = F.size(F.filter("starts", lambda s: s <= F.col("row_index"))) - 1
    out = out.withColumn("row_group", group)
    return out.withColumn("group_row", F.col("row_index") - F.get("starts", F.col("row_group"))).drop("starts")


def first_existing(spark: SparkSession, candidates: Iterable[str]) -> str:
    """The first path that exists on its own file system."""
    tried = []
    for path in candidates:
        tried.append(path)
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
            return path
    raise FileNotFoundError(f"none of these exists: {tried}")


def text_parts(spark: SparkSession, path: str, conv_id: int | None = None, folders: int = 64) -> DataFrame:
    """Written parts of texts (conv_id, part, start, text); those of one conversation are read from its folder only."""
    rows = spark.read.parquet(path)
    if conv_id is not None:
        wanted = F.lit(conv_id).cast(rows.schema["conv_id"].dataType)
        rows = rows.filter((F.col("conv_id") == wanted) & (F.col("folder") == F.pmod(F.xxhash64(wanted), F.lit(folders))))
    return rows.select("conv_id", "part", "start", "text")


def json_records(spark: SparkSession, path: str, schema: str | T.StructType, multi_line: bool = False) -> DataFrame:
    """JSON records. ``multi_line`` reads files that hold one array each; such a file is read by one task."""
    return spark.read.schema(schema).option("multiLine", multi_line).option("mode", "PERMISSIVE").json(path)


def table_of(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """A table from rows the driver holds, such as a price list."""
    return spark.createDataFrame(rows, schema)


def result_files(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """Tab-separated result files with a header, all columns as text until they are coerced."""
    schema = schema or schemas.RESULT_TEXT
    return spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", "").csv(path)


def indexed_result_file(spark: SparkSession, path: str) -> DataFrame:
    """One result file with the position of each row as ``idx``; the file is small and read as one partition."""
    rows = result_files(spark, path).coalesce(1)
    return rows.withColumn("idx", F.monotonically_increasing_id())


def metrics_documents(spark: SparkSession, path: str) -> DataFrame:
    """Metrics documents of a sweep, one file per run; the run's folder is ``run_folder``."""
    docs = spark.read.schema(schemas.METRICS).option("multiLine", True).json(path)
    return docs.withColumn("run_folder", F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+$", 1))


def run_documents(spark: SparkSession, path: str) -> DataFrame:
    """The last saved document of each ``run`` as a variant, whatever its keys; null where it is no JSON."""
    rows = spark.read.schema("run string, document string, save bigint").parquet(path)
    last = rows.groupBy("run").agg(F.max_by("document", "save").alias("document"))
    return last.select("run", F.try_parse_json("document").alias("document"))


def document_value(path: str, kind: str) -> Column:
    """A value of ``document`` by its path, null where it is missing or of another kind."""
    return F.try_variant_get("document", path, kind)


def metrics_lines(spark: SparkSession, path: str) -> DataFrame:
    """Metrics documents of a sweep gathered in files of one document per line."""
    return spark.read.schema(schemas.METRICS).json(path)


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Log lines with their file and a number that rises within each file."""
    return spark.read.text(path).select(
        F.regexp_extract("_metadata.file_path", r"([^/]+?)(\.log)?$", 1).alias("slug"),
        F.monotonically_increasing_id().alias("line_no"),
        F.col("value").alias("line"),
    )

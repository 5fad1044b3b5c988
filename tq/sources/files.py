"""File sources and sinks.

* Raw CSV: header row, quoted fields with embedded newlines, RFC-4180 doubled
  quotes, every column read as text (no schema inference, on purpose: type
  problems must stay visible).  A gzip file with multi-line records cannot be
  split, so it is read by one task: ``stage_raw`` converts it once to Parquet,
  spread over ``partitions`` files if asked to, and every later step reads that.
* Parquet for tables, JSON for small reports, CSV for the profile.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from tq.session import scratch_path

CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}


def text_schema(columns) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_raw_csv(spark: SparkSession, path: str, columns=None) -> DataFrame:
    """All-text read of a raw CSV (optionally with the column names known up front)."""
    reader = spark.read.options(**CSV_OPTIONS)
    if columns:
        reader = reader.schema(text_schema(columns))
    return reader.csv(path)


def write_raw_csv(df: DataFrame, path: str, compression: str = "gzip", mode: str = "overwrite") -> None:
    """Write text columns as a raw CSV (blanks inside values are kept, not trimmed by the writer)."""
    (df.write.mode(mode).options(**CSV_OPTIONS)
     .option("compression", compression)
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .csv(path))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def stage_raw(spark: SparkSession, csv_path: str, parquet_path: str, partitions: int | None = None,
              columns=None) -> DataFrame:
    """CSV -> Parquet once, then continue from the Parquet copy.

    ``partitions``: spread the rows over so many files first, for an input of few splits (one gzip file is
    one).  As many input files or more are written as they are read, without a shuffle.
    """
    raw = read_raw_csv(spark, csv_path, columns)
    few = partitions and len(raw.inputFiles()) < partitions
    write_parquet(raw.repartition(partitions) if few else raw, parquet_path)
    return spark.read.schema(raw.schema).parquet(parquet_path)


def stage_new(spark: SparkSession, csv_folder: str, parquet_path: str, checkpoint: str, columns,
              files_per_batch: int | None = None) -> DataFrame:
    """Stages only the raw CSV files of a folder that no earlier call has taken, then reads the whole Parquet copy.

    The checkpoint (shared storage) holds the log of files taken; the Parquet sink commits each batch of files
    as a whole, so a call that broke off is repeated without losing or doubling a row. ``columns``: names of
    the text columns, in the order of the files.
    """
    reader = spark.readStream.options(**CSV_OPTIONS).schema(text_schema(columns))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (reader.csv(csv_folder).writeStream.format("parquet").option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start(parquet_path))
    query.awaitTermination()
    return spark.read.schema(text_schema(columns)).parquet(parquet_path)


def read_partitioned(spark: SparkSession, path: str, flag: str = "quarantined",
                     schema: StructType | None = None) -> DataFrame:
    """Read a table written with ``partitionBy(flag)``; the flag comes back as BOOLEAN.

    ``schema``: that of the written rows; with it a table without rows, which has no file, can be read too.
    """
    from pyspark.sql import functions as F

    df = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    # partition discovery types ``true``/``false`` folder values as text
    return df.withColumn(flag, F.col(flag).cast("boolean")) if flag in df.columns else df


def write_schema(spark: SparkSession, schema: StructType, path: str) -> None:
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_schema(spark: SparkSession, path: str) -> StructType:
    return StructType.fromJson(json.loads(spark.read.text(path).first()[0]))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Small report (metrics, validation, recall) as JSON lines."""
    df.coalesce(1).write.mode(mode).json(path)


def write_profile_csv(profile: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Profile report: most missing first, then schema order."""
    from pyspark.sql import functions as F

    # one row per column: sorted inside a single partition (no range-partitioning sample job)
    (profile.coalesce(1).sortWithinPartitions(F.desc("missing_pct"), F.asc("ordinal"))
     .write.mode(mode).option("header", "true").csv(path))


def fresh_scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared scratch area (one per call)."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in its own file system (local, HDFS, object store, ...)."""
    fs, folder = _file_system(spark, path)
    return fs.exists(folder)


def remove(spark: SparkSession, path: str) -> None:
    fs, folder = _file_system(spark, path)
    fs.delete(folder, True)

"""Reading and writing datasets: JSON lines at the edges, Parquet between."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_jsonl(spark: SparkSession, path: str | list[str], schema: str, strict: bool = True) -> DataFrame:
    """Blank lines are skipped; a line that isn't JSON fails the read, or is dropped if not strict."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """By the path's ending: .parquet, .orc, .csv, else JSON lines (which need the schema)."""
    for kind in ("parquet", "orc"):
        if path.rstrip("/").endswith(f".{kind}"):
            return spark.read.format(kind).load(path)
    if path.rstrip("/").endswith(".csv"):
        return spark.read.schema(schema).option("header", True).csv(path)
    return read_jsonl(spark, path, schema)


def stream_jsonl(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """New files of a folder as a stream."""
    return spark.readStream.schema(schema).json(folder)


def write_jsonl(df: DataFrame, path: str) -> None:
    """Overwrites; nulls are written, text isn't escaped."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_table(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite").parquet(path) if path.rstrip("/").endswith(".parquet") else write_jsonl(df, path))


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def append_new(df: DataFrame, path: str, key: str, schema: str, skip_done: bool = True) -> None:
    """Appends rows; with skip_done only those whose key isn't there, so that a job can be taken up again without doubles."""
    if skip_done and exists(df.sparkSession, path):
        df = df.join(read_table(df.sparkSession, path, schema).select(key), key, "left_anti")
    append(df, path)


def append(df: DataFrame, path: str) -> None:
    rows = df.write.mode("append")
    rows.parquet(path) if path.rstrip("/").endswith(".parquet") else rows.option("ignoreNullFields", "false").json(path)


def dealt(df: DataFrame, key: str) -> DataFrame:
    """df by its key in twice as many partitions as cores, or more.

    For work on texts: all rows of a row group, which may be the whole file, are read by one task, however many pieces Spark cuts the file into.
    The number is fixed, since adaptive execution would lessen it by bytes.
    """
    spark = df.sparkSession
    return df.repartition(max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), key)


def keep_last(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row a key: the last in order, as where rows are read into a dictionary."""
    return df.groupBy(key).agg(F.max_by(F.struct(*df.columns), order).alias("row")).select("row.*")


def require(df: DataFrame, missing: DataFrame, say: Callable[[str], str], key: str) -> DataFrame:
    """df, unless ``missing`` has a row: then reading the result raises, and names one key."""
    text = missing.agg(F.min(key).alias("lost")).select(F.when(F.col("lost").isNotNull(), F.raise_error(F.concat(F.lit(say("")), F.col("lost")))).cast("string").alias("lost"))
    return df.join(F.broadcast(text), F.col("lost").isNull()).drop("lost")


def shared_folder(spark: SparkSession) -> str:
    """A new folder in spark.checkpoint.dir, which driver and executors share.

    Raises where that is unset on a cluster, as executors would each write to a disk of their own. A session on this machine alone may
    go without: it gets a folder of the machine. What is written stays until the run that owns spark.checkpoint.dir removes it, since results are read lazily.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tessera-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder: made once, read by all.

    For rows that a plan uses several times; what is lost with an executor is read again, not made again.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, key: str, name: str, width: int = 3) -> DataFrame:
    """df with the rank of its distinct texts ``key``, from 1: within bins of their first characters, with the sizes of the bins before, so no task orders them all."""
    df = df.withColumn("bin_", F.substring(key, 1, width))
    before = Window.orderBy("bin_").rowsBetween(Window.unboundedPreceding, -1)
    bins = df.groupBy("bin_").count().select("bin_", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before_"))
    rank = F.row_number().over(Window.partitionBy("bin_").orderBy(key))
    return df.withColumn("rank_", rank).join(F.broadcast(bins), "bin_").withColumn(name, F.col("rank_") + F.col("before_")).drop("bin_", "rank_", "before_")

"""What the operators share: reading, sizing, row keys and word rules.

Row keys. A row of documents is known by ``rid`` (its ``doc_id``; null counts as the smallest long) and by ``th``,
the 64-bit hash of its text, so repeated rows share a key and rows with one id but different texts are told apart
and ordered in the same way on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import shared_folder  # noqa: F401

#: Words of the contracts: runs of anything but space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
NO_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """(rid, th, text) of a table of documents, whatever else it holds. A null text is empty."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("rid"), F.xxhash64(text).alias("th"), text.alias("text"))


def id_of(rid: Column) -> Column:
    return F.when(rid != F.lit(NO_ID), rid).alias("doc_id")


def input_bytes(df: DataFrame) -> int:
    """Bytes that the plan reads, by Catalyst's statistics: for tables in files, the bytes of the files. No job runs.

    Leaves of unknown size (rows made in the program) count as nothing; sizes that joins are thought to have don't enter.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(x for x in sizes if x < 2**60)


def pieces(df: DataFrame, each_mb: float = 8.0, most: int = 10_000_000) -> int:
    """How many pieces of about each_mb of input: grows with the input (80 TB at 8 MB), and is at least the session's shuffle partitions."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(most, round(input_bytes(df) / (each_mb * 1e6))))


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z alone."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: Keys of rows wanted from a table are broadcast up to so many (some 40 bytes each), counted first; beyond, they are joined by a shuffle.
MOST_BROADCAST = 500_000


def little(table: DataFrame) -> DataFrame:
    """A table of keys, for a join: to be broadcast if it has few rows."""
    return F.broadcast(table) if table.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else table


#: Spark's own limit, by the bytes of a batch between an executor's JVM and a Python worker; and what it is here, where it isn't set.
BATCH_LIMIT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def small_batches(spark: SparkSession) -> None:
    """From here on the session's Arrow batches end at BATCH_BYTES (a longer row is a batch of its own), unless the session has a limit of its own.

    By Spark's default they end at 64 MB or 10,000 rows, and the JVM, its buffers to Python and the worker each hold one for each task; of these
    much is never given back. The limit is read when a plan runs, so it has to stay in the session. No result depends on it.
    """
    if spark.conf.get(BATCH_LIMIT, None) is None:
        spark.conf.set(BATCH_LIMIT, str(BATCH_BYTES))


#: Short rows (keys and labels, some 24 bytes each) that a file of an intermediate table holds at least, where their number is known.
FILE_ROWS = 1 << 17


def written(df: DataFrame, path: str, rows: int | None = None) -> DataFrame:
    """df as a table at path: it is made once, and what is lost with an executor is read again.

    rows: about how many short rows it has at most, where that is known: it then has a file for each FILE_ROWS of them and no more, not one for each
    shuffle partition, however small. Without native libraries, Hadoop starts processes for each file that it makes in a local folder.
    """
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // FILE_ROWS)))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

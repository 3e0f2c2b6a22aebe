"""The stages that look at one row at a time run on a stream as they are; results are appended to a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import collect, signals
from ..sources import schemas
from ..sources.tables import stream_jsonl


def candidates(spark: SparkSession, folder: str, split: str = "train") -> DataFrame:
    """Candidates of raw problems that arrive as JSON lines in a folder."""
    return signals.candidates(collect.problems(stream_jsonl(spark, folder, schemas.RAW_PROBLEM), split))


def code_signals(spark: SparkSession, folder: str) -> DataFrame:
    """Signals of solutions that arrive as JSON lines in a folder."""
    return signals.solution_signals(stream_jsonl(spark, folder, schemas.SOLUTION))


def append(df: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """To Parquet, exactly once by the sink's log; once: what is there now, then it ends."""
    out = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if once else out).start(path)

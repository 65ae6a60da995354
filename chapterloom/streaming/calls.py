"""The call log over time: cost sums by windows of event time while calls are still written.

A call counts once, however often its record is delivered, as long as the copies come within ``delay`` of each other; state
is kept for ``delay`` only. Each batch writes the windows that it changed to a folder of its own, over what it wrote before if it is
delivered again; the newest row of a window is its sum.

Defined results: equal to cost_windows() over the distinct calls that weren't late. A call is late, and counted nowhere, when its time lies more than
``delay`` before the latest time of the batches before its own; Spark's progress reports tell how many those were
(numRowsDroppedByWatermark). Records without a time or an id are left out. Of copies in one batch any counts; they are alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chapterloom.operators.costs import cost_windows

RECORD = "ts timestamp, call_id string, tag string, model string, cache_read_tokens long, cost_usd double"
_SUMS = "start timestamp, tag string, model string, calls long, hits long, cost_usd double, batch long"


def read_log(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The stream of records of a log that append_log() writes, with a call_id."""
    reader = spark.readStream.schema(RECORD).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss")
    return (reader if files_per_trigger is None else reader.option("maxFilesPerTrigger", files_per_trigger)).json(path)


def log_costs(log: DataFrame, path: str, checkpoint: str, every: str = "1 day", delay: str = "1 day") -> StreamingQuery:
    calls = log.where("ts is not null and call_id is not null").withWatermark("ts", delay).dropDuplicatesWithinWatermark(["call_id"])

    def step(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{path}/part={number}")

    sums = cost_windows(calls, every)
    return sums.writeStream.outputMode("update").foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windows_so_far(spark: SparkSession, path: str) -> DataFrame:
    """(start, tag, model, calls, hits, cost_usd): each window's newest sums."""
    rows = spark.read.schema(_SUMS).parquet(path)
    newest = rows.groupBy("start", "tag", "model").agg(F.max_by(F.struct("calls", "hits", "cost_usd"), "batch").alias("s"))
    return newest.select("start", "tag", "model", "s.*")

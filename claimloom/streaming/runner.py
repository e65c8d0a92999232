"""Running streams: sinks with checkpoints in the shared folder, several outputs per batch."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimloom.functions.exact import ratio
from claimloom.sources import scratch


def stream_session(spark: SparkSession) -> SparkSession:
    """A session for streams. The number of state partitions is fixed for the life of a checkpoint
    and adaptive execution does not change it, so it follows the cores and not the batch default;
    state lives in RocksDB, outside the heap."""
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", str(max(2, spark.sparkContext.defaultParallelism)))
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    session.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    return session


def start_sink(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    *,
    partition_by: tuple[str, ...] = (),
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append sink on parquet files: exactly once through the sink's own log. ``every`` sets a
    trigger interval; without it the stream takes what is available and stops."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def run_sink(stream: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> tuple[str, StreamingQuery]:
    """Drain the stream into a new folder and return it."""
    spark = stream.sparkSession
    path = scratch.fresh(spark, label)
    query = start_sink(stream, f"{path}/data", f"{path}/checkpoint", partition_by=partition_by)
    query.awaitTermination()
    return f"{path}/data", query


BatchStep = Callable[[DataFrame, int], None]


def run_batches(stream: DataFrame, step: BatchStep, checkpoint: str, every: str | None = None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    query = writer.start()
    if every is None:
        query.awaitTermination()
    return query


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """A batch's own folder, replaced when the batch is run again."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def batch_metrics(df: DataFrame, batch_id: int, stream_name: str, run_id: str, as_of: Column) -> DataFrame:
    """Events, late events and delay of one micro-batch; an empty batch gives zeros and a null."""
    return df.agg(
        F.count("*").alias("event_count"),
        F.count_if("is_late_event").alias("late_events"),
        F.count_if(~F.col("is_valid")).alias("rejected_events"),
        ratio(F.sum("processing_delay_seconds"), F.count("processing_delay_seconds")).alias(
            "avg_processing_delay"
        ),
    ).select(
        F.lit(batch_id).cast("long").alias("batch_no"),
        F.lit(stream_name).alias("stream_name"),
        F.lit(run_id).alias("pipeline_run_id"),
        "*",
        as_of.alias("batch_timestamp"),
    )


def outputs(sinks: Mapping[str, Callable[[DataFrame, int], DataFrame]], root: str) -> BatchStep:
    """One micro-batch into several tables. The batch is kept while the sinks read it, so that the
    source is read once."""

    def step(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, build in sinks.items():
                write_batch(build(batch, batch_id), f"{root}/{name}", batch_id)
        finally:
            batch.unpersist()

    return step


def read_sink(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)

"""Status events, as a stream or as a batch: the same functions serve both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom import schemas
from claimloom.config import Settings
from claimloom.functions import fields as x
from claimloom.functions.exact import ratio

REQUIRED = ("event_id", "claim_id", "claim_line_id", "event_type", "new_status", "event_timestamp")

# Event categories by the prefix of the event type.
CATEGORIES = (("STATUS", "status"), ("PROVIDER", "provider_change"), ("PAYMENT", "payment"), ("AUDIT", "audit"))


def read_stream(spark: SparkSession, path: str, schema, *, form: str = "json", files_per_trigger: int = 1000, pattern: str | None = None) -> DataFrame:
    """File source with a declared schema and a limit per micro-batch."""
    reader = spark.readStream.format(form).schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def kafka_stream(spark: SparkSession, servers: str, topic: str, per_trigger: int = 1000) -> DataFrame:
    """Message-bus source; needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .option("maxOffsetsPerTrigger", per_trigger)
        .load()
        .select(
            F.col("value").alias("body"),
            F.col("timestamp").alias("enqueued_time"),
            F.col("partition").alias("partition_id"),
            "offset",
        )
    )


def parse(messages: DataFrame, body: str = "body") -> DataFrame:
    """Event fields of a JSON message beside its transport columns. A body that is no JSON object
    yields null fields, which validation rejects."""
    event = F.from_json(F.col(body).cast("string"), schemas.schema("claim_status_events", streaming=True))
    rest = [c for c in messages.columns if c != body]
    return messages.select(event.alias("__e"), *rest).select("__e.*", *rest)


def payload(events: DataFrame, column: str = "additional_data") -> DataFrame:
    parsed = F.from_json(column, schemas.PAYLOAD)
    return events.withColumn("__p", parsed).select(*events.columns, "__p.*")


def is_valid(cfg: Settings, arrival: Column) -> Column:
    ok = F.col("event_type") == cfg.event_type
    for name in REQUIRED:
        ok = ok & F.col(name).isNotNull()
    ok = ok & F.col("new_status").isin(*cfg.statuses)
    limit = arrival + F.expr(f"INTERVAL {cfg.future_seconds} SECONDS")
    return F.coalesce(ok & (F.col("event_timestamp") <= limit), F.lit(False))


def flag_events(events: DataFrame, cfg: Settings, arrival: Column | None = None) -> DataFrame:
    """Adds ``is_valid``; rejected events stay in the stream and go to a sink of their own."""
    at = F.current_timestamp() if arrival is None else arrival
    return events.withColumn("is_valid", is_valid(cfg, at))


def derive_events(events: DataFrame, cfg: Settings, arrival: Column) -> DataFrame:
    """Delay against the arrival time, lateness, date, hour and record hash."""
    delay = x.seconds_between(F.col("event_timestamp"), arrival)
    stamp = F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    hashed = [F.col(c) for c in ("event_id", "claim_id", "claim_line_id", "event_type", "new_status")]
    return events.withColumns(
        {
            "processing_delay_seconds": delay,
            "is_late_event": delay > cfg.late_seconds,
            "event_date": F.to_date("event_timestamp"),
            "event_hour": F.hour("event_timestamp"),
            "record_hash": x.record_hash([*hashed, stamp]),
        }
    )


def within_limit(derived: DataFrame, cfg: Settings) -> DataFrame:
    """Events that are not later than ``drop_seconds``; the others are too late to be applied."""
    return derived.filter(F.col("processing_delay_seconds") <= cfg.drop_seconds)


def deduplicate(events: DataFrame, cfg: Settings, key: str = "event_id") -> DataFrame:
    """One event per id within the watermark; state older than the watermark is dropped."""
    return events.withWatermark("event_timestamp", cfg.watermark).dropDuplicatesWithinWatermark([key])


def categorise(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    label = x.ladder(((kind.startswith(p), name) for p, name in CATEGORIES), F.lit("other"))
    return events.withColumn("category", label)


def enrich(events: DataFrame, reference: DataFrame, on: str, key: str) -> DataFrame:
    """Stream-static left join; the reference is unique on ``key``."""
    right = reference.withColumnRenamed(key, "__key")
    return events.join(right, F.col(on) == F.col("__key"), "left").drop("__key")


def hourly_counts(events: DataFrame) -> DataFrame:
    """Tumbling one-hour counts per status. Needs a watermark in append mode."""
    return (
        events.groupBy(F.window("event_timestamp", "1 hour"), "new_status")
        .agg(F.count("*").alias("event_count"))
        .select(
            F.to_date("window.start").alias("event_date"),
            F.hour("window.start").alias("event_hour"),
            "new_status",
            "event_count",
        )
    )


def delay_statistics(events: DataFrame) -> DataFrame:
    delay = F.col("processing_delay_seconds")
    return events.agg(
        F.count("*").alias("event_count"),
        F.avg(delay).alias("avg_delay"),
        F.max(delay).alias("max_delay"),
        F.min(delay).alias("min_delay"),
        ratio(F.count_if("is_late_event"), F.count("*")).alias("late_share"),
    )

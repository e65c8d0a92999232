"""Queries T: the status-event stream, drained over the given events and read back."""

from pyspark.sql import functions as F

from claimloom.operators import audit, marts
from claimloom.functions.exact import money_sum
from claimloom.plans.history import LATEST
from claimloom.plans.model import Tables
from claimloom.plans.registry import query
from claimloom.plans.sqltext import EVENTS_AS_OF, n_if, ratio, usd
from claimloom.sources import files, scratch, tables
from claimloom.streaming import events as ev
from claimloom.streaming import merge, monitor, runner


def stream(t: Tables):
    """The given events as a stream of status events."""
    session = runner.stream_session(t.spark)
    schema = t.table("events").schema
    raw = ev.read_stream(session, t.folder, schema, form="parquet", pattern="events.parquet")
    return t.events(raw)


def _land(t: Tables, events, path: str) -> None:
    stamp = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    lines = events.withColumns({c: F.date_format(c, stamp) for c in ("event_timestamp", "arrival")})
    lines.write.mode("append").json(path)


def landed(t: Tables, files_per_trigger: int = 1):
    """The given events as JSON files, as many as the scan has tasks; a file per micro-batch."""
    path = scratch.fresh(t.spark, "event-files")
    _land(t, t.events(), path)
    return ev.read_stream(runner.stream_session(t.spark), path, t.events().schema, files_per_trigger=files_per_trigger)


def drained(t: Tables, df, label: str, partition_by=()):
    path, _ = runner.run_sink(df, label, partition_by)
    return runner.read_sink(t.spark, path)


def valid(t: Tables, df):
    return ev.flag_events(df, t.cfg, F.col("arrival")).filter("is_valid").drop("is_valid")


_EVENT = """event_id, claim_id, claim_line_id, event_type, old_status, new_status, denial_reason, event_timestamp,
    source_system"""
EVENT = [c.strip() for c in _EVENT.replace("\n", " ").split(",")]
_DELAY = "CAST(floor(epoch(arrival)) - floor(epoch(event_timestamp)) AS BIGINT)"


@query("t01_event_source", f"SELECT {_EVENT}, arrival FROM status_source")
def _(t):
    return drained(t, landed(t).select(*EVENT, "arrival"), "source")


@query("t02_parse_messages", f"SELECT {_EVENT}, CAST(event_id AS VARCHAR) AS message_key FROM status_source")
def _(t):
    source = stream(t)
    body = F.to_json(F.struct(*[F.col(c) for c in EVENT]), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    messages = source.select(body.cast("binary").alias("body"), F.col("event_id").alias("message_key"))
    return drained(t, ev.parse(messages).drop("additional_data"), "parsed")


_VALID = "event_type = 'STATUS_UPDATE' AND new_status IS NOT NULL"


@query("t03_valid_events", f"SELECT {_EVENT} FROM status_source WHERE {_VALID}")
def _(t):
    return drained(t, valid(t, stream(t)).select(*EVENT), "valid")


@query("t03_rejected_events", f"SELECT {_EVENT} FROM status_source WHERE NOT ({_VALID})")
def _(t):
    flagged = ev.flag_events(stream(t), t.cfg, F.col("arrival"))
    return drained(t, flagged.filter(~F.col("is_valid")).select(*EVENT), "rejected")


@query(
    "t04_derived_events",
    f"""SELECT event_id, {_DELAY} AS processing_delay_seconds, {_DELAY} > 300 AS is_late_event,
        CAST(event_timestamp AS DATE) AS event_date, CAST(hour(event_timestamp) AS INTEGER) AS event_hour,
        md5(concat_ws('|', event_id, claim_id, claim_line_id, event_type, new_status,
        strftime(event_timestamp, '%Y-%m-%d %H:%M:%S.%f'))) AS record_hash FROM status_events""",
)
def _(t):
    derived = ev.derive_events(valid(t, stream(t)), t.cfg, F.col("arrival"))
    columns = "event_id processing_delay_seconds is_late_event event_date event_hour record_hash".split()
    return drained(t, derived.select(*columns), "derived")


@query("t05_watermark", f"SELECT {_EVENT} FROM status_events")
def _(t):
    marked = valid(t, stream(t)).withWatermark("event_timestamp", t.cfg.watermark)
    return drained(t, marked.select(*EVENT), "marked")


@query("t05_late_limit", f"SELECT event_id FROM status_events WHERE {_DELAY} <= 3600")
def _(t):
    derived = ev.derive_events(valid(t, stream(t)), t.cfg, F.col("arrival"))
    return drained(t, ev.within_limit(derived, t.cfg).select("event_id"), "in-time")


@query("t06_deduplicated", f"SELECT {_EVENT} FROM status_events")
def _(t):
    twice = valid(t, stream(t)).select(*EVENT, F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"))
    return drained(t, ev.deduplicate(twice, t.cfg).drop("copy"), "unique")


@query(
    "t07_partitioned_sink",
    f"SELECT {_EVENT}, CAST(event_timestamp AS DATE) AS event_date, CAST(hour(event_timestamp) AS INTEGER) AS event_hour FROM status_events",
)
def _(t):
    derived = ev.derive_events(valid(t, stream(t)), t.cfg, F.col("arrival"))
    return drained(t, derived.select(*EVENT, "event_date", "event_hour"), "by-hour", ("event_date", "event_hour"))


def metrics(t: Tables):
    """Metrics of every micro-batch, one row per batch."""
    flagged = ev.flag_events(landed(t), t.cfg, F.col("arrival"))
    derived = ev.derive_events(flagged, t.cfg, F.col("arrival"))
    root = scratch.fresh(t.spark, "metrics")

    def step(batch, batch_id):
        rows = runner.batch_metrics(
            batch, batch_id, "claim_status_events", "run-1", F.lit("2024-01-31 00:00:00").cast("timestamp")
        )
        runner.write_batch(rows, f"{root}/metrics", batch_id)

    runner.run_batches(derived, step, f"{root}/checkpoint")
    return t.spark.read.parquet(f"{root}/metrics")


@query(
    "t08_batch_metrics",
    f"""SELECT COUNT(*) AS event_count, {n_if(f'{_DELAY} > 300')} AS late_events,
        {n_if(f'NOT ({_VALID})')} AS rejected_events, CAST(sum({_DELAY}) AS BIGINT) AS total_delay FROM status_source""",
)
def _(t):
    columns = ["event_count", "late_events", "rejected_events"]
    delay = F.round(F.col("avg_processing_delay") * F.col("event_count")).cast("long")  # whole seconds again
    return metrics(t).agg(*[F.sum(c).alias(c) for c in columns], F.sum(delay).alias("total_delay"))


def routed(t: Tables, sinks: dict) -> str:
    """Runs the stream into several tables; returns their folder."""
    derived = ev.derive_events(ev.categorise(landed(t)), t.cfg, F.col("arrival"))
    root = scratch.fresh(t.spark, "routed")
    runner.run_batches(derived, runner.outputs(sinks, root), f"{root}/checkpoint")
    return root


@query(
    "t09_late_events",
    f"""SELECT event_id, 'late' AS sink FROM status_source WHERE {_DELAY} > 300
        UNION ALL SELECT event_id, 'on_time' FROM status_source WHERE NOT {_DELAY} > 300""",
)
def _(t):
    sinks = {
        "late": lambda b, _: b.filter("is_late_event").select("event_id"),
        "on_time": lambda b, _: b.filter("NOT is_late_event").select("event_id"),
    }
    root = routed(t, sinks)
    tables_read = [t.spark.read.parquet(f"{root}/{n}").select("event_id", F.lit(n).alias("sink")) for n in sinks]
    return tables_read[0].unionByName(tables_read[1])


STEPS = 4
CURRENT = "claim_id claim_line_id claim_amount claim_status service_date submission_date denial_reason".split()


def status_store(t: Tables) -> merge.StatusTable:
    """Status table after the stream, applied by micro-batch."""
    store = merge.StatusTable(scratch.fresh(t.spark, "status"), "service_month")
    store.create(t.unique_claims(CURRENT).withColumn("service_month", F.trunc("service_date", "MM")))
    first, last = t.events().agg(F.min("event_timestamp"), F.max("event_timestamp")).first()
    path = scratch.fresh(t.spark, "event-files")
    for k in range(STEPS if first else 0):  # files come in by time, a micro-batch each time
        a, b = (first + (last - first) * x / STEPS for x in (k, k + 1))
        at = F.col("event_timestamp")
        later = at <= F.lit(b) if k == STEPS - 1 else at < F.lit(b)
        _land(t, t.events().filter((at >= F.lit(a)) & later), path)
        events = ev.read_stream(runner.stream_session(t.spark), path, t.events().schema)
        runner.run_batches(valid(t, events).select(*EVENT), store.apply, f"{store.path}/checkpoint")
    return store


# Events of known claims in order; one applies where it changes the status that the event before left.
_APPLIED = """WITH e AS (SELECT s.*, c.claim_status AS first_status, c.denial_reason AS first_reason,
        lag(new_status) OVER w AS before, row_number() OVER w AS place
        FROM status_events s JOIN unique_claims c ON c.claim_id = s.claim_id AND c.claim_line_id = s.claim_line_id
        WINDOW w AS (PARTITION BY s.claim_id, s.claim_line_id ORDER BY s.event_timestamp, s.event_id)),
    a AS (SELECT * FROM e
        WHERE new_status IS DISTINCT FROM CASE WHEN place = 1 THEN first_status ELSE before END)"""


@query(
    "t10_streaming_merge",
    _APPLIED
    + """, l AS (SELECT * FROM a
        QUALIFY row_number() OVER (PARTITION BY claim_id, claim_line_id ORDER BY event_timestamp DESC, event_id DESC) = 1)
    SELECT c.claim_id, c.claim_line_id, claim_amount, coalesce(l.new_status, claim_status) AS claim_status,
        CASE WHEN l.claim_id IS NULL THEN c.denial_reason ELSE l.denial_reason END AS denial_reason,
        l.event_timestamp AS status_update_timestamp
        FROM unique_claims c LEFT JOIN l ON l.claim_id = c.claim_id AND l.claim_line_id = c.claim_line_id""",
)
def _(t):
    columns = "claim_id claim_line_id claim_amount claim_status denial_reason status_update_timestamp"
    return status_store(t).current(t.spark).select(*columns.split())


@query(
    "t10_streaming_history",
    _APPLIED
    + """, v AS (SELECT *, lag(denial_reason) OVER w AS reason, lag(new_status) OVER w AS status, lag(event_timestamp) OVER w AS since,
        row_number() OVER w AS version FROM a
        WINDOW w AS (PARTITION BY claim_id, claim_line_id ORDER BY event_timestamp, event_id))
    SELECT claim_id, claim_line_id, CASE WHEN version = 1 THEN first_status ELSE status END AS claim_status,
        CASE WHEN version = 1 THEN first_reason ELSE reason END AS denial_reason, since AS status_update_timestamp,
        event_timestamp AS history_effective_end_date, event_id AS history_event_id FROM v""",
)
def _(t):
    columns = "claim_id claim_line_id claim_status denial_reason status_update_timestamp"
    ends = ["history_effective_end_date", "history_event_id"]
    return status_store(t).history(t.spark, [*columns.split(), *ends])


@query(
    "t11_hourly_counts",
    """SELECT CAST(event_timestamp AS DATE) AS event_date, CAST(hour(event_timestamp) AS INTEGER) AS event_hour,
        new_status, COUNT(*) AS event_count FROM status_events
        WHERE date_trunc('hour', event_timestamp) + INTERVAL 1 HOUR
        <= (SELECT max(event_timestamp) - INTERVAL 5 MINUTE FROM status_events) GROUP BY 1, 2, 3""",
)
def _(t):
    marked = valid(t, stream(t)).withWatermark("event_timestamp", t.cfg.watermark)
    return drained(t, ev.hourly_counts(marked), "hourly")


@query(
    "t11_status_counts",
    "SELECT new_status, COUNT(*) AS row_count FROM status_events GROUP BY new_status",
)
def _(t):
    rows = drained(t, valid(t, stream(t)).select("new_status"), "statuses")
    return marts.distribution(rows, "new_status")


@query(
    "t12_delay_statistics",
    f"""SELECT COUNT(*) AS event_count, avg({_DELAY}) AS avg_delay, max({_DELAY}) AS max_delay,
        min({_DELAY}) AS min_delay, {ratio(n_if(f'{_DELAY} > 300'), 'COUNT(*)')} AS late_share FROM status_events""",
)
def _(t):
    derived = ev.derive_events(valid(t, stream(t)), t.cfg, F.col("arrival"))
    rows = drained(t, derived.select("processing_delay_seconds", "is_late_event"), "delays")
    return ev.delay_statistics(rows)


@query("t13_progress_monitor", "SELECT 'events' AS stream_name, COUNT(*) AS input_rows FROM events")
def _(t):
    path = scratch.fresh(t.spark, "reports")
    source = stream(t).select("event_id")
    listener = monitor.ProgressWriter(t.spark, path)
    source.sparkSession.streams.addListener(listener)
    try:
        runner.run_sink(source, "progress")
        if not listener.ended.wait(120):  # reports come in order, the end last
            raise TimeoutError("the stream's reports did not all arrive")
    finally:
        source.sparkSession.streams.removeListener(listener)
    rows = t.spark.read.schema(monitor.PROGRESS).parquet(path)
    return rows.groupBy(F.lit("events").alias("stream_name")).agg(F.sum("input_rows").alias("input_rows"))


@query(
    "t14_stream_alerts",
    f"""WITH d AS (SELECT CAST(event_timestamp AS DATE) AS event_date, COUNT(*) AS n, {n_if(f'NOT ({_VALID})')} AS r,
        {n_if(f'{_DELAY} > 300')} AS late, avg({_DELAY}) AS delay FROM status_source GROUP BY 1)
        SELECT CAST(event_date - DATE '2024-01-01' AS BIGINT) AS batch_id, 'daily' AS stream_name, unnest(
        list_filter([CASE WHEN delay > 120 THEN 'latency' END, CASE WHEN CAST(r AS DOUBLE) / n > 0.01 THEN 'error_rate' END,
        CASE WHEN n > 10000 THEN 'backlog' END, CASE WHEN n / CAST(3.4 AS DOUBLE) < 100 THEN 'slow' END,
        CASE WHEN CAST(late AS DOUBLE) / n > 0.05 THEN 'late_events' END], lambda x: x IS NOT NULL)) AS alert FROM d""",
)
def _(t):
    derived = ev.derive_events(ev.flag_events(t.events(), t.cfg, F.col("arrival")), t.cfg, F.col("arrival"))
    daily = derived.groupBy("event_date").agg(
        F.count("*").alias("event_count"),
        F.count_if(~F.col("is_valid")).alias("rejected_events"),
        F.count_if("is_late_event").alias("late_events"),
        F.avg("processing_delay_seconds").alias("avg_processing_delay"),
        F.count("*").alias("backlog_events"),
        (F.count("*") / 3.4).alias("events_per_second"),
    )
    numbered = daily.withColumns(
        {
            "batch_id": F.datediff("event_date", F.lit("2024-01-01").cast("date")).cast("long"),
            "stream_name": F.lit("daily"),
        }
    )
    return audit.stream_alerts(numbered)


STALLED = f"""SELECT * FROM stream_monitoring WHERE last_event_time < {EVENTS_AS_OF} - INTERVAL 30 MINUTE
    OR NOT is_active"""


@query("t15_stalled_streams", STALLED)
def _(t):
    return audit.stalled_streams(t.stream_monitoring(), t.events_as_of, t.cfg)


_MONTH = "CAST(date_trunc('month', service_date) AS DATE)"


@query(
    "t16_incremental_refresh",
    f"""WITH m AS (SELECT c.*, l.new_status FROM unique_claims c LEFT JOIN ({LATEST}) l
            ON l.claim_id = c.claim_id AND l.claim_line_id = c.claim_line_id)
        SELECT {_MONTH} AS service_month_start, coalesce(new_status, claim_status) AS claim_status,
        COUNT(*) AS total_claims, {usd('claim_amount')} AS total_amount FROM m GROUP BY 1, 2""",
)
def _(t):
    path, month = scratch.fresh(t.spark, "monthly"), "service_month_start"
    store = merge.StatusTable(scratch.fresh(t.spark, "status"), month)
    store.create(t.unique_claims(CURRENT).withColumn(month, F.trunc("service_date", "MM")))

    def refresh(claims):
        rows = claims.groupBy(month, "claim_status").agg(
            F.count("*").alias("total_claims"), money_sum("claim_amount").alias("total_amount")
        )
        tables.overwrite_partitions(rows, path, [month])

    refresh(store.current(t.spark))
    touched = store.apply(t.status_events(), 0)
    refresh(changed_months(store.current(t.spark), month, touched))
    return t.spark.read.parquet(path)


def changed_months(current, month, touched):
    """The claims of some months: a filter on the partition column, so other months are not read."""
    return current.filter(F.col(month).isin(touched))


@query(
    "t17_routed_events",
    """SELECT event_id, CASE WHEN event_type LIKE 'STATUS%' THEN 'status' WHEN event_type LIKE 'PROVIDER%'
        THEN 'provider_change' WHEN event_type LIKE 'PAYMENT%' THEN 'payment' ELSE 'audit' END AS category
        FROM status_source""",
)
def _(t):
    names = [name for _, name in ev.CATEGORIES]

    def only(name):
        return lambda batch, _: batch.filter(F.col("category") == name).select("event_id")

    root = routed(t, {name: only(name) for name in names})
    out = None
    for name in names:
        rows = t.spark.read.parquet(f"{root}/{name}").select("event_id", F.lit(name).alias("category"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "t18_enriched_events",
    """SELECT event_id, new_status, c_name AS member_name, c_mktsegment AS plan_id FROM status_events
        LEFT JOIN customer ON 'C' || c_custkey = claim_id""",
)
def _(t):
    events = valid(t, stream(t)).select("event_id", "claim_id", "new_status")
    customers = events.sparkSession.read.parquet(f"{t.folder}/customer.parquet").select(
        F.concat(F.lit("C"), "c_custkey").alias("key"),
        F.col("c_name").alias("member_name"),
        F.col("c_mktsegment").alias("plan_id"),
    )
    return drained(t, ev.enrich(events, customers, "claim_id", "key").drop("claim_id"), "enriched")

"""Structured Streaming queries (survey 2.9). Each call feeds the events
table as time-ordered drops, runs the stream to completion with
``availableNow`` (one drop per micro-batch) and returns the sink as a batch
DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.operators.relational import broadcast_if_bounded
from tabflow.queries.registry import query, tbl
from tabflow.schemas import DRIVER
from tabflow.session import shared_path
from tabflow.streaming.files import (drop_number, event_time, file_stream, once_in_time, run_counting_late, run_to_parquet,
                                     run_to_state, wall_clock, write_drops)
from tabflow.streaming.sink import run_keyed

N_DROPS = 6
EVENTS = DRIVER["events"]


def _feed(spark, sf, predicate=None, folder=None, n=N_DROPS):
    """Write the events as ``n`` time-ordered drops; returns (folder, files per drop)."""
    folder = folder or shared_path(spark, "events-drops")
    ev = tbl(spark, sf, "events")
    if predicate is not None:
        ev = ev.filter(predicate)
    return folder, write_drops(ev, folder, n, order_col="ts")


def totals() -> list:
    """Count and sums; money is summed as a decimal, exact in any order of the micro-batches."""
    value = F.col("value").cast("decimal(28,2)")
    return [F.count(F.lit(1)).alias("n_events"), F.sum(value).alias("total_value"),
            F.sum(F.when(F.col("event_type") == "purchase", value)).alias("purchase_value")]


def finished(agg: DataFrame, *keys: str, purchases: bool = False) -> DataFrame:
    """The columns shown of groups of ``totals()``, in a stream and in a batch alike."""
    total = F.col("total_value").cast("double")
    more = [F.col("purchase_value").cast("double").alias("purchase_value"), (total / F.col("n_events")).alias("mean_value")]
    return agg.select(*keys, "n_events", total.alias("total_value"), *more * purchases)


def segment_totals(stream: DataFrame, customers: DataFrame) -> DataFrame:
    """Shared batch/stream transform: events joined to a static customer
    lookup, then running count and value per market segment."""
    return finished(stream.join(customers, stream.user_id == customers.c_custkey, "left")
                    .groupBy("c_mktsegment").agg(*totals()), "c_mktsegment")


def event_totals(stream: DataFrame) -> DataFrame:
    """Count, two sums and the mean per event type, for streams and batches."""
    return finished(stream.groupBy("event_type").agg(*totals()), "event_type", purchases=True)


@query("stream_static_join_agg", "D11 T1 T2 T3 T4 T8", sql="""
SELECT c.c_mktsegment, count(*) AS n_events, round(sum(e.value), 2) AS total_value
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey GROUP BY c.c_mktsegment
""")
def stream_static_join_agg(spark, sf):
    folder, per_drop = _feed(spark, sf)
    customers, _ = broadcast_if_bounded(tbl(spark, sf, "customer").select("c_custkey", "c_mktsegment"))
    agg = segment_totals(file_stream(spark, folder, EVENTS, per_drop), customers)
    return run_keyed(agg, shared_path(spark, "sink"), shared_path(spark, "ckpt"))


@query("stream_filter_append", "T5", sql="""
SELECT event_id, ts, user_id, value FROM events WHERE event_type = 'purchase' AND value > 10
""")
def stream_filter_append(spark, sf):
    """Stateless filter + projection in append mode into a Parquet sink."""
    folder, per_drop = _feed(spark, sf)
    s = (file_stream(spark, folder, EVENTS, per_drop)
         .filter((F.col("event_type") == "purchase") & (F.col("value") > 10))
         .select("event_id", "ts", "user_id", "value"))
    out = shared_path(spark, "stream-out")
    run_to_parquet(s, out, shared_path(spark, "ckpt"))
    return spark.read.schema(s.schema).parquet(out)


EVENT_TOTALS_SQL = """
SELECT event_type, count(*) AS n_events, round(sum(value), 2) AS total_value,
  round(sum(value) FILTER (event_type = 'purchase'), 2) AS purchase_value, round(sum(value), 2) / count(*) AS mean_value
FROM events GROUP BY event_type
"""


@query("stream_update_counts", "T5", sql="""
SELECT event_type, count(*) AS n_events, round(sum(value), 2) AS total_value FROM events GROUP BY event_type
""")
def stream_update_counts(spark, sf):
    """Update mode emits only the groups changed by each micro-batch; the final value of
    every group is in the stream's state. (Spark takes update mode from no sink written in
    Python, so the epoch sink serves complete mode only.)"""
    folder, per_drop = _feed(spark, sf)
    s = file_stream(spark, folder, EVENTS, per_drop).groupBy("event_type").agg(*totals()[:2])
    state = run_to_state(s, shared_path(spark, "ckpt"), "update")
    return state.select(F.col("key.event_type").alias("event_type"), F.col("value.count").alias("n_events"),
                        F.col("value.sum").cast("double").alias("total_value"))


@query("stream_resume", "T2 T3 T6", sql=EVENT_TOTALS_SQL)
def stream_resume(spark, sf):
    """Stop after the first half of the drops, restart from the checkpoint with the rest:
    the complete-mode sink holds every group once, and the totals equal the batch
    result (state, offsets and epochs kept)."""
    folder, sink, ckpt = (shared_path(spark, name) for name in ("events-drops", "sink", "ckpt"))
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    early = F.coalesce(F.col("ts") < cut, F.lit(True))  # rows without a time go first

    def run(part):
        _, per_drop = _feed(spark, sf, part, folder, n=3)
        return run_keyed(event_totals(file_stream(spark, folder, EVENTS, per_drop)), sink, ckpt)

    run(early)
    return run(~early)


WATERMARK_SQL = """
WITH w AS (
  SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type, count(*) AS n_events,
         round(sum(value), 2) AS total_value
  FROM events GROUP BY 1, 2)
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, event_type, n_events, total_value
FROM w
WHERE window_start + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
"""


@query("stream_tumbling_watermark", "T7", sql=WATERMARK_SQL)
def stream_tumbling_watermark(spark, sf):
    """1-day tumbling windows with a 1-hour watermark in append mode: a window
    is written once the watermark passes its end, late rows are dropped."""
    folder, per_drop = _feed(spark, sf)
    s = (file_stream(spark, folder, EVENTS, per_drop).withColumn("event_ts", event_time("ts"))
         .withWatermark("event_ts", "1 hour")
         .groupBy(F.window("event_ts", "1 day"), "event_type")
         .agg(*totals()).withColumn("total_value", F.col("total_value").cast("double"))
         .select(wall_clock("window.start").alias("window_start"),
                 wall_clock("window.end").alias("window_end"),
                 "event_type", "n_events", "total_value"))
    out = shared_path(spark, "stream-out")
    run_to_parquet(s, out, shared_path(spark, "ckpt"))
    return spark.read.schema(s.schema).parquet(out)


@query("stream_progress", "T2 T3", sql=f"""
WITH k AS (SELECT epoch_us(ts) AS t, (SELECT epoch_us(min(ts)) FROM events) AS lo, (SELECT epoch_us(max(ts)) FROM events) AS hi FROM events),
b AS (SELECT CAST(coalesce(least(floor((t - lo) * {float(N_DROPS)} / CAST(hi - lo AS DOUBLE)), {N_DROPS - 1}), 0) AS BIGINT) AS batch_id FROM k),
n AS (SELECT batch_id, count(*) AS rows_in_batch FROM b GROUP BY batch_id)
SELECT batch_id, rows_in_batch,
       CAST(sum(rows_in_batch) OVER (ORDER BY batch_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_rows FROM n
""")
def stream_progress(spark, sf):
    """Rows read per micro-batch and the running total after each one: each row is
    written with the number of its drop's micro-batch by an append stream over the
    drop files, so the totals are of the sink's rows, however many batches ran."""
    from pyspark.sql import Window

    folder, per_drop = _feed(spark, sf)
    out, ckpt = shared_path(spark, "stream-out"), shared_path(spark, "ckpt")
    s = file_stream(spark, folder, EVENTS, per_drop).select(F.col("_metadata.file_name").alias("drop_file"))
    run_to_parquet(s, out, ckpt)
    rows = spark.read.schema(s.schema).parquet(out).groupBy("drop_file").agg(F.count(F.lit(1)).alias("rows_in_batch"))
    # the stream takes files by modification time, ``per_drop`` of them for each batch
    files = spark.read.parquet(folder).select(F.col("_metadata.file_name").alias("drop_file"),
                                              F.col("_metadata.file_modification_time").alias("at")).distinct()
    no = F.row_number().over(Window.orderBy("at", "drop_file")) - 1  # one row per drop file
    batch = files.select("drop_file", F.floor(no / per_drop).cast("long").alias("batch_id"))
    per_batch = rows.join(batch, "drop_file").groupBy("batch_id").agg(F.sum("rows_in_batch").alias("rows_in_batch"))
    w = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_batch.withColumn("running_rows", F.sum("rows_in_batch").over(w))


# an event in ten comes two drops after its time, one in seven of the others comes again in the next drop
_LATE_SQL = f"""
WITH k AS (SELECT *, epoch_us(ts) AS t, (SELECT epoch_us(min(ts)) FROM events) AS lo, (SELECT epoch_us(max(ts)) FROM events) AS hi FROM events),
d AS (SELECT *, CAST(coalesce(least(floor((t - lo) * {float(N_DROPS)} / CAST(hi - lo AS DOUBLE)), {N_DROPS - 1}), 0) AS INTEGER) AS d0 FROM k),
a AS (SELECT *, CASE WHEN event_id % 10 = 3 THEN least(d0 + 2, {N_DROPS - 1}) ELSE d0 END AS drop_no FROM d),
kept AS (SELECT *, coalesce(date_trunc('milliseconds', max(ts) OVER (ORDER BY drop_no RANGE BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING))
                            - INTERVAL 1 HOUR >= ts, false) AS is_late FROM a)
"""


def _late_feed(spark, sf) -> tuple[DataFrame, str]:
    """The events as a stream whose drops hold late and repeated rows; returns (stream, checkpoint)."""
    ev = tbl(spark, sf, "events")
    micros = F.unix_micros(event_time("ts"))
    lo, hi = ev.agg(F.min(micros), F.max(micros)).first()
    no, late = drop_number(micros, lo or 0, hi or 0, N_DROPS), F.col("event_id") % 10 == 3
    again = F.when((F.col("event_id") % 7 == 0) & ~late & (no < N_DROPS - 1), F.array(no, no + 1)).otherwise(
        F.array(F.when(late, F.least(no + 2, F.lit(N_DROPS - 1))).otherwise(no)))
    folder = shared_path(spark, "late-drops")
    per_drop = write_drops(ev.withColumn("arrives", F.explode(again)), folder, N_DROPS, number=F.col("arrives"))
    return file_stream(spark, folder, EVENTS, per_drop), shared_path(spark, "ckpt")


def sessions(stream: DataFrame, gap: str = "6 hours") -> DataFrame:
    """Each user's sessions (events at most ``gap`` apart), written once the watermark passes their end."""
    return (once_in_time(stream, ["event_id"], "ts", "1 hour").groupBy(F.session_window("event_ts", gap), "user_id").agg(*totals()[:2])
            .select("user_id", wall_clock("session_window.start").alias("session_start"), wall_clock("session_window.end").alias("session_end"),
                    "n_events", F.col("total_value").cast("double").alias("total_value")))


@query("stream_sessions", "T7 T5", sql=_LATE_SQL + """,
g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 6 HOURS THEN 0 ELSE 1 END AS opens
      FROM kept WHERE NOT is_late WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
n AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session_no FROM g),
s AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOURS AS session_end, count(*) AS n_events,
             CAST(sum(CAST(value AS DECIMAL(28,2))) AS DOUBLE) AS total_value FROM n GROUP BY user_id, session_no)
SELECT * FROM s WHERE session_end <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM events)
""")
def stream_sessions(spark, sf):
    """Sessions of a feed that repeats rows and sends some late: gaps decide the windows, which merge as rows come."""
    stream, ckpt = _late_feed(spark, sf)
    s, out = sessions(stream), shared_path(spark, "stream-out")
    run_to_parquet(s, out, ckpt)
    return spark.read.schema(s.schema).parquet(out)


@query("stream_late_rows", "T7 T8 A8", sql=_LATE_SQL + """
SELECT event_type, count(*) FILTER (NOT is_late) AS n_kept, CAST((SELECT count(*) FROM kept WHERE is_late) AS BIGINT) AS late_in_all
FROM kept GROUP BY event_type HAVING count(*) FILTER (NOT is_late) > 0
""")
def stream_late_rows(spark, sf):
    """Rows kept by type, each once though the feed repeats it, and how many came too late (counted by Spark)."""
    stream, ckpt = _late_feed(spark, sf)
    s, out = once_in_time(stream, ["event_id"], "ts", "1 hour").select("event_id", "event_type"), shared_path(spark, "stream-out")
    late = run_counting_late(s, out, ckpt)
    kept = spark.read.schema(s.schema).parquet(out)
    return kept.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_kept")).withColumn("late_in_all", F.lit(late).cast("bigint"))

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.queries.streams import event_totals, segment_totals
from tabflow.schemas import DRIVER
from tabflow.session import shared_path
from tabflow.sources.tables import table
from tabflow.streaming.files import event_time, file_stream, once_in_time, run_counting_late, run_to_parquet, wall_clock, write_drops
from tabflow.streaming.sink import EpochWriter, RowsFile, read_epoch, run_keyed

EVENTS = DRIVER["events"]


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_batch_stream_parity(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    ev = table(spark, sf, "events")
    batch = segment_totals(ev, customers)
    folder = shared_path(spark, "t-drops")
    write_drops(ev, folder, 4, order_col="ts")
    stream = segment_totals(file_stream(spark, folder, EVENTS), customers)
    out = run_keyed(stream, shared_path(spark, "t-sink"), shared_path(spark, "t-ckpt"))
    assert out.schema.names == batch.schema.names and _rows(out) == _rows(batch)


def test_resume_from_checkpoint(spark, sf):
    ev = table(spark, sf, "events")
    folder, sink, ckpt = (shared_path(spark, n) for n in ("t-drops", "t-sink", "t-ckpt"))
    cut = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")

    def run():
        return run_keyed(event_totals(file_stream(spark, folder, EVENTS)), sink, ckpt)

    write_drops(ev.filter(F.col("ts") < cut), folder, 2, order_col="ts")
    assert _rows(run()) == _rows(event_totals(ev.filter(F.col("ts") < cut)))
    write_drops(ev.filter(F.col("ts") >= cut), folder, 2, order_col="ts")
    assert _rows(run()) == _rows(event_totals(ev))
    assert _rows(run()) == _rows(event_totals(ev))  # nothing new: nothing twice


def test_sink_counts_an_epoch_once(spark, tmp_path):
    """A batch that is written again replaces its own rows; rows that no epoch names, of a
    failed or aborted attempt, are not read."""
    import pyarrow as pa

    path = str(tmp_path / "sink")
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType())])
    writer = EpochWriter(path)

    def rows(*pairs):
        return writer.write(iter([pa.record_batch([pa.array([k for k, _ in pairs], pa.string()), pa.array([n for _, n in pairs], pa.int64())], ["k", "n"])]))

    writer.commit([], 0)
    assert read_epoch(spark, path, schema).count() == 0
    writer.commit([rows(("a", 1), (None, 5)), rows(("b", 1))], 1)
    assert _rows(read_epoch(spark, path, schema).fillna("-")) == [("-", 5), ("a", 1), ("b", 1)]
    rows(("a", 99))  # a task whose batch never committed
    writer.abort([rows(("b", 98)), RowsFile(None)], 2)
    writer.commit([rows(("a", 7))], 2)
    writer.commit([rows(("a", 2)), writer.write(iter([]))], 2)  # the same epoch again
    assert _rows(read_epoch(spark, path, schema)) == [("a", 2)]


def test_watermark_drops_late_rows(spark):
    """A row arriving after its window was emitted is dropped. Spark filters
    late rows with the watermark of the previous batch, so the late row comes
    in the third file, after the Jan 1 window was closed in batch 1."""
    def row(i, d, h):
        return (i, datetime(2024, 1, d, h), 1, "click", 1.0, "{}")
    files = [[row(1, 1, 10), row(2, 3, 12)], [row(3, 4, 12)], [row(4, 1, 11), row(5, 5, 12)]]
    folder = shared_path(spark, "t-late")
    for rows in files:
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(folder)
    s = (file_stream(spark, folder, EVENTS).withColumn("t", event_time("ts")).withWatermark("t", "1 hour")
         .groupBy(F.window("t", "1 day")).agg(F.count(F.lit(1)).alias("n"))
         .select(wall_clock("window.start").alias("start"), "n"))
    out_path = shared_path(spark, "t-late-out")
    run_to_parquet(s, out_path, shared_path(spark, "t-ckpt"))
    out = {r.start.day: r.n for r in spark.read.parquet(out_path).collect()}
    assert out[1] == 1  # the late 11:00 row of Jan 1 was dropped
    assert out[3] == 1 and out[4] == 1 and 5 not in out  # Jan 5 window still open at the end


def test_append_filter_stream(spark, sf):
    ev = table(spark, sf, "events")
    folder = shared_path(spark, "t-drops")
    write_drops(ev, folder, 3, order_col="ts")
    s = file_stream(spark, folder, EVENTS).filter(F.col("value") > 50).select("event_id")
    out = shared_path(spark, "t-out")
    batches = run_to_parquet(s, out, shared_path(spark, "t-ckpt"))
    assert batches >= 3
    assert _rows(spark.read.parquet(out)) == _rows(ev.filter(F.col("value") > 50).select("event_id"))


def test_stream_totals_grow_each_batch(spark, sf):
    import __spark_entry__ as entry
    rows = entry.queries()["stream_progress"](spark, sf).orderBy("batch_id").collect()
    assert len(rows) == 6
    running = [r.running_rows for r in rows]
    assert running == sorted(running) and running[-1] == table(spark, sf, "events").count()


def test_multi_file_drops_keep_every_row_in_event_time_windows(spark, sf):
    ev = table(spark, sf, "events")
    folder = shared_path(spark, "t-multi")
    per_drop = write_drops(ev, folder, 4, order_col="ts", rows_per_file=50)
    assert per_drop > 1
    s = (file_stream(spark, folder, EVENTS, per_drop).withColumn("t", event_time("ts"))
         .withWatermark("t", "1 hour").groupBy(F.window("t", "1 day")).agg(F.count(F.lit(1)).alias("n"))
         .select(wall_clock("window.start").alias("start"), "n"))
    out = shared_path(spark, "t-multi-out")
    run_to_parquet(s, out, shared_path(spark, "t-ckpt"))
    got = {r.start: r.n for r in spark.read.parquet(out).collect()}
    batch = {r.start: r.n for r in ev.groupBy(F.date_trunc("day", "ts").alias("start")).count()
             .withColumnRenamed("count", "n").collect()}
    last = max(batch)
    assert got == {k: v for k, v in batch.items() if k != last}  # every closed day, no row dropped


def test_drops_keep_rows_without_an_order_value(spark, sf):
    ev = table(spark, sf, "events").withColumn("ts", F.when(F.col("event_id") % 5 != 0, F.col("ts")))
    for order in ("ts", "value", None):
        folder = shared_path(spark, "t-null-drops")
        write_drops(ev, folder, 4, order_col=order)
        back = spark.read.parquet(folder).select(ev.columns)
        assert back.exceptAll(ev).count() == 0 and back.count() == ev.count()


def _late_drops(spark):
    """Four drops: 2 comes again, 6 is a day late, 7 is late but within the delay, 8 has no time."""
    at = [(1, 1, 0), (2, 2, 0), (2, 2, 1), (3, 26, 1), (4, 50, 2), (5, 51, 3), (6, 3, 3), (7, 25, 3), (8, None, 3)]
    rows = [(i, None if h is None else datetime(2024, 1, 1 + h // 24, h % 24), 7, "view", 1.0, "{}", d) for i, h, d in at]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string, d int")
    folder = shared_path(spark, "t-late")
    write_drops(df, folder, 4, number=F.col("d"))
    return file_stream(spark, folder, EVENTS).drop("d")


def test_late_rows_are_counted_and_repeats_kept_once(spark):
    from tabflow.queries.streams import sessions

    out = shared_path(spark, "t-out")
    s = once_in_time(_late_drops(spark), ["event_id"], "ts", "2 hours").select("event_id")
    assert run_counting_late(s, out, shared_path(spark, "t-ckpt")) == 1
    assert _rows(spark.read.schema("event_id long").parquet(out)) == [(i,) for i in (1, 2, 3, 4, 5, 7, 8)]
    out = shared_path(spark, "t-out")
    s = sessions(_late_drops(spark), "5 hours")
    run_to_parquet(s, out, shared_path(spark, "t-ckpt"))
    day = [datetime(2024, 1, d, h) for d, h in ((1, 1), (1, 7), (2, 2), (2, 7))]
    assert _rows(spark.read.schema(s.schema).parquet(out)) == [(7, day[0], day[1], 2, 2.0), (7, day[2], day[3], 1, 1.0)]


def test_late_rows_are_not_guessed_when_reports_are_gone(spark):
    key = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(key)
    spark.conf.set(key, 2)
    try:
        s = once_in_time(_late_drops(spark), ["event_id"], "ts", "2 hours").select("event_id")
        with pytest.raises(RuntimeError, match="numRecentProgressUpdates"):
            run_counting_late(s, shared_path(spark, "t-out"), shared_path(spark, "t-ckpt"))
    finally:
        spark.conf.set(key, before)

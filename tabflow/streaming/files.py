"""Watched-folder streams.

A stream reads Parquet drop files from a folder with a declared schema
(file sources cannot infer one from an empty folder) and ``maxFilesPerTrigger``
files per micro-batch. Runs use ``availableNow`` so they process what is
there, in several micro-batches, and stop. Offsets and state live in a
checkpoint folder under the shared root, so a restarted query resumes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.session import shared_path


def drop_number(key, lo: int, hi: int, n: int):
    """Slice 0 to n - 1 of an integer key in equal widths of [lo, hi]; null is in the first."""
    if hi <= lo:
        return F.lit(0)
    return F.coalesce(F.least(F.floor((key - F.lit(lo)) * F.lit(float(n)) / F.lit(float(hi - lo))), F.lit(n - 1)), F.lit(0)).cast("int")


def write_drops(df: DataFrame, folder: str, n_files: int, order_col: str | None = None,
                rows_per_file: int = 4_000_000, number: Column | None = None) -> int:
    """Append ``df`` to ``folder`` as ``n_files`` drops, one write job each,
    and return the number of files per drop (read each drop as one
    micro-batch with ``maxFilesPerTrigger`` set to it).

    With ``order_col`` the drops are consecutive, equal-width slices of its
    range, written in order: the file source picks files by modification
    time, so event time advances drop by drop and no row is late by
    construction. Rows whose order value is null are in the first drop.
    Without ``order_col`` rows are spread over the drops by a hash of all
    columns. ``number`` (0 to ``n_files`` - 1, not null) deals the rows instead of either, for
    feeds whose rows come late. The input is read twice, for its range and to stage all drops at
    once; each drop then copies its own staged part. A drop is split into
    enough files of about ``rows_per_file`` rows that no task writes more.
    """
    key = None
    if order_col is not None:
        key = F.unix_micros(event_time(order_col)) if isinstance(
            df.schema[order_col].dataType, (T.TimestampType, T.TimestampNTZType)) else F.col(order_col)
    stats = df.agg(F.count(F.lit(1)).alias("n"),
                   *([F.min(key).alias("lo"), F.max(key).alias("hi")] if key is not None else [])).first()
    per_drop = max(1, -(-int(stats["n"]) // (n_files * rows_per_file)))
    if stats["n"] == 0:
        return per_drop
    if number is not None:
        pass
    elif key is None:
        number = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(n_files))
    else:
        number = drop_number(key, stats["lo"] or 0, stats["hi"] or 0, n_files)
    stage = shared_path(df.sparkSession, "drops")
    (df.withColumn("__drop", number.cast("int")).repartition(n_files * per_drop, "__drop", F.xxhash64(*df.columns))
     .write.partitionBy("__drop").parquet(stage))
    staged = df.sparkSession.read.schema(T.StructType([*df.schema.fields, T.StructField("__drop", T.IntegerType())])).parquet(stage)
    for i in range(n_files):
        part = staged.where(F.col("__drop") == i).drop("__drop")
        part = part.repartitionByRange(per_drop, order_col) if order_col and per_drop > 1 else part.repartition(per_drop)
        part.write.mode("append").parquet(folder)
    return per_drop


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, max_files: int = 1,
                glob: str | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(folder)


def run_to_parquet(df: DataFrame, out: str, checkpoint: str) -> int:
    """Append-mode stream into a Parquet folder (exactly-once file sink)."""
    q = (df.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out))
    q.awaitTermination()
    return batches_of(q)


def batches_of(q) -> int:
    """Micro-batches a query has run, from its last report (older ones are not kept)."""
    return int(q.lastProgress["batchId"]) + 1 if q.lastProgress else 0


def run_counting_late(df: DataFrame, out: str, checkpoint: str) -> int:
    """``run_to_parquet`` of a stream whose first stateful step is ``once_in_time``; returns the rows
    that this run dropped for coming behind the watermark, from the state operators' own metrics."""
    q = (df.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out))
    q.awaitTermination()
    reports = {p["batchId"]: p for p in q.recentProgress}
    if len(q.recentProgress) >= int(df.sparkSession.conf.get("spark.sql.streaming.numRecentProgressUpdates")) - 1:  # one less is kept
        raise RuntimeError("reports of batches are gone: raise spark.sql.streaming.numRecentProgressUpdates")
    return sum(int(o["numRowsDroppedByWatermark"]) for p in reports.values() for o in p["stateOperators"] if o["operatorName"] == "dedupe")


def once_in_time(stream: DataFrame, keys: list[str], ts: str, delay: str, out: str = "event_ts") -> DataFrame:
    """Each record (``keys`` and its time) once, though a feed sends it again. A record that comes more than
    ``delay`` behind the watermark is dropped, row by row, before any aggregate, so its number is exact
    (an aggregate counts its partial groups instead). Spark drops late rows by the watermark of the
    batch before. State is kept for ``delay`` only. Adds the instant ``out``; a record without a time has none."""
    return stream.withColumn(out, event_time(ts)).withWatermark(out, delay).dropDuplicates([*keys, out])


def run_to_state(df: DataFrame, checkpoint: str, mode: str = "update") -> DataFrame:
    """Run an update-mode aggregate to its end and read its result from
    the state store in the checkpoint: the groups stay on the executors and on
    shared storage, however many there are. Returns the raw state: ``key`` and
    ``value`` structs (the grouping columns and the aggregates' buffers)."""
    q = (df.writeStream.format("noop").outputMode(mode)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return df.sparkSession.read.format("statestore").load(checkpoint).select("key", "value")


def stream_job(spark: SparkSession, source: DataFrame, schema: T.StructType, n_files: int,
               transform: Callable[[DataFrame], DataFrame], order_col: str | None = None,
               max_files: int = 1) -> tuple[DataFrame, str]:
    """Feed ``source`` as drop files, return (transformed stream, checkpoint)."""
    folder = shared_path(spark, "stream-in")
    per_drop = write_drops(source, folder, n_files, order_col)
    stream = file_stream(spark, folder, schema, max_files * per_drop)
    return transform(stream), shared_path(spark, "stream-ckpt")


_EPOCH_NTZ = "1970-01-01 00:00:00"


def event_time(col: str = "ts"):
    """Streaming event time must be TIMESTAMP; Parquet gives TIMESTAMP_NTZ.
    The wall-clock value is read as UTC whatever the session time zone, so
    window boundaries fall on UTC midnights and results do not depend on it."""
    micros = F.timestamp_diff("MICROSECOND", F.lit(_EPOCH_NTZ).cast("timestamp_ntz"), F.col(col))
    return F.timestamp_micros(micros)


def wall_clock(col):
    """Inverse of ``event_time``: TIMESTAMP instant -> UTC wall clock (NTZ)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))

"""A streaming sink for complete-mode results, by epoch.

Tasks write their rows as Parquet files below ``rows``; the commit of a micro-batch names
them in ``epochs/<batch>.json``. A batch that runs again after a failure replaces its own
list, and files that no list names are never read, so each epoch counts once. The result is read
back as an ordinary table: nothing is held in the driver and no port is opened."""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage

# executors run these classes by value and need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "tabflow_epochs"


@dataclass
class RowsFile(WriterCommitMessage):
    name: str | None


class EpochWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def _folder(self):
        from pyarrow import fs

        bare = self.path.startswith("file:") and "://" not in self.path
        return fs.FileSystem.from_uri("file://" + self.path[5:] if bare else self.path)

    def write(self, iterator: Iterator) -> RowsFile:
        from pyarrow import parquet

        files, base = self._folder()
        writer, name = None, f"{uuid.uuid4().hex}.parquet"
        for batch in iterator:
            if not batch.num_rows:
                continue
            if writer is None:
                files.create_dir(f"{base}/rows", recursive=True)
                writer = parquet.ParquetWriter(f"{base}/rows/{name}", batch.schema, filesystem=files)
            writer.write_batch(batch)
        if writer is None:
            return RowsFile(None)
        writer.close()
        return RowsFile(name)

    def commit(self, messages, batchId: int) -> None:
        files, base = self._folder()
        for folder in ("rows", "epochs"):
            files.create_dir(f"{base}/{folder}", recursive=True)
        lines = [json.dumps({"epoch": batchId, "file": m.name}) for m in messages if m and m.name]
        lines.append(json.dumps({"epoch": batchId, "file": None}))  # an epoch without rows is one too
        staged, target = f"{base}/epochs/_{uuid.uuid4().hex}", f"{base}/epochs/{batchId}.json"
        with files.open_output_stream(staged) as out:
            out.write("\n".join(lines).encode())
        if files.get_file_info(target).type.name == "File":  # the batch ran before and was not acknowledged
            files.delete_file(target)
        files.move(staged, target)

    def abort(self, messages, batchId: int) -> None:
        files, base = self._folder()
        for m in messages:
            if m and m.name:
                files.delete_file(f"{base}/rows/{m.name}")


class EpochSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> EpochWriter:
        return EpochWriter(self.options["path"])


def run_keyed(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run an aggregating stream in complete mode over all that is there and return its
    result so far, one row per group. Run again with the same folders, it goes on where it
    stopped. (Spark accepts append and complete mode for sinks written in Python.)"""
    spark = df.sparkSession
    spark.dataSource.register(EpochSink)
    q = (df.writeStream.format(FORMAT).outputMode("complete").option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(path))
    q.awaitTermination()
    return read_epoch(spark, path, df.schema)


def read_epoch(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of the last epoch. Files that no epoch names are left out; without any
    epoch there are no rows."""
    epochs = spark.read.schema("epoch long, file string").json(f"{path}/epochs")
    last = epochs.agg(F.max("epoch")).first()[0]
    if last is None:
        return spark.createDataFrame([], schema)
    named = epochs.where((F.col("epoch") == last) & F.col("file").isNotNull()).select(F.col("file").alias("_file"))
    return spark.read.schema(schema).parquet(f"{path}/rows").select("*", F.col("_metadata.file_name").alias("_file")) \
        .join(named, "_file").drop("_file")

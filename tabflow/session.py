"""Session factory and shared scratch locations.

Cluster jobs must not write to machine-local temp folders. Everything that
has to land on storage (checkpoints, round-trip tables, stream drops) goes
below the shared folder named by ``spark.checkpoint.dir``. Only when that is
unset (unit tests, local runs) do we pick a local folder ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults chosen for the 100 TB target; local runs override the partition
# count. AQE coalesces small shuffle partitions and splits skewed ones at
# run time, so a generous static count is safe.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def get_session(
    app: str = "tabflow",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with UTC time, ANSI mode, AQE on, UI off."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if not (master or "").startswith("local"):
        # on a shared cluster coalesce towards the advisory size rather than
        # towards maximum parallelism (fewer, fuller tasks); local runs keep
        # Spark's default so small inputs still use every core
        settings["spark.sql.adaptive.coalescePartitions.parallelismFirst"] = "false"
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - conf lookup raises when unset
            configured = None
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # Local/test sessions only: no cluster folder was named.
        configured = tempfile.mkdtemp(prefix="tabflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tabflow/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint (never ``localCheckpoint``): survives executor loss."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=eager)


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 256 * 1024 * 1024,
                           lower: int = 8) -> int:
    """Shuffle partition count that keeps each partition near ``target_bytes``
    for a job reading ``input_bytes`` (AQE then merges the small ones)."""
    return int(max(lower, -(-input_bytes // target_bytes)))


def input_bytes(spark: SparkSession, paths) -> int:
    """Bytes of the files behind ``paths``, summed by Spark from file metadata
    (one row per file; no column data is read)."""
    from pyspark.sql import functions as F

    files = (spark.read.parquet(*([paths] if isinstance(paths, str) else list(paths)))
             .select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("s"))
             .groupBy("p").agg(F.max("s").alias("s")))
    return int(files.agg(F.sum("s")).first()[0] or 0)


def size_shuffles(spark: SparkSession, paths, target_bytes: int = 256 * 1024 * 1024) -> int:
    """Set ``spark.sql.shuffle.partitions`` from the size of the inputs."""
    n = shuffle_partitions_for(input_bytes(spark, paths), target_bytes)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n

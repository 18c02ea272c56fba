"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings that may be changed on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

#: State kept off the heap, with incremental checkpoints.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
}


def build_session(
    app_name: str = "sluicegate",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    time_zone: str = "UTC",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the jobs expect; ``master`` is left to spark-submit by default."""
    builder = SparkSession.builder.appName(app_name).config("spark.sql.session.timeZone", time_zone)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RUNTIME_SETTINGS, **STATE_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_state_backend(spark: SparkSession) -> None:
    """Switch streaming state of queries started from now on to RocksDB."""
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may leave it unset, as on a laptop or in tests: a temporary folder takes its place. On a
    cluster every executor would write to a disk of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="sluicegate-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a file or folder of any file system that Spark knows; False when there was none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True))


def publish(spark: SparkSession, written: str, path: str) -> None:
    """Give a finished folder its name in one step; where that name exists already, what was written is dropped."""
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (written, path))
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(target) or not files.rename(source, target):
        if not files.exists(target):
            raise OSError(f"{written} could not be renamed to {path}")
        files.delete(source, True)


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name below :func:`shared_dir`."""
    return f"{shared_dir(spark)}/sluicegate/{name}-{uuid.uuid4().hex}"

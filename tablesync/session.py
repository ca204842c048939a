"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Values that make sense at any size; cluster-specific sizes stay with the cluster.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


MB = 1024 * 1024


def sized_conf(input_bytes: int) -> dict[str, str]:
    """Partition counts for a given amount of input.

    Shuffles start with partitions of about 256 MB; the adaptive plan joins those that
    turn out small. Beyond 10 TB a scan task reads 512 MB, which keeps the number of
    tasks of one scan near 200,000 at 100 TB.
    """
    scan = 128 * MB if input_bytes < 10 * MB * MB else 512 * MB
    partitions = max(200, min(400_000, -(-input_bytes // (256 * MB))))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(scan),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * MB),
    }


def build_session(
    app: str = "tablesync", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with the engine settings, sized for the input if its bytes are given.

    `conf` overrides settings, with dots written as `__`.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = sized_conf(input_bytes) if input_bytes else {}
    settings = {**ENGINE_CONF, **sized, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def in_one_process(spark: SparkSession) -> bool:
    """Whether the driver runs all tasks itself. An unknown master may be a cluster, and `local-cluster` is one."""
    master = spark.conf.get("spark.master", "unknown")
    return master.startswith("local") and not master.startswith("local-cluster")


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can write to, as named in `spark.checkpoint.dir`.

    Only a local session may fall back to a folder of its own machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    # On a cluster, one machine's folder would be seen by it alone.
    if in_one_process(spark):
        folder = tempfile.mkdtemp(prefix="tablesync-")
        spark.conf.set("spark.tablesync.sharedRoot", folder)
        return folder
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def workspace(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; nothing is created until it is written."""
    known = spark.conf.get("spark.tablesync.sharedRoot", None)
    root = known or shared_root(spark)
    return f"{root}/tablesync/{purpose}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table, if it is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)

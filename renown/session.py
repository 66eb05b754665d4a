"""SparkSession helpers.

The library never creates folders on executor-local disks.  Lineage cuts
go to ``spark.checkpoint.dir`` (a shared folder on a cluster); only
a local master without that setting gets a scratch folder here.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "renown",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    Uses ``spark.checkpoint.dir`` from the session.  Where it is unset, a
    local master gets a fresh scratch folder and any other master an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="renown-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path below the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def materialize(df, name: str):
    """Cut lineage by writing ``df`` as Parquet below the shared checkpoint folder.

    One job (a reliable ``checkpoint()`` computes the plan twice unless it
    is cached), columnar and compressed, and later reads prune columns.
    Files live in ``spark.checkpoint.dir``, so a lost executor only costs
    re-reading them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df) -> None:
    """Delete the files of a table that ``materialize`` wrote and nothing reads any more."""
    spark = df.sparkSession
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Within it, a query's shuffle files are deleted when the query ends.

    For chains of ``materialize``: what a table was made from is not read
    again.  A query that runs twice shuffles twice.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def small_batches(spark: SparkSession, most_bytes: int = 8 << 20):
    """Within it, Python workers get at most about ``most_bytes`` of rows at a time.

    A batch becomes Python objects several times its size in every worker of
    an executor, and a task has a worker for each Python step.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(most_bytes))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def cluster_conf(input_bytes: int, executor_cores_total: int,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Spark settings sized for an input of ``input_bytes`` on a cluster.

    Scan splits and shuffle partitions target ``target_partition_bytes``
    so a task's working set fits executor memory; AQE coalesces small
    shuffle partitions and splits skewed ones at run time.  The shuffle
    partition count is at least twice the cores so every core has work.
    """
    shuffle_parts = max(2 * executor_cores_total, input_bytes // target_partition_bytes)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(int(shuffle_parts)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }

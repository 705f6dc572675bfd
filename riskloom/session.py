"""SparkSession helpers for tests, the benchmark and command-line use.

Library code never creates a session; it takes the caller's.  The only session
state the library touches is the checkpoint directory, and only when the
cluster has not named one (see :func:`ensure_checkpoint_dir`).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "riskloom",
                  timezone: str = "UTC", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", timezone)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("RISKLOOM_DRIVER_MEMORY", "8g"))
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  Only when nothing is configured (local tests) do we create a private
    scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir is not set: on a cluster, intermediate tables need a shared folder")
    local = tempfile.mkdtemp(prefix="riskloom-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


_WRITTEN: list[str] = []


def release_materialized(spark: SparkSession) -> int:
    """Delete the tables that :func:`materialize` wrote in this process; returns how many.

    For the end of a job: frames that still read them can no longer be used.
    """
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(conf).delete(path, True)
        n += 1
    return n


def materialize(df, label: str = "stage"):
    """Cut lineage by writing ``df`` as Parquet under the checkpoint directory and reading it back.

    Like a reliable checkpoint (the files live in the cluster's shared
    ``spark.checkpoint.dir`` and survive executor loss, and every reader sees
    the same rows), but columnar: cheaper to write and to read than the
    serialized rows of ``Dataset.checkpoint``.
    """
    import uuid

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/riskloom-{label}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    _WRITTEN.append(path)
    return spark.read.parquet(path)

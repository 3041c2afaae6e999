"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import gc
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Settings that matter at any scale.  AQE re-plans joins and coalesces
# shuffle partitions from runtime sizes; skew-join splits a hot key's
# partition; dynamic overwrite makes re-running a snapshot stamp idempotent.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
}


# Starting point for the 100 TB target (order of 1000 executors).  TPC-H at
# that size has ~6e11 line items; after column pruning a fact shuffle moves
# roughly 30 TB.  At ~512 MB per reduce partition that is ~60k partitions;
# AQE coalesces small ones and splits skewed ones at run time, so the
# configured count is an upper bound, not a fixed task count.  Scans read
# 512 MB splits (~200k map tasks for 100 TB).  The advisory size is honoured
# (parallelismFirst=false) so tasks stay large enough to amortise overhead.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.shuffle.partitions": "60000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


# Commit settings for roots on object stores, where a rename is a copy: task output becomes visible by one request for
# each file (s3a) or through a manifest of renames by the store itself (abfs, gs).  The classes come with Spark's
# hadoop-cloud module, which such a cluster has to have on its path.
_CLOUD_PROTOCOL = {
    "spark.sql.sources.commitProtocolClass": "org.apache.spark.internal.io.cloud.PathOutputCommitProtocol",
    "spark.sql.parquet.output.committer.class": "org.apache.spark.internal.io.cloud.BindingParquetOutputCommitter",
}
_FACTORY = "spark.hadoop.mapreduce.outputcommitter.factory.scheme."
COMMITTERS: dict[str, dict[str, str]] = {
    "s3a": {**_CLOUD_PROTOCOL, f"{_FACTORY}s3a": "org.apache.hadoop.fs.s3a.commit.S3ACommitterFactory",
            "spark.hadoop.fs.s3a.committer.name": "magic", "spark.hadoop.fs.s3a.committer.magic.enabled": "true"},
    "abfs": {**_CLOUD_PROTOCOL, f"{_FACTORY}abfs": "org.apache.hadoop.fs.azurebfs.commit.AzureManifestCommitterFactory"},
    "gs": {**_CLOUD_PROTOCOL, f"{_FACTORY}gs": "org.apache.hadoop.mapreduce.lib.output.committer.manifest.ManifestCommitterFactory"},
}


def committer_conf(root: str | None) -> dict[str, str]:
    """The commit settings for snapshots below ``root``, by its scheme; none where renames are cheap (``file:``, ``hdfs:``)."""
    scheme = root.partition("://")[0].lower() if root and "://" in root else ""
    return dict(COMMITTERS.get({"abfss": "abfs", "s3": "s3a"}.get(scheme, scheme), {}))


def build_session(
    master: str | None = None,
    app_name: str = "strata",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    cluster: bool = False,
    root: str | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the pipeline's defaults.

    Pass ``master`` for local runs (``local[8]``); on a cluster leave it
    ``None`` so spark-submit decides.  The defaults (and ``CLUSTER_CONF``
    with ``cluster=True``) only fill keys the launch configuration
    (spark-defaults.conf, ``--conf``) leaves unset; ``shuffle_partitions``
    and ``extra_conf`` are explicit and always applied.  ``root`` is where
    snapshots go: its scheme picks the commit settings.
    """
    extra_conf = {**committer_conf(root), **(extra_conf or {})}
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    if "spark.ui.enabled" not in (extra_conf or {}):
        builder = builder.config("spark.ui.enabled", "false")
    spark = builder.getOrCreate()
    launch = spark.sparkContext.getConf()
    defaults = {**DEFAULT_CONF, **(CLUSTER_CONF if cluster else {})}
    defaults.pop("spark.ui.enabled", None)
    for k, v in defaults.items():
        if k not in (extra_conf or {}) and not launch.contains(k):
            spark.conf.set(k, v)
    if shuffle_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return spark


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of plans that nothing refers to any more.

    Its cleaner waits for the JVM to collect the plans, which a driver with
    little to do may not do for half an hour.  The event of a query's end
    holds its plan until all listeners have seen that and a further event:
    they keep the last one while they wait.
    """
    gc.collect()
    spark.sql("SELECT 1").collect()  # events, no job
    try:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    except Py4JJavaError:  # still busy: these files go with the next call
        pass
    spark.sparkContext._jvm.System.gc()


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A directory on the cluster's shared storage.

    The root is the session's ``spark.checkpoint.dir``, which names a shared
    filesystem (HDFS, S3A, ...).  Only a local session, where driver and
    executors are one process, may leave it unset: it gets a fresh temporary
    folder.  On a cluster that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder on storage that all executors share")
        root = tempfile.mkdtemp(prefix="strata-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return "/".join([root.rstrip("/"), *parts])


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique directory under the shared root for one run."""
    return shared_dir(spark, "strata", f"{label}-{uuid.uuid4().hex[:12]}")

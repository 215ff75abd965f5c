"""Session-side helpers: where jobs may write intermediate tables.

Library code never builds a session; it takes the caller's.  Written
tables go to the shared folder named by ``spark.checkpoint.dir`` (on a
cluster that is a distributed filesystem every executor can reach).
Only a local master without the setting (tests) gets a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    It is also made the context's checkpoint directory, so ``checkpoint()``
    writes there.  Without the setting a local master gets a fresh local
    folder; any other master raises, since each executor would write to
    its own disk.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect sessions have no SparkContext
        sc = None
    conf_dir = sc.getConf().get(_CKPT_KEY, None) if sc is not None else None
    if not conf_dir:
        try:
            conf_dir = spark.conf.get(_CKPT_KEY, None)
        except Exception:  # pragma: no cover - key unknown to the session conf
            conf_dir = None
    if sc is None:
        if not conf_dir:
            raise ValueError(f"set {_CKPT_KEY} to a folder that all executors share")
        return conf_dir.rstrip("/")
    if not sc.getCheckpointDir():
        if not conf_dir and not is_local(sc.master):
            raise ValueError(f"master {sc.master}: set {_CKPT_KEY} to a folder that all executors share")
        sc.setCheckpointDir(conf_dir or tempfile.mkdtemp(prefix="stratus-ckpt-"))
    return (conf_dir or sc.getCheckpointDir()).rstrip("/")


def is_local(master: str) -> bool:
    """Whether a master URL means one process (``local-cluster`` does not)."""
    return master == "local" or master.startswith("local[")


def _remove_at_end(spark: SparkSession, path: str) -> None:
    """Has Hadoop's file system remove ``path`` when the driver's JVM ends."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)


def output_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder for one written table, removed when the driver ends."""
    path = f"{shared_dir(spark)}/stratus-out/{name}-{uuid.uuid4().hex[:12]}"
    _remove_at_end(spark, path)
    return path


def local_session(app: str = "stratus", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench (local mode, UI off, AQE on)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # coalesce shuffle output to the advisory partition size, not to the
        # core count (Spark's recommendation for clusters)
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        # the size check behind every broadcast: plan-time and runtime (AQE) bounds
        .config("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )

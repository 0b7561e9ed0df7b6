"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours needs for correct results (UTC timestamps, ANSI on)
# and for runtime re-planning at scale (AQE with partition coalescing and skew-join splits).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a row's rules make one generated method that HotSpot doesn't compile beyond 8,000 bytes of code (it would run it
    # interpreted, three times slower): Spark then splits the expressions into smaller methods instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Starting point for a large cluster (1000 executors, ~100 TB input). AQE sizes the shuffle
# partitions at run time from the advisory size; the broadcast limit bounds every measured
# broadcast (per-key tables, upsert batches and matched keys); skewed partitions are split.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(64 << 20),
    "spark.sql.files.maxPartitionBytes": str(256 << 20),
    "spark.sql.autoBroadcastJoinThreshold": str(256 << 20),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
    "spark.sql.execution.sortBeforeRepartition": "true",
}


def get_spark(master: str | None = None, app: str = "ledgerline",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators rely on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf of an already running session
                pass
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, taken from the session.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder; we never invent one there.
    Only a local-mode session (tests, bench) without the setting gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="ledgerline-ckpt-", dir=os.environ.get("LEDGERLINE_SCRATCH", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def broadcast_limit(spark: SparkSession) -> int:
    """Byte limit for a side we broadcast after measuring it (the session's own threshold)."""
    return max(0, bytes_of(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")))


def bytes_of(size) -> int:
    """A size of the session's settings (``10MB``, ``64k``, ``1024``) in bytes."""
    text = str(size).strip().lower()
    mult = 1
    for suffix, m in (("kb", 1 << 10), ("mb", 1 << 20), ("gb", 1 << 30), ("k", 1 << 10), ("m", 1 << 20), ("g", 1 << 30), ("b", 1)):
        if text.endswith(suffix):
            text, mult = text[: -len(suffix)], m
            break
    return int(float(text) * mult)


class _Owner(threading.local):
    """The scratch folders of the job that runs in this thread, and of the session outside any job."""

    def __init__(self):
        self.folders: list[list[str]] = [[]]


_OWNER = _Owner()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder (for intermediate tables)."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _OWNER.folders[-1].append(path)
    return path


@contextlib.contextmanager
def scratch_owner(spark: SparkSession):
    """Folders handed out inside, in this thread, belong to the block and are deleted at its end.

    Frames that other threads or earlier lazy queries stored are never touched.
    """
    own: list[str] = []
    _OWNER.folders.append(own)
    try:
        yield own
    finally:
        _OWNER.folders.pop()
        _delete(spark, own)


def release_scratch(spark: SparkSession) -> int:
    """Delete the folders this thread was handed outside any job; no frame over them may be used again."""
    return _delete(spark, _OWNER.folders[0])


def _delete(spark: SparkSession, paths: list[str]) -> int:
    conf = spark._jsc.hadoopConfiguration()
    removed = 0
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            fs.delete(p, True)
            removed += 1
    paths.clear()
    return removed

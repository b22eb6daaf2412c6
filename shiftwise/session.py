"""Session construction and the shared scratch location.

On a cluster the shared folder comes from ``spark.checkpoint.dir`` as set by the
cluster configuration; this module only fills it in when it is unset (local
tests on a local master) and raises otherwise.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: adaptive execution (runtime coalescing, skew
# join splitting, runtime broadcast conversion) and a fixed session time zone
# so timestamp_ntz <-> timestamp conversions are stable.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app_name: str = "shiftwise",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled"):
        spark.conf.set(k, conf[k])
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server side owns the checkpoint folder
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir on the Spark Connect server")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all "
                               f"executors share (master {sc.master})")
        configured = tempfile.mkdtemp(prefix="shiftwise-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_scratch: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder; ``release_scratch``
    (also run when the program ends) removes what was written there."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/shiftwise-scratch/{name}-{uuid.uuid4().hex[:12]}"
    _scratch.append((spark, path))
    return path


def file_system(spark: SparkSession, path: str):
    """(Hadoop FileSystem of ``path``, the Hadoop Path class)."""
    cls = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return cls(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), cls


def release_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders handed out so far (frames that still read
    them become unreadable). Returns how many existed."""
    gone = 0
    while _scratch:
        _, path = _scratch.pop()
        fs, cls = file_system(spark, path)
        gone += bool(fs.delete(cls(path), True))
    return gone


@atexit.register
def _release_at_exit() -> None:
    if _scratch and _scratch[-1][0].sparkContext._jsc is not None:
        release_scratch(_scratch[-1][0])

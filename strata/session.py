"""SparkSession settings every operator relies on.

* ``spark.sql.session.timeZone=UTC``: timestamp -> date conversions (Q9) are
  done in UTC, so a kickoff at 23:30-05:00 lands on the next UTC day.
* ANSI mode on: malformed casts and decimal overflow raise, as the
  relational reference does on insert.
* AQE on: coalesces small shuffle partitions, splits skewed join partitions
  and converts joins to broadcast once real sizes are known.
"""

from __future__ import annotations

import os
import re
import tempfile
import threading

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Scan splits and post-shuffle partitions of ~128 MB keep every task well
    # inside executor memory at any scale; AQE coalesces smaller ones. Set
    # spark.sql.shuffle.partitions to (largest shuffle / ~200 MB) per cluster.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "strata",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    ``shuffle_partitions`` should be sized so one partition fits an executor
    core's memory at the target scale (~128-256 MB of shuffle data each).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_sql_conf(spark)
    return spark


def apply_sql_conf(spark: SparkSession) -> None:
    """Pin the runtime SQL settings on an existing session (idempotent)."""
    for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled",
              "spark.sql.adaptive.enabled"):
        if spark.conf.get(k, None) != DEFAULT_CONF[k]:
            spark.conf.set(k, DEFAULT_CONF[k])


def small_batches(spark: SparkSession, rows: int = 256, size: int | None = None) -> None:
    """Bound what Python workers hold at once: long texts travel few to an Arrow batch, and those over
    ``size`` bytes together in several."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if size and not 0 < spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)) <= size:
        spark.conf.set(key, size)


def driver_heap(spark: SparkSession) -> int:
    """The largest heap, in bytes, that the driver's JVM may take."""
    return spark.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory()


_CKPT_LOCK = threading.Lock()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's reliable checkpoint directory.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``
    (or one already set on the SparkContext). Only when neither is set and the
    master is this one machine, as in local tests, a fresh scratch folder is
    created and registered; on a cluster a missing folder is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    with _CKPT_LOCK:
        return _set_checkpoint_dir(spark, sc)


def _set_checkpoint_dir(spark: SparkSession, sc) -> str:
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError(f"spark.checkpoint.dir is not set and {sc.master} has several machines: "
                               "name a folder that all of them share")
        conf_dir = tempfile.mkdtemp(prefix="strata-ckpt-",
                                    dir=os.environ.get("STRATA_SCRATCH", None))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir

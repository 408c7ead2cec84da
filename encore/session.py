"""Spark session defaults for encore jobs.

The settings here are the ones every job relies on: UTC session time (all
date text is parsed as UTC), adaptive query execution (runtime broadcast
conversion, partition coalescing and skew-join splitting), and a shared
checkpoint folder read from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every encore job expects. They are applied with ``setIfMissing``
# semantics by ``configure`` so a cluster's own values win.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime broadcast only for sides whose *measured* shuffle size is small.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Streaming state on local disk with RocksDB instead of executor memory:
    # per-key state for billions of keys does not fit on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "encore",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with encore's defaults.

    ``master`` is only for local runs and tests; on a cluster leave it None
    so spark-submit decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``encore`` importable in the Python workers on every executor (the
    keyed state functions run there), like ``spark-submit --py-files``: the
    package is zipped once per application on the driver and added with
    ``addPyFile``, which serves it to the executors."""
    import zipfile
    from pathlib import Path

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    d = tempfile.mkdtemp(prefix="encore-pyfiles-")
    zpath = os.path.join(d, "encore.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent).as_posix())
    sc.addPyFile(zpath)
    _SHIPPED.add(app)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings encore relies on to an existing session.

    Only settings that are unset are filled in, except the session time
    zone, which the date parsing in encore requires to be UTC.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for k, v in DEFAULT_CONF.items():
        if k == "spark.ui.enabled":
            continue
        try:
            if spark.conf.get(k, None) is None:
                spark.conf.set(k, v)
        except Exception:  # static conf on a running session
            pass
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and stored intermediate tables.

    Read from ``spark.checkpoint.dir`` (the cluster names it). Where it is
    unset, a local session gets a new scratch folder; on a cluster that would
    be a folder of one machine, so it is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all of {master} share")
        d = tempfile.mkdtemp(prefix="encore-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d

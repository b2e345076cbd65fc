"""Session helpers.

Cluster settings win: we only fill in a value when the session does not
already carry one (``setdefault`` semantics), so a cluster's
``spark.checkpoint.dir`` / shuffle sizing is never overridden.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults applied only where the session has no value of its own.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of released DataFrames are removed by the cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "quarry", **conf) -> SparkSession:
    """Return the active session or build one (tests / local runs).

    ``conf`` overrides are applied on top of the defaults. On a cluster
    the caller's session already exists and is returned unchanged apart
    from defaults that were unset.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        _fill_defaults(active)
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**_DEFAULTS, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    _fill_defaults(spark)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _fill_defaults(spark: SparkSession) -> None:
    for k, v in _DEFAULTS.items():
        if k in ("spark.ui.enabled", "spark.ui.showConsoleProgress", "spark.cleaner.referenceTracking.cleanCheckpoints"):
            continue  # static; cannot change on a live session
        if spark.conf.get(k, None) is None and spark.conf.isModifiable(k):
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names.

    Read from ``spark.checkpoint.dir``. Where the session has none, a local
    master gets a temporary folder that goes with the process; on a cluster
    executors would not see such a folder, so that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="quarry-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/quarry-{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df):
    """Reliable checkpoint (survives executor loss); never localCheckpoint."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default

"""Session construction and the shared scratch folder.

Everything in the library takes a ``SparkSession`` from the caller; this module only offers a
sensible default builder for scripts and tests, plus the one place that decides where
lineage-cutting writes go.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every analysis relies on. Month labels come from timestamp_ntz columns, so the
# session time zone must not shift them; AQE coalesces the small post-aggregation shuffles
# and splits skewed partitions at run time.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.aggregatePushdown": "true",
}


# Context-level settings for sessions built here (ignored when a session already exists):
# checkpoint files of collected DataFrames are removed from the shared folder.
CONTEXT_CONF = {
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "wideloom",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return the active session or build one with :data:`BASE_CONF` applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {**BASE_CONF, **CONTEXT_CONF}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # Session-level SQL settings also apply when the session already existed.
    for k, v in conf.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staged files.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared filesystem). Only when
    it is unset, as in local tests, a private folder is created and registered. Under Spark
    Connect there is no local SparkContext; the server's own setting is used as is.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect session
        sc = None
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or \
        (sc.getConf().get("spark.checkpoint.dir", None) if sc is not None else None)
    if not conf_dir:
        master = sc.master if sc is not None else "connect"
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder (master {master})")
        conf_dir = tempfile.mkdtemp(prefix="wideloom-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(conf_dir)
    return conf_dir.rstrip("/")

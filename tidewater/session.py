"""Session settings shared by every job.

The library never creates a cluster of its own: it reads the session it is
handed and only fills in settings that are still unset (tests, laptops).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators rely on. Applied only when the session leaves them unset.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _export_package_path() -> None:
    """Python workers import the package through ``PYTHONPATH`` (local mode).
    On a cluster ship it with ``spark-submit --py-files``."""
    parts = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in parts:
        os.environ["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *parts])


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tidewater", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; clusters pass their own session."""
    _export_package_path()
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in {**DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings the operators need without overriding the cluster's."""
    for k, v in DEFAULTS.items():
        try:
            if k == "spark.sql.session.timeZone":
                # Timestamps in the data are zone-less; the library computes in UTC.
                spark.conf.set(k, v)
            elif spark.conf.get(k, None) is None:
                spark.conf.set(k, v)
        except Exception:  # noqa: BLE001 - a static or locked setting stays as the cluster has it
            pass
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage cuts.

    Read from ``spark.checkpoint.dir`` (set by the cluster). Only when it is unset in
    local mode (unit tests, laptops) a fresh local folder is chosen; a cluster without it raises.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        sc = None
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and sc is not None:
        root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        # A Spark Connect session doesn't tell where its executors are: it may be a cluster.
        if sc is None or not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint root (never machine-local on a cluster)."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"

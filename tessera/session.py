"""Session helpers: local test sessions and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for every job in the library.  AQE coalesces the small
# post-shuffle partitions and splits skewed ones at runtime.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Return a session with the library's defaults (for tests, bench, scripts).

    The master and the number of shuffle partitions are set only when asked
    for, so a submitted job keeps what the cluster gave it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master or os.environ.get("TESSERA_MASTER"):
        builder = builder.master(master or os.environ["TESSERA_MASTER"])
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if "TESSERA_DRIVER_MEMORY" in os.environ:
        conf["spark.driver.memory"] = os.environ["TESSERA_DRIVER_MEMORY"]
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint dir of the session.

    Only a local master without one gets a private temporary folder (tests);
    on a cluster the executors would write to disks nobody else can read, so
    a missing setting is an error there.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tessera-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return sc.getCheckpointDir() or base


def scratch_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    The directory is read from ``spark.checkpoint.dir`` (or the context's
    checkpoint dir).  Only when neither is set -- local tests -- a private
    temporary folder is created and registered as the checkpoint dir.
    """
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/" + (name or "t") + "-" + uuid.uuid4().hex[:12]

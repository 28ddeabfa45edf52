"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that matter for results or for the plan shape. AQE re-plans joins
# and coalesces shuffle partitions at runtime; the session time zone is pinned
# so period functions on timestamps agree with other engines.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "panelmerge", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster ``master`` stays None and the launcher decides; tests pass
    ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    A cluster names it there and we use it as is. Only a local master may do
    without: it gets a scratch folder of its own (tests). On a cluster a
    machine-local folder would be another one on every executor, so that is an
    error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current.rstrip("/")
    registered = spark.sparkContext.getCheckpointDir()
    if registered:
        return registered
    if getattr(spark.sparkContext, "master", "local").split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="panelmerge-ckpt-"))
    return spark.sparkContext.getCheckpointDir()

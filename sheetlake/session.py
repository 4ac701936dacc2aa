"""SparkSession construction with the settings the library relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package assumes. The SQL settings are runtime
# settings: they are applied to the session only where it does not already
# set them, so a cluster's own configuration wins.
DEFAULT_SQL_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only what the planner or AQE measured below this size.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # Source paths are data, never typed partition values.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# Start-up settings of a session this package creates itself.
START_CONF: dict[str, str] = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of collected DataFrames are removed by the cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}
DEFAULT_CONF = {**DEFAULT_SQL_CONF, **START_CONF}


def get_spark(master: str | None = None, app_name: str = "sheetlake",
              conf: dict[str, str] | None = None) -> SparkSession:
    """Return a session with the package defaults.

    Values passed in ``conf`` always apply. The SQL defaults are set only
    where the session (``spark-submit --conf``, ``spark-defaults.conf``) does
    not set them already. Nothing starts the JVM before the builder, so
    start-up values such as ``spark.driver.memory`` in ``conf`` take effect.
    """
    explicit = dict(conf or {})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**START_CONF, **explicit}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in DEFAULT_SQL_CONF.items():
        if key not in explicit and spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage (``spark.checkpoint.dir``).

    On a cluster this must be set by the deployment to a shared file system;
    executors could not read each other's local folders. Only a local session
    (``local[...]``, all tasks on one machine) gets a fresh local folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="sheetlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediates."""
    return os.path.join(checkpoint_dir(spark), name)

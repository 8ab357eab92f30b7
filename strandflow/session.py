"""Session helpers shared by queries, bench and tests."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "strandflow", **conf: str) -> SparkSession:
    """A session with the settings the engine relies on; a cluster's own settings win where ``master`` is None."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One source table; column pruning and filters reach the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; a temporary one only where that is unset (tests)."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
    return spark.sparkContext.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, so that later plans start from its files and survive lost executors."""
    context = df.sparkSession.sparkContext
    folder = shared_folder(df.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)

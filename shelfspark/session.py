"""Session factory for local runs and tests; a cluster passes its own session."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", partitions: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A session with the settings this library is tested with."""
    builder = SparkSession.builder.master(master).appName("shelfspark")
    settings = DEFAULTS | {"spark.sql.shuffle.partitions": str(partitions), "spark.driver.memory": memory}
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

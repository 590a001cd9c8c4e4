"""Session builder with the settings the engine is designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str = "local[8]", partitions: int = 8, app: str = "weftgraph", **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC timestamps and Arrow transfer; further settings by ``conf``.

    Partition counts are starting values: adaptive execution merges small shuffle partitions and splits skewed ones.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

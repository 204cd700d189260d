"""Session settings the operators are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings; safe to apply to a running session.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where that costs one more shuffle: one straggler
    # holding a third of the rows is worse than the shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "shopledger", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        # Call-site capture for error messages costs more than building the plans.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

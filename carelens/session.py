"""Session settings the reports are tuned for. A cluster passes its own master,
memory and ``spark.checkpoint.dir``; nothing here overrides those."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # run-time plan changes: coalesced partitions, run-time broadcast (size
    # checked by Spark), skewed shuffle partitions split
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the dates are zone free; this only pins parsing and display
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and measurements."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("carelens")
        .config("spark.ui.enabled", "false")
        # no Python call sites on every column expression: plans build faster
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return apply_settings(spark)

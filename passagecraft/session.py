"""A Spark session for one machine: tests, the bench and notebooks.

On a cluster use the session the cluster gives you; nothing in this package
depends on the settings below.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "12g", shared: str | None = None) -> SparkSession:
    builder = SparkSession.builder
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    spark = (
        builder.master(f"local[{cores}]")
        .appName("passagecraft")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.passagecraft.readPartitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark

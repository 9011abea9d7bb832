"""Tables in the shared folder that cut an operator's lineage."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from passagecraft.functions import sizing

# While a table is staged: shuffle files go as soon as it is written, and the batches that
# tasks exchange with Python are small.
SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


@contextmanager
def tidy(spark: SparkSession):
    """``SETTINGS`` hold inside and are as before afterwards."""
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def stage(df: DataFrame, label: str) -> DataFrame:
    """As the general ``stage``; the table is complete, so the shuffles behind it are not kept."""
    with tidy(df.sparkSession):
        return sizing.stage(df, label)

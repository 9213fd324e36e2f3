"""Session settings the operators are designed for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "tillwise", master: str | None = None, partitions: int | None = None,
                **extra: str) -> SparkSession:
    """A session with the settings above; cluster settings stay with spark-submit.

    ``partitions`` is only for small local runs. On a cluster leave it unset and
    let adaptive execution coalesce from a high ``spark.sql.shuffle.partitions``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
        builder = builder.config("spark.driver.memory", os.environ.get("TILLWISE_DRIVER_MEMORY", "8g"))
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

"""Session defaults shared by the tests, the bench and ad-hoc use."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "tallymark", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with UTC timestamps, ANSI arithmetic and adaptive execution.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: spark-submit and AQE decide.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master).config("spark.driver.memory", "6g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()

"""Session settings shared by the command line, the bench and the tests."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(app: str = "leafspark", cores: str | int | None = None, **conf: str) -> SparkSession:
    """Local session with the engine's defaults; on a cluster, spark-submit's settings win.

    UTC keeps timestamps comparable with other engines. Arrow batches are small because a decoded page
    can be tens of MB, and adaptive execution coalesces or splits shuffle partitions at run time.
    """
    cores = cores or os.environ.get("BENCH_CPUS") or "8"
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.shuffle.partitions": str(cores),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.executorEnv.OMP_NUM_THREADS": "1",
    } | conf
    builder = SparkSession.builder.appName(app)
    if "SPARK_MASTER" not in os.environ:
        builder = builder.master(f"local[{cores}]")
    return builder.config(map=settings).getOrCreate()

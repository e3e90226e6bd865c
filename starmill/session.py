"""A session for tests and the bench; on a cluster use the one the cluster gives."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: str = "*", **conf: str) -> SparkSession:
    defaults = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "8g",
        # A load compiles a few hundred small classes; the default of 100 evicts them before the
        # next load can reuse them.
        "spark.sql.codegen.cache.maxEntries": "2000",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("starmill")
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

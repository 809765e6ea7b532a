"""Session used by the tests and the benchmark; a cluster brings its own."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, app: str = "logblocks", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="logblocks-"))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

"""Session and table access shared by every query."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def get_spark(app: str = "quirekit", cores: str | None = None) -> SparkSession:
    """A local session with the settings the library is tested under; a cluster brings its own session."""
    n = cores or os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", n)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("QUIREKIT_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables, lazily."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

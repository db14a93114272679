"""New and changed pages picked up as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quirekit.operators.providers import pending


def process_new(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, key: list[str], request: str, work: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Processes each page of Parquet files that appear in ``source`` whose content has no ok result in ``target`` yet.

    ``work`` gives the rows to append (key, status, input_sha256 and more). Files are read once; a page whose content
    hash is known is left out, so a repeated batch adds nothing for pages that succeeded.
    """

    def batch(df: DataFrame, _: int) -> None:
        todo = df
        jvm = spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(target)
        if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
            todo = pending(df, spark.read.parquet(target), key, request).drop("input_sha256")
        work(todo.dropDuplicates([*key, request])).write.mode("append").parquet(target)

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def page_rate(stream: DataFrame, at: str = "ts", late: str = "1 hour", window: str = "10 minutes") -> DataFrame:
    """Pages done per window, late ones up to ``late`` included."""
    return stream.withWatermark(at, late).groupBy(F.window(at, window)).agg(F.count("*").alias("pages"))

"""Sinks of micro-batches that a repeated batch leaves as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmur.streaming.sinks import BatchTable


class OutboxRelay:
    """foreachBatch handler that publishes the rows of an outbox once, and so marks them.

    What a batch relays is the folder of its id, which is also the mark: a repeated batch
    looks at earlier marks only and replaces its own folder, so it relays the same rows again
    under the same id, and a row that the outbox delivers twice is relayed once. ``published``
    are ids (event_id) that were published before.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType,
                 published: DataFrame | None = None) -> None:
        self.spark, self.path, self.schema, self.published = spark, path, schema, published

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        fresh = rows.dropDuplicates(["event_id"])
        if self.published is not None:
            fresh = fresh.join(self.published.select("event_id"), "event_id", "left_anti")
        if batch_id > 0:
            earlier = self.relayed().where(F.col("batch") < batch_id).select("event_id")
            fresh = fresh.join(earlier, "event_id", "left_anti")
        fresh.select(*self.schema.names).write.mode("overwrite").parquet(
            f"{self.path}/batch={batch_id}")

    def relayed(self) -> DataFrame:
        """The published rows, with the id of their batch."""
        batch = T.StructField("batch", T.LongType())
        return self.spark.read.schema(T.StructType([*self.schema.fields, batch])).parquet(self.path)


METRICS = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("metric_type", T.StringType()),
    T.StructField("metric_value", T.DoubleType()), T.StructField("last_offset", T.LongType())])


def merged_metrics(parts: DataFrame) -> DataFrame:
    """Values add up and offsets take the greatest, per user and metric."""
    return parts.groupBy("user_id", "metric_type").agg(
        F.sum("metric_value").alias("metric_value"), F.max("last_offset").alias("last_offset"))


class MetricsUpsert:
    """foreachBatch handler that keeps sums per (user_id, metric_type).

    A batch adds one row per key, from offset, user_id, metric_type and value; a repeated batch
    replaces its own.
    """

    def __init__(self, spark: SparkSession, path: str, fold_every: int = 20) -> None:
        self.table = BatchTable(spark, path, METRICS, merged_metrics, fold_every)

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        self.table.write(merged_metrics(rows.select(
            "user_id", "metric_type", F.col("value").alias("metric_value"),
            F.col("offset").alias("last_offset"))), batch_id)

    def current(self) -> DataFrame:
        return self.table.current()

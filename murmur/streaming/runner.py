"""Running streams to the end of the available input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from murmur.functions.columns import count_if
from murmur.session import shared_dir
from murmur.streaming import sinks

BatchFn = Callable[[DataFrame, int], None]


def append_to(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append mode to parquet: every result row is written once, when it is final."""
    query = (df.writeStream.outputMode("append").format("parquet")
             .option("path", path).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def each_batch(df: DataFrame, handle: BatchFn, checkpoint: str,
               mode: str = "update") -> StreamingQuery:
    query = (df.writeStream.outputMode(mode).foreachBatch(handle)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def keyed_sink(df: DataFrame, path: str, checkpoint: str, every: str) -> StreamingQuery:
    """A long-running append to parquet at a fixed interval, for deployment."""
    return (df.writeStream.outputMode("append").format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(processingTime=every).start())


def topic_sink(df: DataFrame, servers: str, topic: str, checkpoint: str,
               every: str) -> StreamingQuery:
    """Rows with key and value columns to a Kafka topic; needs the connector."""
    return (df.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
            .writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).option("checkpointLocation", checkpoint)
            .trigger(processingTime=every).start())


def counted(stream: DataFrame, counts: dict[str, Column], kept: Callable[[DataFrame], DataFrame],
            folder: str) -> sinks.BatchTable:
    """Write ``kept`` of every micro-batch, and count beside it how many rows meet each condition.

    The counts are observed while the rows are written and kept by batch id, so a repeated
    batch counts once and no batch is forgotten.
    """
    names = list(counts)
    schema = T.StructType([T.StructField(n, T.LongType()) for n in names])
    totals = sinks.BatchTable(stream.sparkSession, f"{folder}/counts", schema,
                              lambda parts: parts.agg(*[F.sum(n).alias(n) for n in names]))

    def handle(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        rows = kept(batch.observe(seen, *[count_if(c).alias(n) for n, c in counts.items()]))
        rows.write.mode("overwrite").parquet(f"{folder}/rows/batch={batch_id:09d}")
        row = [tuple(int(seen.get[n]) for n in names)]
        totals.write(batch.sparkSession.createDataFrame(row, schema), batch_id)

    each_batch(stream, handle, f"{folder}/checkpoint", "append")
    return totals


def read_result(spark: SparkSession, path: str, schema) -> DataFrame:
    """The written rows, also when the stream has not written any file."""
    return spark.read.schema(schema).parquet(path)


def finished(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """Run an append stream over all input and return what it wrote."""
    out = shared_dir(spark, purpose)
    append_to(df, f"{out}/rows", f"{out}/checkpoint")
    return read_result(spark, f"{out}/rows", df.schema)

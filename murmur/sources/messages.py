"""Messages from files or topics, decoded to typed columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmur.schemas import CORRUPT, with_corrupt


def topic_stream(spark: SparkSession, servers: str, topics: list[str],
                 starting: str = "earliest", per_trigger: int | None = None) -> DataFrame:
    """Kafka topics as (topic, key, value, partition, offset, timestamp, headers).

    Needs the Kafka connector on the class path of the cluster; without it use
    :func:`file_stream`.
    """
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", ",".join(topics)).option("startingOffsets", starting)
              .option("includeHeaders", "true").option("kafka.isolation.level", "read_committed"))
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load().withColumns({
        "key": F.col("key").cast("string"), "value": F.col("value").cast("string")})


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*",
                files_per_trigger: int | None = None, fmt: str = "parquet") -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)


def decode(df: DataFrame, schema: T.StructType, time_field: str | None = "timestamp",
           value: str = "value") -> DataFrame:
    """JSON text to columns; unreadable rows, null ones too, have ``is_bad`` and keep their
    text in ``error_value``.

    ``time_field`` holds epoch milliseconds and becomes the event time ``ts``.
    """
    parsed = F.from_json(F.col(value), with_corrupt(schema),
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    kept = [c for c in df.columns if c != value and c not in schema.fieldNames()]
    rows = df.select(*kept, F.col(value).alias("__raw"), parsed.alias("__m"))
    bad = F.col(f"__m.{CORRUPT}").isNotNull() | F.col("__m").isNull()
    out = rows.select(
        *kept,
        *[F.when(~bad, F.col("__m").getField(f.name)).alias(f.name) for f in schema.fields],
        F.when(bad, F.col("__raw")).alias("error_value"), bad.alias("is_bad"))
    if time_field:
        out = out.withColumn("ts", F.timestamp_millis(F.col(time_field)))
    return out


def good_and_bad(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (decoded.filter(~F.col("is_bad")).drop("error_value", "is_bad"),
            decoded.filter("is_bad").drop("is_bad"))


def merge_topics(streams: dict[str, DataFrame]) -> DataFrame:
    """Several topics as one frame with a topic column; missing columns are null."""
    tagged = [df.withColumn("topic", F.lit(name)) for name, df in streams.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def route(topic: Column, prefix: str = "cdc") -> Column:
    """server.schema.table to prefix.table."""
    return F.regexp_replace(topic, r"^([^.]+)\.([^.]+)\.([^.]+)$", f"{prefix}.$3")

"""Incremental and full reads of relational tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_table(spark: SparkSession, url: str, table: str, key: str | None = None,
               bounds: tuple[int, int] | None = None, parts: int = 1,
               options: dict[str, str] | None = None) -> DataFrame:
    """A table or subquery, read in parallel ranges of a numeric key where given.

    Filters, columns and limits on the result are pushed to the database.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    reader = reader.options(**(options or {}))
    if key and bounds:
        reader = (reader.option("partitionColumn", key).option("lowerBound", bounds[0])
                  .option("upperBound", bounds[1]).option("numPartitions", parts))
    return reader.load()


def after_mark(df: DataFrame, updated: str, key: str, mark: tuple[Column, Column]) -> Column:
    ts, last = mark
    return (F.col(updated) > ts) | ((F.col(updated) == ts) & (F.col(key) > last))


def incremental(df: DataFrame, updated: str, key: str, mark: tuple[Column, Column],
                limit: int, source_system: str, ingested_at: Column | None = None) -> DataFrame:
    """The next rows after the mark (updated, key), at most ``limit``."""
    newer = df.filter((F.col(updated) >= mark[0]) & after_mark(df, updated, key, mark))
    ingested = F.current_timestamp() if ingested_at is None else ingested_at
    return newer.orderBy(updated, key).limit(limit).withColumns({
        "source_system": F.lit(source_system), "ingested_at": ingested})


def next_mark(batch: DataFrame, updated: str, key: str) -> DataFrame:
    return batch.agg(F.max(F.struct(updated, key)).alias("m")).select("m.*")


def since_id(rows: DataFrame, marks: DataFrame, keys: list[str], row_id: str) -> DataFrame:
    """Rows of each account with an id above its mark; accounts without mark read all.

    marks: one row per account with ``last_id``.
    """
    joined = rows.join(marks, keys, "left")
    return joined.filter(F.col(row_id) > F.coalesce("last_id", F.lit(-1))).drop("last_id")


def new_marks(rows: DataFrame, marks: DataFrame, keys: list[str], row_id: str) -> DataFrame:
    """The highest id seen per account, old marks included."""
    seen = rows.select(*keys, F.col(row_id).alias("last_id")).unionByName(
        marks.select(*keys, "last_id"))
    return seen.groupBy(*keys).agg(F.max("last_id").alias("last_id"))

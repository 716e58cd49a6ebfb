"""Changelog tables and change data capture."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmur.functions import scans
from murmur.functions.columns import count_if
from murmur.functions.ranking import newest_per_key, oldest_per_key


def latest(log: DataFrame) -> DataFrame:
    """Last value per key by offset; a null payload deletes the key."""
    return newest_per_key(log, ["log_key"], ["log_offset"]).filter(F.col("payload").isNotNull())


def compact_versioned(log: DataFrame) -> DataFrame:
    """State after replaying the log with versions.

    A null payload deletes. An update is accepted if its version is not lower than the
    stored one, and any update revives a deleted key. Hence only rows after the last
    tombstone of a key matter, and of these the one with the highest version, the
    later one if equal.
    """
    gone = log.filter(F.col("payload").isNull()).groupBy("log_key").agg(
        F.max("log_offset").alias("deleted_at"))
    alive = log.filter(F.col("payload").isNotNull()).join(gone, "log_key", "left").filter(
        F.col("deleted_at").isNull() | (F.col("log_offset") > F.col("deleted_at")))
    return newest_per_key(alive.drop("deleted_at"), ["log_key"], ["version", "log_offset"])


def compacted_log(log: DataFrame) -> DataFrame:
    """At most two rows per key that replay like the whole log does.

    These are the last tombstone and the surviving update. Compacted logs of successive
    batches can be joined end to end: compacting them gives the state of all batches.
    """
    dead = log.filter(F.col("payload").isNull())
    last_dead = newest_per_key(dead, ["log_key"], ["log_offset"])
    return compact_versioned(log).unionByName(last_dead)


def rebuilt(snapshot: DataFrame, tail: DataFrame) -> DataFrame:
    """The state from a ``compacted_log`` and the log after it, without the rest of the log."""
    return compact_versioned(snapshot.unionByName(tail))


def compaction_stats(log: DataFrame, chunk: Column | None = None) -> DataFrame:
    """Messages, updates, tombstones, ignored old versions, active and deleted keys.

    Tombstones cut the history of a key into epochs; an update is ignored when an
    earlier update of its epoch has a higher version.

    The log is read and dealt once, by key and chunk of offsets. Windows inside a chunk give the
    highest version before each row since the chunk's last tombstone; one row per chunk then
    carries over what the epoch brought along from earlier chunks, and only rows before a
    chunk's first tombstone can need that.
    """
    chunk = scans.by_offset("log_offset") if chunk is None else chunk
    at = F.struct("log_key", chunk.alias("chunk")).alias("at")
    # Every use below needs just these columns, so they all read the same exchange.
    rows = log.select(at, "log_offset", "version", F.col("payload").isNull().alias("dead"))
    in_chunk = Window.partitionBy("at").orderBy("log_offset")
    version = F.when(~F.col("dead"), F.col("version"))
    local = rows.withColumn("epoch", F.sum(F.col("dead").cast("int")).over(in_chunk)).withColumn(
        "seen", F.max(version).over(Window.partitionBy("at", "epoch").orderBy("log_offset")
                                    .rowsBetween(Window.unboundedPreceding, -1)))
    ends = local.groupBy("at").agg(
        F.count(F.lit(1)).alias("messages"), count_if(F.col("dead")).alias("tombstones"),
        F.max_by("dead", "log_offset").alias("dead"), F.max(F.struct(
            "epoch", version.alias("version"))).alias("last"))
    by_key = Window.partitionBy("at.log_key").orderBy("at.chunk")
    ends = ends.withColumn("epochs", F.sum((F.col("tombstones") > 0).cast("int")).over(by_key))
    in_epoch = Window.partitionBy("at.log_key", "epochs").orderBy("at.chunk")
    ends = ends.withColumn("kept", F.max("last.version").over(in_epoch)).withColumn(
        "carried", F.lag("kept").over(by_key)).withColumn(
        "newest", F.lead("at").over(by_key).isNull())
    carried = ends.where("carried IS NOT NULL").select("at", "carried")
    old = local.join(carried, "at", "left").where(~F.col("dead")).agg(count_if(
        F.col("version") < F.greatest("seen", F.when(F.col("epoch") == 0, F.col("carried")))
    ).alias("ignored_old_versions"))
    gone = F.col("newest") & F.col("dead")
    totals = ends.agg(
        F.coalesce(F.sum("messages"), F.lit(0)).alias("messages"),
        F.coalesce(F.sum(F.col("messages") - F.col("tombstones")), F.lit(0)).alias("updates"),
        F.coalesce(F.sum("tombstones"), F.lit(0)).alias("tombstones"),
        count_if(F.col("newest") & ~F.col("dead")).alias("active_keys"),
        count_if(gone).alias("deleted_keys"))
    # Two frames of one row each.
    return reduce(lambda a, b: a.unionByName(b), [
        f.unpivot([], f.columns, "measure", "value") for f in (totals, old)])


def cdc_state(log: DataFrame, key: str) -> DataFrame:
    """Current table after create, read, update and delete events.

    log: log_offset, row_key, op, before, after. A tombstone has a null op.
    """
    keyed = log.withColumn(key, F.coalesce(
        F.col(f"after.{key}"), F.col(f"before.{key}"), F.col("row_key")))
    last = newest_per_key(keyed.select(key, "log_offset", "op", "after"), [key], ["log_offset"])
    kept = last.filter(F.col("op").isin("c", "u", "r"))
    return kept.select("after.*")


def cdc_counts(log: DataFrame) -> DataFrame:
    return log.groupBy(F.coalesce("op", F.lit("tombstone")).alias("op")).agg(
        F.count(F.lit(1)).alias("n"))


def cdc_diff(log: DataFrame, ignored: tuple[str, ...] = ("created_at", "updated_at")) -> DataFrame:
    """Changed columns of updates as (column, old, new).

    Without a before image nothing is known to have changed.
    """
    columns = [f.name for f in log.schema["after"].dataType if f.name not in ignored]

    def change(c: str) -> Column:
        old, new = F.col(f"before.{c}"), F.col(f"after.{c}")
        return F.when(~old.eqNullSafe(new), F.struct(
            F.lit(c).alias("column"), old.cast("string").alias("old"),
            new.cast("string").alias("new")))

    changes = F.array_compact(F.array(*[change(c) for c in columns]))
    return log.filter((F.col("op") == "u") & F.col("before").isNotNull()).withColumn(
        "changes", changes)


def first_result(requests: DataFrame, key: str, offset: str, result: str) -> DataFrame:
    """Every request with the result of the first one of the same key."""
    first = oldest_per_key(requests.select(key, offset, result), [key], [offset]).select(
        key, F.col(offset).alias("first_offset"), F.col(result).alias("first_result"))
    return requests.join(first, key).withColumn(
        "is_repeat", F.col(offset) != F.col("first_offset"))


def merge_counts(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Upsert per hashtag: counts add up, the window start keeps its first value and
    the other columns take the last one.

    Both sides: hashtag, seq, count, last_updated, window_start, window_end,
    trend_score; stored rows have a lower seq. One union and one aggregation.
    """
    return stored.unionByName(batch).groupBy("hashtag").agg(
        F.sum("count").alias("count"),
        F.min_by("window_start", "seq").alias("window_start"),
        *[F.max_by(c, "seq").alias(c) for c in ("last_updated", "window_end", "trend_score")])


def merge_metrics(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Upsert per (user, metric): values add up and offsets take the greatest."""
    return stored.unionByName(batch).groupBy("user_id", "metric_type").agg(
        F.sum("metric_value").alias("metric_value"), F.max("last_offset").alias("last_offset"))


def retain(table: DataFrame, column: str, as_of: Column, days: int) -> DataFrame:
    return table.filter(F.col(column) >= as_of - F.make_interval(days=F.lit(days)))


def outbox_batch(outbox: DataFrame, published: DataFrame, limit: int = 100) -> DataFrame:
    """The oldest rows that are not published yet."""
    return (outbox.join(published.select("event_id"), "event_id", "left_anti")
            .orderBy("created_at", "event_id").limit(limit))


def marked_published(outbox: DataFrame, published: DataFrame, batch: DataFrame,
                     now: Column) -> DataFrame:
    """The outbox with ``published``, and ``published_at`` for the rows of a relayed batch.

    Marking a batch again changes nothing but the time.
    """
    done = published.select("event_id").union(batch.select("event_id")).distinct().withColumn(
        "published", F.lit(True))
    fresh = batch.select("event_id", now.alias("published_at"))
    return (outbox.join(done, "event_id", "left").join(fresh, "event_id", "left")
            .withColumn("published", F.coalesce("published", F.lit(False))))

"""Reports on partitions, order, duplicates, payments, errors, grants, notifications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmur.functions import scans
from murmur.functions.columns import clamp01, count_if, first_match, percent
from murmur.functions.ranking import top, top_per_key
from murmur.operators.validate import backoff


def partition_workload(keys: DataFrame) -> DataFrame:
    """Distinct users and rows per partition; needs partition, user_id."""
    per_user = keys.groupBy("partition", "user_id").agg(F.count(F.lit(1)).alias("n"))
    return per_user.groupBy("partition").agg(
        F.count(F.lit(1)).alias("users"), F.sum("n").alias("total_posts"))


def partition_balance(workload: DataFrame, partitions: int) -> DataFrame:
    """One row over the non-empty partitions; 1 is a perfect balance."""
    mean = F.avg("total_posts")
    ratio = F.coalesce(F.try_divide(F.var_pop("total_posts"), mean * mean), F.lit(0.0))
    by_load = F.struct("total_posts", -F.col("partition"))
    return workload.agg(
        F.sum("total_posts").alias("total_keys"),
        (F.sum("total_posts") / F.lit(partitions)).alias("average_per_partition"),
        clamp01(F.lit(1.0) - ratio).alias("balance"),
        F.max_by("partition", by_load).alias("hottest"),
        F.min_by("partition", F.struct("total_posts", "partition")).alias("coldest"))


def hotspots(loads: DataFrame, value: str, high: float, low: float) -> DataFrame:
    """Partitions far above or below the average; the window sees one row each."""
    mean = F.avg(value).over(Window.partitionBy())
    flag = first_match([(F.col(value) > mean * high, "hot"), (F.col(value) < mean * low, "cold")],
                       "normal")
    return loads.withColumn("average", mean).withColumn("flag", flag)


def distribution_health(flagged: DataFrame) -> DataFrame:
    """Health by the number of hot partitions, for both of the rules in use."""
    n, hot, cold = (F.count(F.lit(1)), count_if(F.col("flag") == "hot"),
                    count_if(F.col("flag") == "cold"))
    return flagged.agg(
        n.alias("partitions"), hot.alias("hot"), cold.alias("cold"),
        ((hot == 0) & (cold <= n * 0.1)).alias("distribution_ok"),
        first_match([(hot / n > 0.1, "unhealthy"), (hot / n > 0.05, "warning")], "healthy")
        .alias("health"))


def order_violations(messages: DataFrame) -> DataFrame:
    """Per user: messages older than the one before, and misplaced positions.

    messages: user_id, seq, sent_s. A position is misplaced when the arrival order and
    the time order hold different times there. Both orders are numbered without putting
    a user into one task, and meet on (user, position).
    """
    prior = scans.scan(messages, ["user_id"], ["seq"], scans.by_offset("seq"),
                       sums={"position": F.lit(1).cast("long")}, previous={"before_s": "sent_s"})
    arrival = prior.select(
        "user_id", "position", "sent_s",
        F.coalesce(F.col("sent_s") < F.col("before_s"), F.lit(False)).alias("is_late"))
    by_time = scans.row_numbers(
        messages, ["user_id"], ["sent_s", "seq"], F.floor(F.col("sent_s") / 3600), "position")
    expected = by_time.select("user_id", "position", F.col("sent_s").alias("expected_s"))
    return arrival.join(expected, ["user_id", "position"]).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("message_count"), count_if(F.col("is_late")).alias("late"),
        count_if(F.col("sent_s") != F.col("expected_s")).alias("misplaced"))


def user_timeline(messages: DataFrame, n: int = 50) -> DataFrame:
    """The last n messages per user by time, oldest first."""
    last = top_per_key(messages, ["user_id"], [F.desc("sent_s"), F.desc("seq")], n)
    return last.groupBy("user_id").agg(
        F.array_sort(F.collect_list(F.struct("sent_s", "seq"))).alias("timeline"))


def duplicate_stats(rows: DataFrame, key: str) -> DataFrame:
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    many = count_if(F.col("n") > 1)
    total = F.count(F.lit(1))
    return counts.agg(total.alias("total_posts"), many.alias("duplicates_found"),
                      (many / F.greatest(total, F.lit(1))).alias("duplicate_rate"),
                      F.coalesce(F.sum("n"), F.lit(0)).alias("deliveries"))


def payment_stats(payments: DataFrame) -> DataFrame:
    n, good = F.count(F.lit(1)), count_if(F.col("status") == "completed")
    return payments.agg(
        n.alias("total_payments"), good.alias("successful_payments"),
        count_if(F.col("status") == "failed").alias("failed_payments"),
        F.bround(percent(good, n), 2).alias("success_rate"),
        F.coalesce(F.sum(F.when(F.col("status") == "completed", F.col("amount"))), F.lit(0.0))
        .alias("total_amount"))


def recent_payments(payments: DataFrame, n: int = 10) -> DataFrame:
    return top(payments, [F.desc("created_at"), F.desc("id")], n)


def error_metrics(rows: DataFrame) -> DataFrame:
    """Counts per outcome and the success and error rate; ``action`` is null if fine."""
    n = F.greatest(F.count(F.lit(1)), F.lit(1))
    fine = count_if(F.col("action").isNull())
    return rows.agg(
        fine.alias("processed"),
        *[count_if(F.col("action") == a).alias(a) for a in ("skip", "retry", "dlq", "fatal")],
        (fine / n).alias("success_rate"), (F.lit(1.0) - fine / n).alias("error_rate"))


def dead_letter_lifecycle(failures: DataFrame, max_retries: int = 10, base_s: float = 1.0,
                          limit_s: float = 60.0) -> DataFrame:
    """Attempts, next delay and final state per record; needs key, seq, error_type."""
    out = failures.groupBy("key").agg(
        F.count(F.lit(1)).alias("attempts"), F.max_by("error_type", "seq").alias("error_type"))
    final = F.col("attempts") >= max_retries
    return out.withColumn("is_permanent", final).withColumn(
        "next_delay_s", F.when(~final, backoff(F.col("attempts"), base_s, 2.0, limit_s)))


def grant_summary(grants: DataFrame) -> DataFrame:
    """Grants by principal, by resource type, by operation and in total.

    Equal grants are merged before the grouping sets copy the rows.
    """
    cells = grants.groupBy("principal", "resource_type", "operation").agg(
        F.count(F.lit(1)).alias("cell"))
    p, r, o = F.col("principal"), F.col("resource_type"), F.col("operation")
    out = cells.groupingSets([[p], [r], [o], []], p, r, o).agg(
        F.sum("cell").alias("n"), F.grouping_id().alias("level"))
    kind = first_match([(F.col("level") == 3, "principal"), (F.col("level") == 5, "resource_type"),
                        (F.col("level") == 6, "operation")], "total")
    return out.select(kind.alias("kind"), F.coalesce(p, r, o, F.lit("all")).alias("name"), "n")


def sent_by_type(notifications: DataFrame) -> DataFrame:
    return notifications.groupBy("event_type").agg(F.count(F.lit(1)).alias("sent"))


def newest_notifications(notifications: DataFrame, n: int = 10) -> DataFrame:
    return top_per_key(notifications, ["user_id"], [F.desc("created_at"), F.desc("seq")], n)


def split_by_type(rows: DataFrame, valid: Column, kinds: list[str], latency: str) -> DataFrame:
    """Processed and filtered rows, one column per type and the mean latency."""
    kind = F.col("interaction_type")
    return rows.agg(
        count_if(valid).alias("processed"), count_if(~valid).alias("filtered"),
        *[count_if(valid & (kind == k)).alias(k.lower()) for k in kinds],
        F.bround(F.coalesce(F.avg(F.when(valid, F.col(latency))), F.lit(0.0)), 2)
        .alias("avg_latency_ms"))

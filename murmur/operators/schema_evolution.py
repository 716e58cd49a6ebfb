"""Compatibility of schema versions and reports on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmur.functions.columns import count_if, percent

NULLABLE_TEXT = "null,string"


def compatibility(fields: DataFrame) -> DataFrame:
    """Compare every version of a subject with the version before it.

    fields: subject, version, field, type, has_default. A removed field needs a default
    or the nullable text type to be backward compatible; an added field needs a default
    both ways. The first version passes. The fields of two versions meet in one group
    per field, so no join is needed.
    """
    versions = fields.select("subject", "version").distinct()
    by_version = Window.partitionBy("subject").orderBy("version")
    # Window over the list of versions of a subject, not over its fields.
    chain = versions.withColumn("following", F.lead("version").over(by_version)).withColumn(
        "number", F.row_number().over(by_version))
    tagged = fields.join(chain, ["subject", "version"])
    new = tagged.select("subject", "version", "field", F.lit(True).alias("is_new"),
                        "type", "has_default", (F.col("number") == 1).alias("is_first"))
    old = tagged.filter(F.col("following").isNotNull()).select(
        "subject", F.col("following").alias("version"), "field", F.lit(False).alias("is_new"),
        "type", "has_default", F.lit(False).alias("is_first"))
    removed = ~F.col("in_new") & F.col("in_old")
    added = F.col("in_new") & ~F.col("in_old") & ~F.col("is_first")
    per_field = new.unionByName(old).groupBy("subject", "version", "field").agg(
        F.bool_or("is_new").alias("in_new"), F.bool_or(~F.col("is_new")).alias("in_old"),
        F.bool_or("is_first").alias("is_first"),
        F.bool_or(F.col("has_default") & ~F.col("is_new")).alias("old_default"),
        F.bool_or(F.col("has_default") & F.col("is_new")).alias("new_default"),
        F.bool_or((F.col("type") == NULLABLE_TEXT) & ~F.col("is_new")).alias("old_nullable"))
    lost = removed & ~F.col("old_default") & ~F.col("old_nullable")
    bare = added & ~F.col("new_default")
    out = per_field.groupBy("subject", "version").agg(
        F.bool_and(~lost & ~bare).alias("backward"), F.bool_and(~bare).alias("forward"))
    return out.withColumn("full", F.col("backward") & F.col("forward"))


def registry_report(versions: DataFrame) -> DataFrame:
    """Versions per subject and per state, totals and the average.

    versions: subject, version, state, one row per version.
    """
    per_subject = versions.groupBy("subject").agg(F.count(F.lit(1)).alias("n"))
    states = versions.groupBy("state").agg(F.count(F.lit(1)).cast("double").alias("value"))
    totals = per_subject.agg(
        F.count(F.lit(1)).cast("double").alias("total_subjects"),
        F.sum("n").cast("double").alias("total_schemas"),
        F.avg("n").alias("avg_versions_per_subject"))
    return (totals.unpivot([], totals.columns, "measure", "value")
            .select(F.lit("registry").alias("part"), "measure", "value")
            .unionByName(states.select(F.lit("state").alias("part"),
                                       F.col("state").alias("measure"), "value"))
            .unionByName(per_subject.select(F.lit("subject").alias("part"),
                                            F.col("subject").alias("measure"),
                                            F.col("n").cast("double").alias("value"))))


def adoption(rows: DataFrame, version: str = "version") -> DataFrame:
    """Rows and share per version; the window sees one row per version."""
    counts = rows.groupBy(version).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.withColumn("percentage", percent(F.col("n"), total))


def governance_health(failures: Column, errors: Column, old_share: Column) -> Column:
    """100 less penalties for failed checks, consumer errors and a slow migration."""
    score = (F.lit(100) - F.least(F.lit(20), failures * 5) - F.least(F.lit(15), errors * 5)
             - F.when(old_share > 90, 10).otherwise(0))
    return F.greatest(F.lit(0), score)


def governance_row(checks: DataFrame, consumed: DataFrame) -> DataFrame:
    """One row with the health score.

    checks: passed boolean; consumed: version, is_error. Both are counted into one row
    each and then added up in a single row.
    """
    a = checks.agg(count_if(~F.col("passed")).alias("failures"))
    b = consumed.agg(count_if(F.col("is_error")).alias("errors"),
                     count_if(F.col("version") == "v1").alias("old"),
                     F.count(F.lit(1)).alias("total"))
    parts = (a.selectExpr("failures", "0L AS errors", "0L AS old", "0L AS total")
             .unionByName(b.selectExpr("0L AS failures", "errors", "old", "total")))
    sums = parts.agg(*[F.sum(c).alias(c) for c in ("failures", "errors", "old", "total")])
    return sums.withColumn("health_score", governance_health(
        F.col("failures"), F.col("errors"), percent(F.col("old"), F.col("total"))))

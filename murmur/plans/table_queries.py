"""Queries on changelogs, CDC, conflict resolution and schema versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmur.functions import scans
from murmur.functions.columns import lookup
from murmur.operators import resolve, schema_evolution, tables
from murmur.plans.registry import query
from murmur.plans.row_queries import AS_OF, AS_OF_S, joined, rounded

SEC = "epoch_us(ts) // 1000000"

LATEST_SQL = """
SELECT log_key, log_offset, version, payload FROM (SELECT *,
  row_number() OVER (PARTITION BY log_key ORDER BY log_offset DESC) AS rn FROM changelog)
WHERE rn = 1 AND payload IS NOT NULL"""


@query("tbl_latest", "changelog", LATEST_SQL)
def _(t):
    return tables.latest(t.changelog).select("log_key", "log_offset", "version", "payload")


COMPACT_SQL = """
SELECT log_key, log_offset, version, payload FROM (
  SELECT *, row_number() OVER (PARTITION BY log_key ORDER BY version DESC, log_offset DESC) AS rn
  FROM (SELECT *, max(CASE WHEN payload IS NULL THEN log_offset END) OVER (PARTITION BY log_key) AS dead
    FROM changelog) WHERE payload IS NOT NULL AND log_offset > coalesce(dead, -1)) WHERE rn = 1"""


@query("tbl_compact_versioned", "changelog", COMPACT_SQL)
def _(t):
    return tables.compact_versioned(t.changelog).select(
        "log_key", "log_offset", "version", "payload")


@query("tbl_rebuild", "changelog", COMPACT_SQL)
def _(t):
    """A reader starts from the compacted log up to a day and replays what came later."""
    early = F.col("updated_at") < F.to_timestamp(F.lit("2024-01-15"))
    snapshot = tables.compacted_log(t.changelog.filter(early))
    return tables.rebuilt(snapshot, t.changelog.filter(~early)).select(
        "log_key", "log_offset", "version", "payload")


@query("tbl_compact_stats", "changelog", """
WITH e AS (SELECT *, sum(CASE WHEN payload IS NULL THEN 1 ELSE 0 END)
    OVER (PARTITION BY log_key ORDER BY log_offset) AS epoch FROM changelog),
v AS (SELECT *, max(version) OVER (PARTITION BY log_key, epoch ORDER BY log_offset
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS stored FROM e WHERE payload IS NOT NULL),
l AS (SELECT log_key, arg_max(payload IS NULL, log_offset) AS dead FROM changelog GROUP BY log_key)
SELECT 'messages' AS measure, count(*) AS value FROM changelog
UNION ALL SELECT 'updates', count(*) FROM changelog WHERE payload IS NOT NULL
UNION ALL SELECT 'tombstones', count(*) FROM changelog WHERE payload IS NULL
UNION ALL SELECT 'ignored_old_versions', count(*) FROM v WHERE version < stored
UNION ALL SELECT 'active_keys', count(*) FROM l WHERE NOT dead
UNION ALL SELECT 'deleted_keys', count(*) FROM l WHERE dead""")
def _(t):
    return tables.compaction_stats(t.changelog)


def cdc_log(t):
    """Events as changes of user rows; one in twenty is a bare tombstone."""
    k = F.col("k")
    op = F.when(k % 20 == 19, F.lit(None)).otherwise(
        lookup(F.col("event_type"), {"signup": "c", "error": "d", "view": "r"}, "u"))
    name = F.concat(F.lit("n"), k % 4)
    before = F.struct("user_id", F.concat(F.lit("n"), k % 3).alias("name"),
                      F.when(k % 7 != 0, k % 5).alias("level"), (F.col("ts")).alias("updated_at"))
    after = F.struct("user_id", name.alias("name"), (k % 6).alias("level"),
                     F.col("ts").alias("updated_at"))
    base = t.ev.withColumn("op", op)
    o = F.col("op")
    return base.select(
        F.col("event_id").alias("log_offset"), F.col("user_id").alias("row_key"), "op",
        F.when(o.isin("u", "d") & (k % 10 != 0), before).alias("before"),
        F.when(o.isin("c", "u", "r"), after).alias("after"))


CDC_SQL = """
SELECT event_id AS log_offset, user_id, k, ts, CASE WHEN k % 20 = 19 THEN NULL ELSE CASE event_type
  WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' WHEN 'view' THEN 'r' ELSE 'u' END END AS op FROM ev"""


@query("cdc_apply", "ev", f"""
SELECT user_id, 'n' || (k % 4) AS name, k % 6 AS level FROM (SELECT *,
  row_number() OVER (PARTITION BY user_id ORDER BY log_offset DESC) AS rn FROM ({CDC_SQL}))
WHERE rn = 1 AND op IN ('c', 'u', 'r')""")
def _(t):
    return tables.cdc_state(cdc_log(t), "user_id").drop("updated_at")


@query("cdc_op_counts", "ev",
       f"SELECT coalesce(op, 'tombstone') AS op, count(*) AS n FROM ({CDC_SQL}) GROUP BY 1")
def _(t):
    return tables.cdc_counts(cdc_log(t))


@query("cdc_diff", "ev", f"""
SELECT log_offset, concat_ws(',',
  CASE WHEN k % 3 <> k % 4 THEN concat('name:n', k % 3, '>n', k % 4) END,
  CASE WHEN k % 7 = 0 OR k % 5 <> k % 6
    THEN concat('level:', CASE WHEN k % 7 = 0 THEN '' ELSE CAST(k % 5 AS VARCHAR) END, '>', k % 6) END)
  AS changes FROM ({CDC_SQL}) WHERE op = 'u' AND k % 10 <> 0""")
def _(t):
    text = F.transform("changes", lambda c: F.concat(
        c["column"], F.lit(":"), F.coalesce(c["old"], F.lit("")), F.lit(">"), c["new"]))
    return tables.cdc_diff(cdc_log(t)).select("log_offset", joined(text).alias("changes"))


def copies(t):
    """Copies of content records; every tenth lacks a time and times go back and forth."""
    k = F.col("k")
    shifted = F.timestamp_seconds(F.unix_seconds("ts") - (k % 7) * 86400)
    return t.ev.select(
        F.col("user_id").alias("content_id"), F.col("event_id").alias("seq"),
        F.when(k % 10 != 0, shifted).alias("updated_at"),
        F.when(k % 20 != 0, F.timestamp_seconds(F.unix_seconds("ts") - 86400 * 9))
        .alias("created_at"), F.col("value").alias("engagement_score"),
        F.col("event_type").alias("category"))


COPIES_SQL = f"""
SELECT user_id AS content_id, event_id AS seq, k, event_type AS category, value AS engagement_score,
  CASE WHEN k % 10 <> 0 THEN {SEC} - (k % 7) * 86400 END AS updated_s,
  CASE WHEN k % 20 <> 0 THEN {SEC} - 86400 * 9 END AS created_s, user_id, ts FROM ev"""


@query("res_lww", "ev", f"""
WITH c AS (SELECT *, coalesce(updated_s, created_s) AS s FROM ({COPIES_SQL})),
r AS (SELECT *, row_number() OVER (PARTITION BY content_id ORDER BY seq) AS arrival,
    row_number() OVER (PARTITION BY content_id ORDER BY s DESC NULLS LAST, seq) AS newest FROM c),
f AS (SELECT content_id, s IS NULL AS stuck FROM r WHERE arrival = 1)
SELECT content_id, seq, category, engagement_score FROM r JOIN f USING (content_id)
WHERE CASE WHEN stuck THEN arrival = 1 ELSE newest = 1 END""")
def _(t):
    return resolve.last_write_wins(copies(t), "content_id").select(
        "content_id", "seq", "category", "engagement_score")


@query("res_merge_content", "ev", f"""
WITH c AS ({COPIES_SQL}),
r AS (SELECT *, row_number() OVER (PARTITION BY content_id ORDER BY seq) AS arrival,
    max(updated_s) OVER (PARTITION BY content_id ORDER BY seq
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM c),
f AS (SELECT content_id, updated_s IS NULL AS stuck FROM r WHERE arrival = 1),
a AS (SELECT r.* FROM r JOIN f USING (content_id)
  WHERE arrival = 1 OR (NOT stuck AND updated_s > seen))
SELECT content_id, arg_max(seq, seq) AS seq, arg_max(category, seq) AS category,
  max(engagement_score) AS engagement_score FROM a GROUP BY content_id""")
def _(t):
    return resolve.merge_contents(copies(t)).select(
        "content_id", "seq", "category", "engagement_score")


@query("res_merge_profile", "ev", f"""
WITH p AS (SELECT user_id, event_id AS seq, 'name' || (k % 9) AS username, k AS follower_count,
    (k * 7) % 50 AS following_count, value / 1000 AS engagement_rate,
    CASE WHEN k % 4 <> 0 THEN event_type END AS bio, {SEC} AS s, k,
    CASE WHEN k % 5 = 0 THEN [] ELSE ['t' || (k % 3), event_type] END AS interests FROM ev),
w AS (SELECT user_id, string_agg(word, ',' ORDER BY word) AS interests FROM (
    SELECT DISTINCT user_id, unnest(interests) AS word FROM p) GROUP BY user_id)
SELECT user_id, arg_max(username, seq) AS username, max(follower_count) AS follower_count,
  max(following_count) AS following_count, round(max(engagement_rate), 6) AS engagement_rate,
  arg_max(bio, seq) FILTER (bio IS NOT NULL) AS bio, max(s) AS updated_s,
  coalesce(any_value(w.interests), '') AS interests
FROM p LEFT JOIN w USING (user_id) GROUP BY user_id""")
def _(t):
    k = F.col("k")
    interests = F.when(k % 5 == 0, F.array().cast("array<string>")).otherwise(
        F.array(F.concat(F.lit("t"), k % 3), F.col("event_type")))
    df = t.ev.select(
        "user_id", F.col("event_id").alias("seq"),
        F.concat(F.lit("name"), k % 9).alias("username"), k.alias("follower_count"),
        (k * 7 % 50).alias("following_count"), (F.col("value") / 1000).alias("engagement_rate"),
        F.when(k % 4 != 0, F.col("event_type")).alias("bio"), F.col("ts").alias("updated_at"),
        interests.alias("interests"))
    out = resolve.merge_profiles(df).withColumn("updated_s", F.unix_seconds("updated_at"))
    return rounded(out.withColumn("interests", joined("interests")).drop("updated_at"))


@query("res_version_vector", "ev", """
SELECT event_id, CASE WHEN event_type = p_type THEN k > p_k ELSE ts > p_ts END AS newer FROM (
  SELECT *, lag(event_type) OVER w AS p_type, lag(k) OVER w AS p_k, lag(ts) OVER w AS p_ts FROM ev
  WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) WHERE p_type IS NOT NULL""")
def _(t):
    pairs = scans.scan(
        t.ev, ["user_id"], ["event_id"], scans.by_offset("event_id"),
        previous={"other_event_type": "event_type", "other_k": "k", "other_ts": "ts"})
    return pairs.filter(F.col("other_event_type").isNotNull()).select(
        "event_id", resolve.is_newer("event_type", "k", "ts").alias("newer"))


@query("dedup_idempotent", "", """
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, first_value(l_extendedprice) OVER w AS first_result,
  row_number() OVER w > 1 AS is_repeat
FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
  l_extendedprice, l_quantity, l_shipdate)""")
def _(t):
    fields = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
              "l_shipdate"]
    requests = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
                                 F.struct(*fields).alias("arrival"))
    return tables.first_result(requests, "l_orderkey", "arrival", "l_extendedprice").select(
        "l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_partkey",
        "first_result", "is_repeat")


def schema_fields(t):
    """Fields of schema versions: brand is the subject, size the version, name the field."""
    return t.part.groupBy(
        F.col("p_brand").alias("subject"), F.col("p_size").cast("long").alias("version"),
        F.col("p_type").alias("field")).agg(
        (F.max("p_retailprice") % 3 > 1).alias("has_default"),
        F.when(F.min("p_partkey") % 2 == 0, "null,string").otherwise("string").alias("type"))


FIELDS_SQL = """
SELECT p_brand AS subject, p_size::BIGINT AS version, p_type AS field,
  max(p_retailprice) % 3 > 1 AS has_default,
  CASE WHEN min(p_partkey) % 2 = 0 THEN 'null,string' ELSE 'string' END AS type
FROM part GROUP BY p_brand, p_size, p_type"""


@query("sch_compat", "", f"""
WITH f AS ({FIELDS_SQL}),
v AS (SELECT subject, version, lag(version) OVER (PARTITION BY subject ORDER BY version) AS prior
  FROM (SELECT DISTINCT subject, version FROM f)),
lost AS (SELECT v.subject, v.version FROM v JOIN f o ON o.subject = v.subject AND o.version = v.prior
  LEFT JOIN f n ON n.subject = v.subject AND n.version = v.version AND n.field = o.field
  WHERE n.field IS NULL AND NOT o.has_default AND o.type <> 'null,string'),
bare AS (SELECT v.subject, v.version FROM v JOIN f n ON n.subject = v.subject AND n.version = v.version
  LEFT JOIN f o ON o.subject = v.subject AND o.version = v.prior AND o.field = n.field
  WHERE v.prior IS NOT NULL AND o.field IS NULL AND NOT n.has_default)
SELECT subject, version,
  (subject, version) NOT IN (SELECT (subject, version) FROM lost)
    AND (subject, version) NOT IN (SELECT (subject, version) FROM bare) AS backward,
  (subject, version) NOT IN (SELECT (subject, version) FROM bare) AS forward,
  (subject, version) NOT IN (SELECT (subject, version) FROM lost)
    AND (subject, version) NOT IN (SELECT (subject, version) FROM bare) AS full
FROM v""".replace("AS full", 'AS "full"'))
def _(t):
    return schema_evolution.compatibility(schema_fields(t))


@query("sch_registry_report", "", f"""
WITH v AS (SELECT DISTINCT subject, version,
  CASE WHEN version < 10 THEN 'DEPRECATED' WHEN version < 45 THEN 'ACTIVE' ELSE 'DRAFT' END AS state
  FROM ({FIELDS_SQL})), s AS (SELECT subject, count(*) AS n FROM v GROUP BY subject)
SELECT 'registry' AS part, 'total_subjects' AS measure, count(*)::DOUBLE AS value FROM s
UNION ALL SELECT 'registry', 'total_schemas', sum(n) FROM s
UNION ALL SELECT 'registry', 'avg_versions_per_subject', round(avg(n), 6) FROM s
UNION ALL SELECT 'state', state, count(*) FROM v GROUP BY state
UNION ALL SELECT 'subject', subject, n FROM s""")
def _(t):
    version = F.col("version")
    versions = schema_fields(t).select("subject", "version").distinct().withColumn(
        "state", F.when(version < 10, "DEPRECATED").when(version < 45, "ACTIVE")
        .otherwise("DRAFT"))
    return rounded(schema_evolution.registry_report(versions))


VERSION_SQL = "CASE event_type WHEN 'view' THEN 'v1' WHEN 'click' THEN 'v2' ELSE 'v3' END"


def consumed(t):
    return t.ev.select(
        lookup(F.col("event_type"), {"view": "v1", "click": "v2"}, "v3").alias("version"),
        (F.col("k") == 0).alias("is_error"))


@query("agg_schema_adoption", "ev", f"""
SELECT version, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS percentage
FROM (SELECT {VERSION_SQL} AS version FROM ev) GROUP BY version""")
def _(t):
    return rounded(schema_evolution.adoption(consumed(t)))


@query("agg_governance_health", "ev", """
SELECT f AS failures, e AS errors, o AS old, n AS total,
  greatest(0, 100 - least(20, f * 5) - least(15, e * 5) - CASE WHEN o * 100.0 / n > 90 THEN 10 ELSE 0 END)
  AS health_score
FROM (SELECT count(*) FILTER (k = 3) AS f, count(*) FILTER (k = 0) AS e,
  count(*) FILTER (event_type = 'view') AS o, count(*) AS n FROM ev)""")
def _(t):
    checks = t.ev.select((F.col("k") != 3).alias("passed"))
    return schema_evolution.governance_row(checks, consumed(t))


# Sinks: the merged table after one more batch.

def counts_of(posts, seq):
    """Hashtag counts of posts as sink records."""
    from murmur.operators import trending

    tags = trending.hashtag_rows(posts)
    return tags.groupBy("hashtag").agg(
        F.count(F.lit(1)).alias("count"), F.min(F.unix_seconds("ts")).alias("window_start"),
        F.max(F.unix_seconds("ts")).alias("window_end")).select(
        "hashtag", F.lit(seq).alias("seq"), "count", F.col("window_end").alias("last_updated"),
        "window_start", "window_end", F.col("count").cast("double").alias("trend_score"))


@query("sink_upsert_add", "posts", f"""
WITH x AS (SELECT ts, unnest(hashtags) AS hashtag FROM posts),
a AS (SELECT hashtag, count(*) AS n, min({SEC}) AS w0, max({SEC}) AS w1 FROM x
  WHERE ts < TIMESTAMP '2024-01-15' GROUP BY hashtag),
b AS (SELECT hashtag, count(*) AS n, min({SEC}) AS w0, max({SEC}) AS w1 FROM x
  WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY hashtag)
SELECT hashtag, coalesce(a.n, 0) + coalesce(b.n, 0) AS count, coalesce(a.w0, b.w0) AS window_start,
  coalesce(b.w1, a.w1) AS last_updated, coalesce(b.w1, a.w1) AS window_end,
  coalesce(b.n, a.n)::DOUBLE AS trend_score FROM a FULL JOIN b USING (hashtag)""")
def _(t):
    half = F.to_timestamp(F.lit("2024-01-15"))
    return tables.merge_counts(counts_of(t.posts.filter(F.col("ts") < half), -1),
                               counts_of(t.posts.filter(F.col("ts") >= half), 0))


@query("sink_upsert_metrics", "interactions", """
SELECT user_id, lower(interaction_type) AS metric_type, round(sum(duration_s), 4) AS metric_value,
  max(event_id) AS last_offset FROM interactions GROUP BY ALL""")
def _(t):
    half = F.to_timestamp(F.lit("2024-01-15"))

    def part(condition):
        return t.interactions.filter(condition).groupBy(
            "user_id", F.lower("interaction_type").alias("metric_type")).agg(
            F.sum("duration_s").alias("metric_value"), F.max("event_id").alias("last_offset"))

    return rounded(tables.merge_metrics(part(F.col("ts") < half), part(F.col("ts") >= half)), 4)


@query("sink_retention", "posts", f"""
SELECT post_id, {SEC} AS ts_s FROM posts WHERE ts >= {AS_OF} - INTERVAL 7 DAY""")
def _(t):
    as_of = F.to_timestamp(F.lit("2024-01-31 00:00:00"))
    return tables.retain(t.posts, "ts", as_of, 7).select(
        "post_id", F.unix_seconds("ts").alias("ts_s"))


def outbox_of(t):
    outbox = t.ev.select("event_id", "event_type", F.col("ts").alias("created_at"))
    return outbox, t.likes.select(F.col("post_id").alias("event_id")).distinct()


@query("sink_outbox_relay", "ev likes", f"""
SELECT event_id, event_type, {SEC} AS created_s FROM ev
WHERE event_id NOT IN (SELECT post_id FROM likes) ORDER BY ts, event_id LIMIT 100""")
def _(t):
    outbox, published = outbox_of(t)
    return tables.outbox_batch(outbox, published).select(
        "event_id", "event_type", F.unix_seconds("created_at").alias("created_s"))


@query("sink_outbox_marked", "ev likes", f"""
WITH b AS (SELECT event_id FROM ev WHERE event_id NOT IN (SELECT post_id FROM likes)
  ORDER BY ts, event_id LIMIT 100)
SELECT event_id, event_id IN (SELECT post_id FROM likes) OR event_id IN (SELECT event_id FROM b)
    AS published, CASE WHEN event_id IN (SELECT event_id FROM b) THEN {AS_OF_S} END::BIGINT AS published_s
FROM ev""")
def _(t):
    """The outbox after the batch has been relayed and marked."""
    outbox, published = outbox_of(t)
    batch = tables.outbox_batch(outbox, published)
    marked = tables.marked_published(outbox, published, batch, F.timestamp_seconds(F.lit(AS_OF_S)))
    return marked.select("event_id", "published",
                         F.unix_seconds("published_at").alias("published_s"))

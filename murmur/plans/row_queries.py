"""Row-level queries: validation, moderation, scores, features, mapping, flattening."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmur import fixed_values as fv
from murmur.functions.columns import first_match, lookup
from murmur.operators import messages, moderation, scoring, validate
from murmur.plans.registry import query

AS_OF_S = 1706659200  # 2024-01-31 00:00 UTC, just after the last event
AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
WORD = r"[\p{L}\p{N}_]"


def joined(column):
    return F.array_join(column, ",")


def sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def whole(words) -> str:
    body = "|".join(w.replace("'", "''") for w in words)
    return f"(^|[^\\p{{L}}\\p{{N}}_])(?:{body})($|[^\\p{{L}}\\p{{N}}_])"


def sql_any(column: str, words) -> str:
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


def sql_hits(column: str, words) -> str:
    return "(" + " + ".join(f"CAST(contains({column}, '{w}') AS INTEGER)" for w in words) + ")"


# Validation.

@query("flt_interaction_required", "interactions", """
SELECT event_id, content_id, user_id, interaction_type FROM interactions
WHERE content_id IS NOT NULL AND user_id IS NOT NULL AND interaction_type <> 'UNKNOWN'""")
def _(t):
    df = t.interactions.select("event_id", "content_id", "user_id", F.nullif(
        F.col("interaction_type"), F.lit("UNKNOWN")).alias("interaction_type"))
    return validate.with_required(df, ["content_id", "interaction_type", "user_id"])


def named_interactions(t):
    name = first_match([(F.col("k") < 4, F.concat(F.lit("SpamBot"), F.col("user_id"))),
                        (F.col("k") == 5, "")], F.concat(F.lit("user"), F.col("user_id")))
    return t.interactions.select(
        "event_id", name.alias("user_name"), "content_id", "interaction_type",
        F.when(F.col("k") == 6, 0).otherwise(F.unix_seconds("ts")).alias("ts_s"))


NAMED_SQL = """
SELECT event_id, CASE WHEN k < 4 THEN 'SpamBot' || user_id WHEN k = 5 THEN ''
    ELSE 'user' || user_id END AS user_name, content_id, interaction_type,
  CASE WHEN k = 6 THEN 0 ELSE epoch_us(ts) // 1000000 END AS ts_s FROM interactions"""
REASON_SQL = f"""
SELECT event_id, user_name, content_id, interaction_type, ts_s,
  CASE WHEN user_name = '' OR content_id IS NULL
      OR interaction_type NOT IN ('LIKE', 'SHARE', 'COMMENT', 'VIEW') OR ts_s <= 0
    THEN 'Invalid structure'
    WHEN regexp_matches(user_name, 'bot|spam|fake', 'i') THEN 'Bot account detected'
    ELSE 'Valid' END AS reason FROM ({NAMED_SQL})"""


def reasons(t):
    return named_interactions(t).withColumn("reason", validate.interaction_reason(
        "user_name", "content_id", "interaction_type", "ts_s"))


@query("flt_interaction_valid", "interactions",
       f"SELECT event_id, reason FROM ({REASON_SQL})")
def _(t):
    return reasons(t).select("event_id", "reason")


@query("flt_split_valid", "interactions", f"""
SELECT 'valid' AS part, event_id, CAST(NULL AS VARCHAR) AS reason FROM ({REASON_SQL})
  WHERE reason = 'Valid'
UNION ALL SELECT 'invalid', event_id, reason FROM ({REASON_SQL}) WHERE reason <> 'Valid'""")
def _(t):
    return validate.with_part(reasons(t)).select("part", "event_id", "reason")


@query("flt_engagement_valid", "interactions likes", """
SELECT event_id, user_id, content_id, lower(interaction_type) AS engagement_type
FROM interactions WHERE lower(interaction_type) IN ('like', 'share', 'comment', 'follow', 'view')
  AND event_id NOT IN (SELECT post_id FROM likes)""")
def _(t):
    df = t.interactions.select("event_id", "user_id", "content_id",
                               F.lower("interaction_type").alias("engagement_type"))
    stored = t.likes.select(F.col("post_id").alias("event_id")).distinct()
    return validate.valid_engagements(df, stored, ["like", "share", "comment", "follow", "view"])


CLEAN_SQL = r"regexp_replace(regexp_replace(content, '[\x00-\x1f\x7f-\x9f]', '', 'g'), '^\s+|\s+$', '', 'g')"


@query("flt_post_process", "text_posts", rf"""
SELECT concat('post_', post_id, '_', user_id) AS id, length(content) AS cleaned_length,
  md5(content) AS content_md5, reason,
  array_to_string(regexp_extract_all(content, '#({WORD}+)', 1), ',') AS hashtags,
  array_to_string(regexp_extract_all(content, '@({WORD}+)', 1), ',') AS mentions
FROM (SELECT post_id, user_id, {CLEAN_SQL} AS content,
    CASE WHEN length(content) > 280 THEN 'Content exceeds maximum length' END AS reason
  FROM text_posts)""")
def _(t):
    df = t.text_posts.select(F.col("post_id").alias("offset"), "user_id", "content",
                             F.lit(AS_OF_S).alias("ts"))
    return validate.process_posts(df).select(
        "id", F.length("content").cast("long").alias("cleaned_length"),
        F.md5("content").alias("content_md5"), "reason",
        joined("hashtags").alias("hashtags"), joined("mentions").alias("mentions"))


def schema_rows(t):
    k, kind = F.col("k"), F.col("event_type")
    digest = F.md5(F.col("event_id").cast("string"))
    uuid = F.concat_ws("-", *[F.substring(digest, a, n)
                              for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    both = (k == 7)
    return t.ev.select(
        F.col("event_id").alias("row_id"),
        F.when(k == 1, digest).otherwise(uuid).alias("event_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        lookup(kind, {"view": "follow", "click": "like", "signup": "comment",
                      "purchase": "share"}, "poke").alias("interaction_type"),
        F.when(k == 3, F.lit("u")).otherwise(F.concat(F.lit("user_"), F.col("user_id")))
        .alias("actor_id"),
        F.when(k != 4, F.concat(F.lit("p"), k)).alias("target_id"),
        F.when((kind == "purchase") | both, F.expr("repeat('x', int(k) * 25)")).alias("content"),
        F.when(kind == "signup", F.expr("repeat('y', int(k) * 8)")).alias("comment_text"),
        F.when(kind == "click", F.when(k == 8, F.lit("meh")).otherwise(F.lit("love")))
        .alias("reaction_type"),
        F.when(kind == "purchase", F.when(k % 9 == 0, F.array(F.lit("no uri")))
               .when(k == 10, F.array_repeat(F.lit("http://x/1"), 11))
               .otherwise(F.array(F.lit("http://x/1")))).alias("media_urls"),
        F.element_at(F.array(*[F.lit(c) for c in ("web", "mobile", "api", "web")]),
                     (k % 4 + 1).cast("int")).alias("client_type"))


@query("flt_schema_validate", "ev", """
SELECT row_id, error IS NULL AS is_valid, split_part(error, ':', 1) AS error,
  nullif(split_part(error, ':', 2), '') AS error_path FROM (
SELECT event_id AS row_id, CASE
  WHEN k = 4 THEN 'required:target_id'
  WHEN k = 1 THEN 'format:event_id'
  WHEN event_type = 'error' THEN 'enum:interaction_type'
  WHEN k = 3 THEN 'pattern:actor_id'
  WHEN (event_type = 'purchase' OR k = 7) AND k * 25 > 2000 THEN 'max_length:content'
  WHEN event_type = 'signup' AND k * 8 > 500 THEN 'max_length:comment_text'
  WHEN event_type = 'click' AND k = 8 THEN 'enum:reaction_type'
  WHEN event_type = 'purchase' AND k = 10 THEN 'max_items:media_urls'
  WHEN event_type = 'purchase' AND k % 9 = 0 THEN 'items_format:media_urls'
  WHEN event_type = 'view' AND k <> 7 THEN 'one_of:content,comment_text,reaction_type'
  WHEN event_type IN ('signup', 'click') AND k = 7
    THEN 'one_of:content,comment_text,reaction_type' END AS error FROM ev)""")
def _(t):
    checked = validate.validate_rows(schema_rows(t), validate.INTERACTION_RULES,
                                     validate.INTERACTION_PAYLOADS)
    return checked.select("row_id", "is_valid", "error", "error_path")


@query("flt_range_check", "interactions", """
SELECT event_id, duration_s / 300 BETWEEN 0 AND 1 AS ok,
  CASE WHEN duration_s / 300 BETWEEN 0 AND 1 THEN round(content_id * (duration_s / 300), 6) END AS score
FROM interactions""")
def _(t):
    rate = F.col("duration_s") / 300
    ok = validate.range_check(rate).isNull()
    return t.interactions.select("event_id", ok.alias("ok"), F.when(
        ok, F.round(F.col("content_id") * rate, 6)).alias("score"))


# Moderation.

EMOJI_SQL = f"(length(content) - length(regexp_replace(content, '[{fv.EMOJI_CLASS}]', '', 'g')))"
SPAM_SCORE_SQL = rf"""greatest(0.0::DOUBLE, least(1.0::DOUBLE, 0.5::DOUBLE
  - 0.3::DOUBLE * ((length(content) - length(replace(content, 'http', ''))) // 4)
  - 0.4::DOUBLE * (length(regexp_replace(content, '[^\p{{Lu}}]', '', 'g'))
      / greatest(length(content), 1))
  - 0.2::DOUBLE * (length(content) - length(replace(content, '!', '')))
  - 0.1::DOUBLE * {EMOJI_SQL}
  + 0.05::DOUBLE * (length(content) / 1000.0::DOUBLE)))"""
SPAM_SQL = f"""CASE
  WHEN regexp_matches(content, '{whole(fv.SPAM_PHRASES)}', 'i') THEN 'keyword_match'
  WHEN {EMOJI_SQL} > 10 THEN 'emoji_spam'
  WHEN {SPAM_SCORE_SQL} > 0.85 THEN 'ml_detected'
  WHEN REPUTATION < 20 THEN 'behavior_anomaly' ELSE 'clean' END"""
RATED_SPAM_SQL = SPAM_SQL.replace(
    "REPUTATION", "CASE user_id WHEN 'src14' THEN 10 ELSE 50 END")
CLEAN_SPAM_SQL = SPAM_SQL.replace("REPUTATION", "50")


@query("flt_spam", "text_posts", f"""
SELECT post_id, {RATED_SPAM_SQL} AS spam_reason FROM text_posts""")
def _(t):
    reputation = F.when(F.col("user_id") == "src14", 10)
    return moderation.with_spam_reason(t.text_posts, reputation).select("post_id", "spam_reason")


@query("map_spam_score", "text_posts",
       f"SELECT post_id, round({SPAM_SCORE_SQL}, 6) AS spam_score FROM text_posts")
def _(t):
    return t.text_posts.select(
        "post_id", F.round(moderation.spam_score(F.col("content")), 6).alias("spam_score"))


CLICKBAIT = "|".join(p.replace("'", "''") for p in fv.CLICKBAIT_PHRASES)
ACTION_SQL = f"""CASE WHEN regexp_matches(content, '{whole(fv.PROHIBITED_WORDS)}', 'i') THEN 'REMOVE'
  WHEN regexp_matches(content, '{whole(fv.MATURE_WORDS)}', 'i') THEN 'RESTRICT'
  WHEN regexp_matches(content, '{CLICKBAIT}', 'i') THEN 'DEPRIORITIZE' ELSE 'ALLOW' END"""
MATURE_COUNT = " + ".join(
    f"CAST(regexp_matches(content, '{whole([w])}', 'i') AS INTEGER)" for w in fv.MATURE_WORDS)
VIOLATIONS_SQL = f"""CASE action WHEN 'REMOVE' THEN 'prohibited_content'
  WHEN 'RESTRICT' THEN rtrim(repeat('mature_content,', {MATURE_COUNT}), ',')
  WHEN 'DEPRIORITIZE' THEN 'low_quality' ELSE '' END"""


@query("flt_policy", "text_posts", f"""
SELECT post_id, action, {VIOLATIONS_SQL} AS violations
FROM (SELECT post_id, content, {ACTION_SQL} AS action FROM text_posts)""")
def _(t):
    return moderation.with_policy(t.text_posts).select(
        "post_id", "policy.action", joined("policy.violations").alias("violations"))


REPUTATION_SQL = "CAST(50 + ('0x' || md5(user_id))::UHUGEINT % 50 AS BIGINT)"
CATEGORY_SQL = "CASE " + " ".join(
    f"WHEN {sql_any('lower(content)', words)} THEN '{name}'"
    for name, words in fv.CATEGORY_WORDS.items()) + " ELSE 'general' END"
PREDICTION_SQL = f"""round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, 0.5::DOUBLE
  + ({REPUTATION_SQL} - 50) / 100.0::DOUBLE * 0.3::DOUBLE
  + CASE WHEN length(content) > 500 THEN -0.1::DOUBLE WHEN length(content) < 50 THEN -0.2::DOUBLE
      ELSE 0.0::DOUBLE END
  + CASE WHEN has_image THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END)), 6)"""
SENTIMENT_SQL = f"""CASE
  WHEN {sql_hits('lower(content)', fv.POSITIVE_WORDS)} > {sql_hits('lower(content)', fv.NEGATIVE_WORDS)}
    THEN 'positive'
  WHEN {sql_hits('lower(content)', fv.NEGATIVE_WORDS)} > {sql_hits('lower(content)', fv.POSITIVE_WORDS)}
    THEN 'negative' ELSE 'neutral' END"""
ENRICH_SQL = f"""{REPUTATION_SQL} AS user_reputation, {CATEGORY_SQL} AS category,
  {PREDICTION_SQL} AS engagement_prediction, {SENTIMENT_SQL} AS sentiment"""


def enriched_columns():
    return ["user_reputation", "category",
            F.round("engagement_prediction", 6).alias("engagement_prediction"), "sentiment"]



@query("map_enrich_post", "text_posts", f"SELECT post_id, {ENRICH_SQL} FROM text_posts")
def _(t):
    return moderation.enrich(t.text_posts).select("post_id", *enriched_columns())


@query("map_moderation_flow", "text_posts", f"""
SELECT post_id, {ENRICH_SQL}, action AS policy_action, {VIOLATIONS_SQL} AS policy_violations
FROM (SELECT *, {ACTION_SQL} AS action, {CLEAN_SPAM_SQL} AS spam FROM text_posts)
WHERE spam = 'clean' AND action <> 'REMOVE'""")
def _(t):
    return moderation.moderate(t.text_posts).select(
        "post_id", *enriched_columns(), "policy_action",
        joined("policy_violations").alias("policy_violations"))


@query("flt_keyword_flag", "text_posts", f"""
SELECT post_id, 'content_violation' AS reason, 'high' AS severity FROM text_posts
WHERE {sql_any('lower(content)', fv.VIOLATION_WORDS)}""")
def _(t):
    return moderation.violation_flags(t.text_posts)


@query("flt_toxic", "text_posts", f"""
SELECT post_id, {sql_any('lower(content)', fv.TOXIC_WORDS)} AS is_toxic FROM text_posts""")
def _(t):
    return t.text_posts.select("post_id", moderation.is_toxic(F.col("content")).alias("is_toxic"))


@query("agg_funnel", "text_posts", f"""
WITH j AS (SELECT CASE WHEN spam = 'clean' THEN action END AS action, spam
  FROM (SELECT {ACTION_SQL} AS action, {CLEAN_SPAM_SQL} AS spam FROM text_posts))
SELECT 'received' AS stage, count(*) AS n FROM j
UNION ALL SELECT 'after_spam', count(*) FROM j WHERE spam = 'clean'
UNION ALL SELECT 'after_policy', count(*) FROM j WHERE action IN ('ALLOW', 'DEPRIORITIZE')
UNION ALL SELECT 'enriched', count(*) FROM j WHERE action <> 'REMOVE'
UNION ALL SELECT 'spam_keyword_match', count(*) FROM j WHERE spam = 'keyword_match'
UNION ALL SELECT 'spam_emoji_spam', count(*) FROM j WHERE spam = 'emoji_spam'
UNION ALL SELECT 'spam_ml_detected', count(*) FROM j WHERE spam = 'ml_detected'
UNION ALL SELECT 'spam_behavior_anomaly', count(*) FROM j WHERE spam = 'behavior_anomaly'
UNION ALL SELECT 'policy_REMOVE', count(*) FROM j WHERE action = 'REMOVE'
UNION ALL SELECT 'policy_RESTRICT', count(*) FROM j WHERE action = 'RESTRICT'""")
def _(t):
    return moderation.funnel(t.text_posts)


# Scores and features.

@query("map_weight", "interactions", """
SELECT event_id, CASE interaction_type WHEN 'VIEW' THEN 0.1::DOUBLE WHEN 'LIKE' THEN 1
  WHEN 'COMMENT' THEN 5 WHEN 'SHARE' THEN 10 ELSE 0 END AS weight FROM interactions""")
def _(t):
    return t.interactions.select(
        "event_id", scoring.window_weight(F.col("interaction_type")).alias("weight"))


AGE_SQL = f"(({AS_OF_S} - epoch_us(ts) // 1000000) / 3600.0::DOUBLE)"
RECENCY_SQL = f"""CASE WHEN {AGE_SQL} <= 1 THEN 1.0::DOUBLE WHEN {AGE_SQL} >= 24 THEN 0.3::DOUBLE
  ELSE exp(ln(0.3::DOUBLE) / 23 * ({AGE_SQL} - 1)) END"""
WEIGHT_SQL = """CASE interaction_type WHEN 'LIKE' THEN 1.0::DOUBLE WHEN 'SHARE' THEN 3
  WHEN 'COMMENT' THEN 2 ELSE 0.1 END"""


def signals(t, level):
    df = t.interactions.withColumn("ts_s", F.unix_seconds("ts"))
    return scoring.ranking_signals(df, AS_OF_S, level)


@query("map_recency_score", "interactions", f"""
SELECT event_id, round({WEIGHT_SQL} * {RECENCY_SQL} * 2, 4) AS engagement_score
FROM interactions""")
def _(t):
    return signals(t, "established_user").select("event_id", "engagement_score")


@query("map_ranking_signal", "interactions", f"""
SELECT user_id, content_id AS post_id, interaction_type, epoch_us(ts) // 1000000 AS ts_s,
  round({WEIGHT_SQL} * {RECENCY_SQL}, 4) AS engagement_score, round({RECENCY_SQL}, 4) AS recency_factor,
  1.0::DOUBLE AS user_reputation, {WEIGHT_SQL} AS base_weight
FROM interactions WHERE interaction_type <> 'UNKNOWN'""")
def _(t):
    return signals(t, "regular_user").filter(F.col("interaction_type") != "UNKNOWN").select(
        "user_id", F.col("content_id").alias("post_id"), "interaction_type", "ts_s",
        "engagement_score", "recency_factor", "user_reputation", "base_weight")


def feature_users(people):
    interests = F.when(F.col("tier") != "BUILDING", F.array("tier", "city")).otherwise(
        F.array().cast("array<string>"))
    return people.select(
        "user_id", F.floor("balance").alias("follower_count"),
        (F.col("age") * 100).alias("following_count"),
        (F.col("user_id") % 800).alias("account_age_days"),
        (F.col("balance") / 10000).alias("engagement_rate"), interests.alias("interests"))


FEATURE_USERS_SQL = """
SELECT user_id, least(floor(balance) / 10000, 1.0::DOUBLE) AS follower_count_normalized,
  CASE WHEN floor(balance) = 0 THEN 0.0::DOUBLE ELSE least(age * 100 / floor(balance), 10.0::DOUBLE) END
    AS following_ratio,
  least((user_id % 800) / 365.0::DOUBLE, 1.0::DOUBLE) AS account_maturity,
  balance / 10000 AS engagement_rate,
  CASE WHEN tier <> 'BUILDING' THEN 2::BIGINT ELSE 0::BIGINT END AS interest_count,
  CASE WHEN tier <> 'BUILDING' THEN 1::BIGINT ELSE 0::BIGINT END AS has_interests FROM """


def rounded(df, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if kind == "double" else F.col(c)
                       for c, kind in df.dtypes])


@query("map_user_features", "users", f"""
SELECT user_id, round(follower_count_normalized, 6) AS follower_count_normalized,
  round(following_ratio, 6) AS following_ratio, round(account_maturity, 6) AS account_maturity,
  round(engagement_rate, 6) AS engagement_rate, interest_count, has_interests
FROM ({FEATURE_USERS_SQL} users)""")
def _(t):
    return rounded(scoring.user_features(feature_users(t.users)))


PART_CATEGORY = {"ECONOMY": "technology", "PROMO": "news", "STANDARD": "sports",
                 "SMALL": "Gaming", "MEDIUM": "food"}


def feature_contents(t):
    tags = F.when(F.col("p_size") > 5, F.split("p_name", " ")).otherwise(
        F.array().cast("array<string>"))
    return t.part.select(
        F.col("p_partkey").alias("content_id"),
        (F.col("p_retailprice") / 10).alias("engagement_score"),
        ((F.col("p_size") - 1).cast("long") * 1000).alias("view_count"), tags.alias("tags"),
        lookup(F.col("p_type"), PART_CATEGORY, "other").alias("category"))


FEATURE_CONTENTS_SQL = """
SELECT p_partkey AS content_id, least(p_retailprice / 10 / 100, 1.0::DOUBLE)
    AS engagement_score_normalized,
  CASE WHEN p_size <= 1 THEN 0.0::DOUBLE ELSE log10((p_size - 1) * 1000 + 1) / 6 END AS view_count_log,
  CASE WHEN p_size > 5 THEN len(string_split(p_name, ' ')) ELSE 0 END::BIGINT AS tag_count,
  CASE p_type WHEN 'ECONOMY' THEN 4 WHEN 'PROMO' THEN 2 WHEN 'STANDARD' THEN 3 WHEN 'SMALL' THEN 6
    WHEN 'MEDIUM' THEN 9 ELSE 0 END::BIGINT AS category_encoded FROM part"""


@query("map_content_features", "", f"""
SELECT content_id, round(engagement_score_normalized, 6) AS engagement_score_normalized,
  round(view_count_log, 6) AS view_count_log, tag_count, category_encoded
FROM ({FEATURE_CONTENTS_SQL})""")
def _(t):
    return rounded(scoring.content_features(feature_contents(t)))


def engagement_features(t):
    kind = lookup(F.col("event_type"), {"click": "like", "signup": "comment", "purchase": "share",
                                        "view": "view"}, "scroll")
    df = t.ev.select("event_id", "user_id", F.col("k").alias("content_id"),
                     F.unix_seconds("ts").alias("ts_s"), kind.alias("event_type"),
                     F.col("value").alias("dwell_time"), (F.col("k") % 15).alias("interactions"),
                     (F.col("k") / 100).alias("viral_score"))
    return scoring.event_features(df)


FEATURES_SQL = """
SELECT event_id, user_id, k AS content_id, epoch_us(ts) // 1000000 AS ts_s,
  CASE event_type WHEN 'click' THEN 0.3::DOUBLE WHEN 'signup' THEN 0.5 WHEN 'purchase' THEN 0.8
    ELSE 0.1 END AS engagement_weight, least(value / 300, 1.0::DOUBLE) AS dwell,
  least((k % 15) / 10.0::DOUBLE, 1.0::DOUBLE) AS interaction_depth, k / 100.0::DOUBLE AS virality_signal
FROM ev"""


@query("map_event_features", "ev", f"""
SELECT event_id, engagement_weight, round(dwell, 6) AS dwell, interaction_depth, virality_signal
FROM ({FEATURES_SQL})""")
def _(t):
    return engagement_features(t).select(
        "event_id", "engagement_weight", F.round("dwell", 6).alias("dwell"), "interaction_depth",
        "virality_signal")


CONTENT_SCORE_SQL = f"""
WITH f AS ({FEATURES_SQL}),
u AS (SELECT *, count(*) OVER (PARTITION BY user_id, content_id) AS update_count FROM f
  QUALIFY row_number() OVER (PARTITION BY user_id, content_id, ts_s ORDER BY event_id DESC) = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, content_id ORDER BY ts_s DESC, event_id DESC)
    AS rn FROM u),
g AS (SELECT user_id, content_id, max(update_count) AS update_count,
    sum(engagement_weight * exp(-0.1::DOUBLE * ({AS_OF_S} - ts_s) / 86400.0::DOUBLE)) / count(*) AS past,
    max(CASE WHEN rn = 1 THEN engagement_weight END) AS w,
    max(CASE WHEN rn = 1 THEN virality_signal END) AS v, max(ts_s) AS ts_s
  FROM r WHERE rn <= 10 GROUP BY user_id, content_id),
s AS (SELECT user_id, content_id, update_count, least((past + w) / 2, 1.0::DOUBLE) AS engagement,
    CAST(('0x' || md5(CAST(user_id AS VARCHAR)))::UHUGEINT % 100 AS BIGINT) / 100.0::DOUBLE AS relevance,
    v AS virality, exp(-ln(2.0::DOUBLE) * ({AS_OF_S} - ts_s) / 3600.0::DOUBLE / 24) AS freshness FROM g)
SELECT user_id, content_id, update_count, round(engagement, 6) AS engagement, relevance, virality,
  round(freshness, 6) AS freshness, round(0.4::DOUBLE * engagement + 0.3::DOUBLE * relevance
    + 0.2::DOUBLE * virality + 0.1::DOUBLE * freshness, 6) AS total_score FROM s"""


def content_score_rows(t):
    scores = scoring.content_scores(engagement_features(t), AS_OF_S)
    return scores.select(
        "user_id", "content_id", "update_count", F.round("engagement", 6).alias("engagement"),
        "relevance", "virality", F.round("freshness", 6).alias("freshness"),
        F.round("total_score", 6).alias("total_score"))


@query("agg_content_score", "ev", CONTENT_SCORE_SQL)
def _(t):
    return content_score_rows(t)


@query("agg_recommend_topk", "ev", f"""
SELECT user_id, count(*) AS n, string_agg(content_id, ',' ORDER BY rank) AS contents,
  round(sum(total_score), 6) AS score_sum
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY total_score DESC, content_id) AS rank
  FROM ({CONTENT_SCORE_SQL})) WHERE rank <= 50 GROUP BY user_id""")
def _(t):
    lists = scoring.recommendations(content_score_rows(t))
    return lists.select(
        "user_id", "n",
        joined(F.transform("items", lambda i: i.content_id.cast("string"))).alias("contents"),
        F.round(F.aggregate("items", F.lit(0.0), lambda a, i: a + i.total_score), 6)
        .alias("score_sum"))


@query("join_feature_lookup", "interactions profiles", f"""
SELECT i.event_id, i.user_id, i.content_id,
  CASE interaction_type WHEN 'VIEW' THEN 1 WHEN 'LIKE' THEN 2 WHEN 'COMMENT' THEN 3 WHEN 'SHARE' THEN 4
    ELSE 0 END::BIGINT AS interaction_type_encoded,
  round(least(duration_s / 300, 1.0::DOUBLE), 6) AS duration_normalized,
  round(u.follower_count_normalized, 6) AS user_follower_norm,
  round(u.engagement_rate, 6) AS user_engagement, round(u.account_maturity, 6) AS user_maturity,
  round(c.engagement_score_normalized, 6) AS content_engagement,
  round(c.view_count_log, 6) AS content_views_log, c.category_encoded AS content_category
FROM interactions i LEFT JOIN ({FEATURE_USERS_SQL} profiles) u USING (user_id)
LEFT JOIN ({FEATURE_CONTENTS_SQL}) c USING (content_id)""")
def _(t):
    inter = t.interactions.select("event_id", "user_id", "content_id", "interaction_type",
                                  F.col("duration_s").alias("duration_seconds"))
    out = scoring.with_feature_lookup(inter, scoring.user_features(feature_users(t.profiles)),
                                      scoring.content_features(feature_contents(t)))
    return rounded(out.drop("interaction_type", "duration_seconds"))


# Mapping of messages.

@query("map_platform_normalize", "ev", """
SELECT CASE WHEN k <> 9 THEN CAST(user_id AS VARCHAR) END AS user_id, 'p' || k AS post_id,
  lower(event_type) AS action,
  CASE event_type WHEN 'click' THEN epoch_us(ts) // 1000000 * 1000 WHEN 'view'
    THEN epoch_us(ts) // 1000000 * 1000 ELSE epoch_us(ts) // 1000 END AS timestamp,
  CASE event_type WHEN 'click' THEN 'ios' WHEN 'view' THEN 'android' ELSE 'web' END AS source
FROM ev WHERE k <> 9""")
def _(t):
    ev = t.ev.withColumn("user_id", F.when(F.col("k") != 9, F.col("user_id")))
    post = F.concat(F.lit("p"), F.col("k"))
    kind = F.upper("event_type")
    return messages.normalize_platforms({
        "ios": ev.filter("event_type = 'click'").select(
            F.col("user_id").alias("user"), post.alias("postId"), kind.alias("action"),
            F.unix_seconds("ts").alias("ts")),
        "android": ev.filter("event_type = 'view'").select(
            F.col("user_id").alias("userId"), post.alias("post_id"), kind.alias("event_type"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp")),
        "web": ev.filter("event_type NOT IN ('click', 'view')").select(
            "user_id", post.alias("target"), kind.alias("reaction_kind"),
            F.unix_millis("ts").alias("occurred_at")),
    })


def versioned_users(t):
    version = lookup(F.col("tier"), {"AUTOMOBILE": "v1", "BUILDING": "v2", "FURNITURE": "v3",
                                     "HOUSEHOLD": "v9"}, "v3")
    return t.users.select(
        "user_id", F.when(F.col("age") > 20, version).alias("schema_version"),
        F.when(F.col("age") % 2 == 0, F.concat(F.lit("http://a/"), F.col("user_id")))
        .alias("avatar_url"),
        F.when(F.col("age") % 3 == 0, F.lit("gold")).alias("premium_badge"),
        F.lit("pro").alias("subscription_tier"))


VERSIONED_SQL = """
SELECT user_id, coalesce(CASE WHEN age > 20 THEN CASE tier WHEN 'AUTOMOBILE' THEN 'v1'
  WHEN 'BUILDING' THEN 'v2' WHEN 'FURNITURE' THEN 'v3' WHEN 'HOUSEHOLD' THEN 'v9' ELSE 'v3' END END,
  'v1') AS version, age FROM users"""


@query("map_version_normalize", "users", f"""
SELECT user_id, version,
  CASE WHEN version IN ('v2', 'v3') AND age % 2 = 0 THEN 'http://a/' || user_id END AS avatar_url,
  CASE WHEN version = 'v3' AND age % 3 = 0 THEN 'gold' END AS premium_badge,
  CASE WHEN version = 'v3' THEN 'pro' END AS subscription_tier,
  version IN ('v2', 'v3') AND age % 2 = 0 AS has_avatar, version = 'v3' AND age % 3 = 0 AS is_premium,
  CASE WHEN version NOT IN ('v1', 'v2', 'v3') THEN 'Unknown schema version: ' || version END AS error
FROM ({VERSIONED_SQL})""")
def _(t):
    return messages.normalize_versions(versioned_users(t))


@query("map_version_detect", "posts", """
SELECT post_id, CASE WHEN media_type = 'video' THEN 'v3' WHEN k % 3 = 0 THEN 'v2' ELSE 'v1' END AS version,
  CASE WHEN media_type = 'video' AND k % 3 = 0
      THEN 'Poll(q' || k || ', 2 options), Media(video, ' || len(hashtags) || ' items)'
    WHEN media_type = 'video' THEN 'Media(video, ' || len(hashtags) || ' items)'
    WHEN k % 3 = 0 THEN 'Poll(q' || k || ', 2 options)' ELSE 'none' END AS extras
FROM posts""")
def _(t):
    poll = F.when(F.col("k") % 3 == 0, F.struct(
        F.concat(F.lit("q"), F.col("k")).alias("question"),
        F.array(F.lit("yes"), F.lit("no")).alias("options")))
    media = F.when(F.col("media_type") == "video", F.struct(
        "media_type", F.col("hashtags").alias("urls")))
    df = t.posts.withColumn("poll_data", poll).withColumn("media", media)
    return df.select("post_id", messages.detect_version().alias("version"),
                     messages.version_extras().alias("extras"))


@query("map_headers", "ev", """
SELECT event_id, CASE WHEN k % 4 <> 0 AND k % 6 <> 0 THEN 't' || k END AS trace_id,
  CASE WHEN k % 4 <> 0 AND k % 6 <> 0 THEN 's' || event_id END AS span_id,
  CASE WHEN k % 4 <> 0 AND k % 6 <> 0 THEN event_type END AS service_name,
  CASE WHEN k % 5 <> 0 THEN 'beta' END AS user_segment,
  CASE WHEN k % 5 <> 0 THEN k % 2 = 0 END AS enhanced,
  50 + CASE WHEN k % 5 <> 0 AND k % 2 = 0 THEN 30 ELSE 0 END
    + CASE WHEN k % 5 <> 0 AND k % 3 = 0 THEN 25 ELSE 0 END::BIGINT AS processing_ms
FROM ev""")
def _(t):
    k = F.col("k")

    def header(key, value):
        return F.struct(F.lit(key).alias("key"), value.alias("value"))

    flags = F.to_json(F.struct((k % 2 == 0).alias("enhanced_recommendations"),
                               (k % 3 == 0).alias("new_feed_algorithm")))
    headers = F.array(
        header("trace-id", F.when(k % 4 != 0, F.concat(F.lit("t"), k)).otherwise(F.lit(""))),
        header("span-id", F.when(k % 6 != 0, F.concat(F.lit("s"), F.col("event_id")))),
        header("service-name", F.lit("stale")), header("service-name", F.col("event_type")),
        header("feature-flags", flags),
        header("user-segment", F.when(k % 5 != 0, F.lit("beta"))))
    out = messages.with_headers(t.ev.select("event_id", headers.alias("headers")))
    return out.select("event_id", "trace_id", "span_id", "service_name", "user_segment",
                      F.element_at("flags", F.lit("enhanced_recommendations")).alias("enhanced"),
                      F.col("processing_ms").cast("long").alias("processing_ms"))


@query("map_key_partition", "ev", """
SELECT event_id, CAST(('0x' || md5('user_' || user_id))::UHUGEINT % 1000 AS BIGINT) AS partition
FROM ev""")
def _(t):
    return t.ev.select("event_id", messages.key_partition("user_", F.col("user_id"), 1000)
                       .alias("partition"))


REGION_NAMES = list(fv.REGION_PARTITIONS)


@query("map_geo_partition", "ev", f"""
WITH r AS (SELECT event_id, k, CASE WHEN k % 14 = 12 THEN 'MOON' WHEN k % 14 = 13 THEN NULL
    ELSE ([{sql_list(REGION_NAMES)}])[k % 14 + 1] END AS region FROM ev),
p AS (SELECT event_id, k, region, CASE region {" ".join(
    f"WHEN '{name}' THEN {parts}" for name, parts in fv.REGION_PARTITIONS.items())}
    WHEN 'MOON' THEN NULL ELSE [0, 1, 2] END AS prefs FROM r)
SELECT event_id, CASE
  WHEN k = 99 THEN CAST(('0x' || md5('v' || event_id))::UHUGEINT % 12 AS BIGINT)
  WHEN prefs IS NULL THEN 0
  ELSE coalesce(list_filter(prefs, lambda p: list_contains([1, 2, 5, 6, 8], p))[1], prefs[1]) END::BIGINT
  AS partition FROM p""")
def _(t):
    k = F.col("k")
    names = F.array(*[F.lit(n) for n in REGION_NAMES])
    region = first_match([(k % 14 == 12, "MOON"), (k % 14 < 12, F.try_element_at(
        names, (k % 14 + 1).cast("int")))])
    key = F.when(k != 99, F.concat_ws(":", F.concat(F.lit("user"), F.col("user_id")), region))
    healthy = F.array(*[F.lit(p) for p in (1, 2, 5, 6, 8)])
    return t.ev.select("event_id", messages.geo_partition(
        key, healthy, F.concat(F.lit("v"), F.col("event_id"))).alias("partition"))


@query("map_notification", "ev", """
SELECT 'domain' AS origin, CAST(user_id AS VARCHAR) AS recipient, event_type AS type,
  CASE event_type WHEN 'signup' THEN 'Welcome to the network, name' || user_id
      || '! Start sharing your thoughts.'
    WHEN 'view' THEN 'Your post ' || left('post' || (event_id + 1000000), 8) || '... is now live!'
    ELSE 'You liked post ' || left('post' || (event_id + 1000000), 8) || '...' END AS message
FROM ev WHERE event_type IN ('signup', 'view', 'click')
UNION ALL
SELECT 'social', CASE event_type WHEN 'view' THEN CAST(k AS VARCHAR)
    ELSE CAST(k AS VARCHAR) END,
  CASE event_type WHEN 'view' THEN 'new_follower' ELSE 'comment' END,
  'User ' || user_id || CASE event_type WHEN 'view' THEN ' started following you'
    ELSE ' commented on your post' END
FROM ev WHERE event_type = 'view' OR (event_type = 'signup' AND k <> user_id)""")
def _(t):
    post = F.concat(F.lit("post"), F.col("event_id") + 1000000)
    domain = messages.domain_notifications(t.ev.select(
        F.col("user_id"), F.concat(F.lit("name"), F.col("user_id")).alias("username"),
        post.alias("post_id"), "event_type").withColumn("raw", F.col("event_type")).withColumn(
        "event_type", lookup(F.col("raw"), {"signup": "UserRegistered", "view": "PostCreated",
                                            "click": "PostLiked"}, "Other")))
    back = lookup(F.col("event_type"), {"UserRegistered": "signup", "PostCreated": "view",
                                        "PostLiked": "click"}, "")
    social = messages.social_notifications(t.ev.select(
        "user_id", F.col("k").alias("followed_user_id"), F.col("k").alias("post_owner_id"),
        lookup(F.col("event_type"), {"view": "follow", "signup": "comment"}, "other")
        .alias("event_type")))
    return (domain.select(F.lit("domain").alias("origin"),
                          F.col("user_id").cast("string").alias("recipient"),
                          back.alias("type"), "message")
            .unionByName(social.select(F.lit("social").alias("origin"),
                                       F.col("recipient").cast("string").alias("recipient"),
                                       "type", "message")))


def failures(t):
    """Failed records: class and message by attributes of the event."""
    cls = F.element_at(F.array(*[F.lit(c) for c in FAILURE_CLASSES]),
                       (F.col("k") % len(FAILURE_CLASSES) + 1).cast("int"))
    msg = F.element_at(F.array(*[F.lit(m) for m in FAILURE_MESSAGES]),
                       (F.col("k") % 7 + 1).cast("int"))
    return t.ev.select("event_id", "user_id", "ts", cls.alias("error_class"),
                       msg.alias("error_message"), (F.col("k") % 8).alias("attempts"))


FAILURE_CLASSES = ["JSONDecodeError", "KeyError", "ValueError", "ConnectionError", "MemoryError",
                   "RuntimeError", "OSError", "AuthenticationFailedError",
                   "ConnectionResetError", "UnicodeDecodeError"]
FAILURE_MESSAGES = ["bad Emoji", "Timeout of broker", "Permission denied", "ServiceUnavailable: x",
                    "RateLimitExceeded", "tags missing", "other"]
FAILURES_SQL = f"""
SELECT event_id, user_id, ts, ([{sql_list(FAILURE_CLASSES)}])[k % {len(FAILURE_CLASSES)} + 1] AS error_class,
  ([{sql_list(FAILURE_MESSAGES)}])[k % 7 + 1] AS error_message, k % 8 AS attempts FROM ev"""


@query("map_error_class", "ev", f"""
SELECT event_id, action, action = 'skip' OR (action = 'retry' AND attempts > 5) AS skipped,
  CASE WHEN error_class IN ('ConnectionError', 'OSError') THEN 'transient'
    WHEN error_class IN ('AuthenticationFailedError', 'ValueError') THEN 'permanent'
    WHEN error_message = 'Timeout of broker' THEN 'transient'
    WHEN error_message = 'Permission denied' THEN 'permanent' ELSE 'unknown' END AS kind,
  error_message IN ('ServiceUnavailable: x', 'RateLimitExceeded') OR error_class = 'ConnectionError'
    AS retryable
FROM (SELECT *, CASE
    WHEN error_class = 'JSONDecodeError' THEN
      CASE WHEN error_message IN ('bad Emoji', 'tags missing') THEN 'skip' ELSE 'dlq' END
    WHEN error_class IN ('KeyError', 'ValueError', 'UnicodeDecodeError') THEN
      CASE WHEN attempts < 3 THEN 'retry' ELSE 'dlq' END
    WHEN error_class IN ('ConnectionError', 'ConnectionResetError') THEN 'retry' WHEN error_class = 'MemoryError' THEN 'fatal'
    ELSE 'dlq' END AS action FROM ({FAILURES_SQL}))""")
def _(t):
    cls, msg, n = F.col("error_class"), F.col("error_message"), F.col("attempts")
    action = validate.error_action(cls, msg, n)
    return failures(t).withColumn("action", action).select(
        "event_id", "action", validate.should_skip(F.col("action"), n).alias("skipped"),
        validate.failure_kind(cls, msg).alias("kind"),
        validate.retryable(cls, msg).alias("retryable"))


@query("map_backoff", "ev", """
SELECT event_id, least(100.0::DOUBLE * pow(2.0::DOUBLE, k), 30000.0::DOUBLE) AS delay_ms FROM ev""")
def _(t):
    return t.ev.select("event_id", validate.backoff(F.col("k"), 100, 2, 30000).alias("delay_ms"))


def json_logs(t):
    """Log lines of which every second one hides its fields inside the message."""
    structured = F.col("event_id") % 2 == 0
    body = F.to_json(F.struct("level", "trace_id", "error", "latency_ms"))
    return t.logs.select(
        "event_id", "ts", "logger", F.when(structured, F.col("level")).alias("level"),
        F.when(structured, F.col("trace_id")).alias("trace_id"),
        F.when(structured, F.col("error")).alias("error"),
        F.when(structured, F.col("latency_ms")).alias("latency_ms"),
        F.when(structured, F.concat(F.lit("handled "), F.col("logger"))).otherwise(body)
        .alias("message"))


@query("map_log_parse", "logs", """
SELECT event_id, level, trace_id, error, latency_ms FROM logs""")
def _(t):
    fields = ["level", "trace_id", "error"]
    return json_logs(t).select(
        "event_id", *[messages.log_field(f, f).alias(f) for f in fields],
        F.coalesce("latency_ms", messages.log_field("latency_ms").try_cast("double"))
        .alias("latency_ms"))


@query("map_post_metric", "text_posts", """
SELECT post_id, user_id, length(content) AS content_length FROM text_posts""")
def _(t):
    return messages.post_metrics(t.text_posts.withColumn("ts", F.lit(AS_OF_S))).drop("ts")


# Flattening.

@query("flat_hashtags", "posts", rf"""
SELECT post_id, user_id, unnest(regexp_extract_all(lower(content), '#({WORD}+)', 1)) AS tag
FROM posts""")
def _(t):
    return messages.hashtag_occurrences(t.posts).select("post_id", "user_id", "tag")


@query("flat_hashtags_min2", "text_posts", rf"""
SELECT * FROM (SELECT post_id, user_id, unnest(regexp_extract_all(lower(content), '#({WORD}+)', 1)) AS tag
FROM text_posts) WHERE length(tag) >= 2""")
def _(t):
    return messages.hashtag_occurrences(t.text_posts, 2).select("post_id", "user_id", "tag")


@query("flat_mentions_tags", "text_posts", rf"""
SELECT post_id, user_id, 'mention_notification' AS type,
  unnest(regexp_extract_all(content, '@({WORD}+)', 1)[1:10]) AS target,
  left(content, 100) AS content_preview FROM text_posts
UNION ALL SELECT post_id, user_id, 'hashtag_index',
  lower(unnest(regexp_extract_all(content, '#({WORD}+)', 1)[1:10])), NULL FROM text_posts""")
def _(t):
    return messages.mention_and_tag_events(t.text_posts)


USER_METRICS_SQL = """
SELECT user_id, 'total_view_time' AS metric_type, duration_s AS metric_value, ts FROM interactions
  WHERE interaction_type = 'VIEW'
UNION ALL SELECT user_id, 'view_count', 1.0::DOUBLE, ts FROM interactions WHERE interaction_type = 'VIEW'
UNION ALL SELECT user_id, lower(interaction_type) || '_count', 1.0::DOUBLE, ts FROM interactions
  WHERE interaction_type IN ('LIKE', 'SHARE', 'COMMENT')
UNION ALL SELECT user_id, 'engagement_score', CASE interaction_type WHEN 'LIKE' THEN 1.0::DOUBLE
  WHEN 'SHARE' THEN 3 ELSE 2 END, ts FROM interactions
  WHERE interaction_type IN ('LIKE', 'SHARE', 'COMMENT')"""


def user_metrics(t):
    return messages.user_metric_rows(t.interactions.withColumnRenamed("duration_s", "duration"))


@query("flat_user_metrics", "interactions", f"""
SELECT user_id, metric_type, metric_value FROM ({USER_METRICS_SQL})""")
def _(t):
    return user_metrics(t).drop("ts")


@query("proj_posts_enriched", "posts", """
SELECT post_id, user_id, content, array_to_string(hashtags, ',') AS hashtags, media_type,
  epoch_us(ts) // 1000 AS timestamp_ms, 0::BIGINT AS like_count, 0::BIGINT AS comment_count FROM posts""")
def _(t):
    return t.posts.select(
        "post_id", "user_id", "content", joined("hashtags").alias("hashtags"), "media_type",
        F.unix_millis("ts").alias("timestamp_ms"), F.lit(0).cast("long").alias("like_count"),
        F.lit(0).cast("long").alias("comment_count"))

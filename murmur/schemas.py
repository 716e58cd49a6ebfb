"""Schemas of the entities that arrive as messages."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt"


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


LONG, INT, TEXT, REAL, FLAG = (
    T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.BooleanType())
TEXTS, WEIGHTS = T.ArrayType(TEXT), T.MapType(TEXT, REAL)

POST = _schema(post_id=LONG, user_id=LONG, content=TEXT, hashtags=TEXTS, created_at=TEXT,
               media_type=TEXT, timestamp=LONG)
LIKE = _schema(like_id=LONG, post_id=LONG, user_id=LONG, created_at=TEXT, timestamp=LONG)
COMMENT = _schema(comment_id=LONG, post_id=LONG, user_id=LONG, content=TEXT, created_at=TEXT,
                  timestamp=LONG)
VIEW = _schema(view_id=LONG, post_id=LONG, user_id=LONG, duration_ms=INT, timestamp=LONG)
INTERACTION = _schema(user_id=TEXT, post_id=TEXT, interaction_type=TEXT, timestamp=REAL,
                      content_id=TEXT, metadata=T.MapType(TEXT, TEXT))
ACTION = _schema(user_id=TEXT, action_type=TEXT, target_id=TEXT, timestamp=LONG)
PROFILE = _schema(user_id=LONG, username=TEXT, email=TEXT, follower_count=LONG,
                  following_count=LONG, account_age_days=LONG, engagement_rate=REAL,
                  interests=TEXTS, updated_at=TEXT)
PREFERENCE = _schema(user_id=TEXT, languages=TEXTS, categories=TEXTS, topics=TEXTS,
                     weights=WEIGHTS, updated_at=TEXT)
CONTENT = _schema(content_id=TEXT, language=TEXT, category=TEXT, tags=TEXTS, created_at=TEXT,
                  updated_at=TEXT)
PAYMENT = _schema(id=TEXT, user_id=TEXT, amount=REAL, currency=TEXT, payment_method=TEXT,
                  idempotency_key=TEXT, status=TEXT, created_at=TEXT)
TIMELINE = _schema(user_id=TEXT, content=TEXT, timestamp=REAL, partition=INT, offset=LONG)
LOG_LINE = _schema(**{"@timestamp": TEXT, "level": TEXT, "logger_name": TEXT, "message": TEXT,
                      "trace_id": TEXT, "error": TEXT, "latency_ms": REAL})
AUTH = _schema(username=TEXT, mechanism=TEXT, success=FLAG, latency_ms=REAL)
BROKER = _schema(broker_id=INT, messages_in=REAL, bytes_in=REAL, bytes_out=REAL,
                 request_idle=REAL, network_idle=REAL, under_replicated=INT, offline=INT,
                 partitions=INT, isr_shrinks=REAL)
TABLE_EVENT = T.StructType([
    T.StructField("event_id", LONG), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", LONG), T.StructField("event_type", TEXT),
    T.StructField("value", REAL), T.StructField("props", TEXT)])


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, TEXT, True)])

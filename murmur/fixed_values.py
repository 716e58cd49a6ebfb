"""Word lists, weights, limits and tables that results depend on.

They are data, not logic, and must keep exactly these values.
"""

# Moderation.
SPAM_PHRASES = [
    "buy now", "click here", "limited time", "act fast",
    "free money", "get rich", "guaranteed", "100% free",
    "no cost", "risk free", "call now", "order now",
]
SPAM_SCORE_LIMIT = 0.85
SPAM_EMOJI_LIMIT = 10
SPAM_MIN_REPUTATION = 20
DEFAULT_REPUTATION = 50
EMOJI_CLASS = r"\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}"
SPAM_WEIGHTS = {
    "base": 0.5, "url_count": -0.3, "all_caps_ratio": -0.4,
    "exclamation_count": -0.2, "emoji_count": -0.1, "content_length": 0.05,
}
PROHIBITED_WORDS = ["violence", "illegal", "explicit"]
MATURE_WORDS = ["alcohol", "gambling", "mature"]
CLICKBAIT_PHRASES = ["you won't believe", "shocking", "doctors hate", "this one trick"]
VIOLATION_WORDS = ["spam", "inappropriate", "banned"]
TOXIC_WORDS = ["spam", "scam", "hate", "violence"]
BOT_PATTERN = "(?i)bot|spam|fake"
MAX_TAGS_PER_POST = 10
MAX_MENTIONS_PER_POST = 10

# Enrichment of posts.
CATEGORY_WORDS = {
    "technology": ["tech", "ai", "software", "programming", "code"],
    "sports": ["game", "team", "player", "score", "win"],
    "news": ["breaking", "report", "update", "announced"],
    "entertainment": ["movie", "music", "show", "concert", "actor"],
}
DEFAULT_CATEGORY = "general"
POSITIVE_WORDS = ["love", "great", "awesome", "amazing", "happy"]
NEGATIVE_WORDS = ["hate", "bad", "terrible", "awful", "sad"]

# Interaction weights. Every score has a table of its own.
WINDOW_SCORE_WEIGHTS = {"VIEW": 0.1, "LIKE": 1.0, "COMMENT": 5.0, "SHARE": 10.0}
RECENCY_WEIGHTS = {"LIKE": 1.0, "SHARE": 3.0, "COMMENT": 2.0, "VIEW": 0.1}
RECENCY_DEFAULT_WEIGHT = 0.1
REPUTATION_LEVELS = {"new_user": 0.5, "regular_user": 1.0, "established_user": 2.0}
RECENCY_FLOOR = 0.3
REPUTATION_POINTS = {"LIKE": 1, "COMMENT": 2, "SHARE": 5}
TIERS = [("platinum", 2000), ("gold", 500), ("silver", 100), ("bronze", None)]
METRIC_POINTS = {"LIKE": 1, "SHARE": 3, "COMMENT": 2}
DECAY_POINTS = {"LIKE": 1.0, "COMMENT": 2.0, "SHARE": 3.0}
FEATURE_WEIGHTS = {"view": 0.1, "like": 0.3, "comment": 0.5, "share": 0.8, "bookmark": 0.6}
FEATURE_DEFAULT_WEIGHT = 0.1
CONTENT_SCORE_WEIGHTS = {"engagement": 0.4, "relevance": 0.3, "virality": 0.2, "freshness": 0.1}
RECOMMENDATIONS_PER_USER = 50

# Feature codes.
CATEGORY_CODES = {
    "entertainment": 1, "news": 2, "sports": 3, "technology": 4, "music": 5, "gaming": 6,
    "education": 7, "lifestyle": 8, "food": 9, "travel": 10, "unknown": 0,
}
INTERACTION_CODES = {"view": 1, "like": 2, "comment": 3, "share": 4, "save": 5, "click": 6}

# Trends.
TREND_MIN_MENTIONS = 5
TREND_WEIGHTS = {"velocity": 0.5, "engagement": 0.3, "recency": 0.2}
TREND_DECAY_RATE = 0.95
TREND_TOP_K = 100
WORKER_WINDOW_SECONDS = 300
WORKER_MIN_MENTIONS = 3

# Matching of preferences and content.
MATCH_WEIGHTS = {"language": 0.3, "category": 0.4, "topics": 0.2}
MATCH_MIN_SCORE = 0.5
MATCH_HIGH_SCORE = 0.7

# Errors.
RECOVERABLE_JSON_HINTS = ["emoji", "optional_metadata", "tags", "extra_data"]
ERROR_BASES = {
    "ConnectionResetError": "ConnectionError", "ConnectionRefusedError": "ConnectionError",
    "ConnectionAbortedError": "ConnectionError", "BrokenPipeError": "ConnectionError",
    "UnicodeError": "ValueError", "UnicodeDecodeError": "ValueError",
    "UnicodeEncodeError": "ValueError", "UnicodeTranslateError": "ValueError",
}
TRANSIENT_ERRORS = ["KafkaTimeoutError", "RequestTimedOutError", "ConnectionError", "OSError"]
PERMANENT_ERRORS = [
    "AuthenticationFailedError", "TopicAuthorizationFailedError", "ValueError", "TypeError"]
TRANSIENT_HINTS = ["timeout", "connection", "network"]
PERMANENT_HINTS = ["unauthorized", "authentication", "permission"]
RETRYABLE_ERRORS = ["ServiceUnavailable", "TimeoutError", "RateLimitExceeded", "ConnectionError"]

# Interaction schema.
SCHEMA_INTERACTION_TYPES = ["like", "comment", "share", "follow", "unfollow", "post_created"]
SCHEMA_REACTIONS = ["like", "love", "angry", "sad", "wow"]
SCHEMA_CLIENTS = ["web", "mobile", "api"]
SCHEMA_ACTOR_PATTERN = "^[a-zA-Z0-9_]{3,30}$"

# Regions and their preferred partitions.
REGION_PARTITIONS = {
    "US_EAST": [0, 1, 2], "US_WEST": [1, 2, 0], "CANADA": [2, 0, 1],
    "UK": [3, 4, 5], "GERMANY": [4, 5, 3], "FRANCE": [5, 3, 4],
    "JAPAN": [6, 7, 8], "SINGAPORE": [7, 8, 6], "AUSTRALIA": [8, 6, 7],
    "BRAZIL": [9, 10, 11], "INDIA": [10, 11, 9], "SOUTH_AFRICA": [11, 9, 10],
}
DEFAULT_REGION = "US_EAST"

# File types.
MIME_TYPES = {
    ".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".png": "image/png", ".gif": "image/gif",
    ".txt": "text/plain", ".pdf": "application/pdf", ".mp4": "video/mp4", ".avi": "video/avi",
}
DEFAULT_MIME_TYPE = "application/octet-stream"

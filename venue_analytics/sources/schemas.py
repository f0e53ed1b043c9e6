"""Declared schemas of the four source collections and the domain constants."""

from pyspark.sql import types as T

S, L, TS = T.StringType(), T.LongType(), T.TimestampType()

POSTS = T.StructType([
    T.StructField("id", S),
    T.StructField("post_time", TS),
    T.StructField("secondary_venue_ids", T.ArrayType(S)),
    T.StructField("kind", S),
    T.StructField("text", S),
    T.StructField("poster_id", S),
    T.StructField("rating", T.StructType([T.StructField("value", S), T.StructField("scale", T.IntegerType())])),
    T.StructField("tag_ids", T.ArrayType(S)),
])

PLACES = T.StructType([
    T.StructField("id", S),
    T.StructField("name", S),
    T.StructField("merchant_id", S),
    T.StructField("venue_ids", T.ArrayType(S)),
])

ACCOUNT = T.StructType([T.StructField("account_id", S), T.StructField("name", S)])

MERCHANTS = T.StructType([
    T.StructField("id", S),
    T.StructField("name", S),
    T.StructField("subscription", T.StructType([T.StructField("expires_at", TS)])),
    T.StructField("linked_accounts", T.MapType(S, T.ArrayType(ACCOUNT))),
])

_ACTOR = T.StructType([T.StructField("type", S), T.StructField("object_id", S), T.StructField("label", S)])
_SUBJECT = T.StructType([T.StructField("type", S), T.StructField("origin_id", S), T.StructField("label", S)])

AUDITS = T.StructType([
    T.StructField("id", S),
    T.StructField("category", S),
    T.StructField("type", S),
    T.StructField("merchant_id", S),
    T.StructField("created_at", TS),
    T.StructField("actor", _ACTOR),
    T.StructField("subject", _SUBJECT),
])

VENUES = T.StructType([T.StructField("id", S), T.StructField("type", S), T.StructField("term", S)])

# Flat own-account relation: one row per (merchant, poster id such as 'FB-123').
ACCOUNTS = T.StructType([T.StructField("merchant_id", S), T.StructField("poster_id", S)])

SCHEMAS = {"posts": POSTS, "places": PLACES, "merchants": MERCHANTS, "audits": AUDITS,
           "venues": VENUES, "accounts": ACCOUNTS}

# ---------------------------------------------------------------------------------------------
# These must equal the reference's for right results.
# Sources, zero-filled in that order in the flat maps.
SOURCES = ["FB", "IG", "TW", "4S", "WB"]
# Linked-account service -> source code.
SERVICE_SOURCE = {"facebook": "FB", "facebookpages": "FB", "instagram": "IG",
                  "twitter": "TW", "foursquare": "4S", "weibo": "WB"}
# Zero-filled kinds of the content report.
KINDS = ["photo", "video", "feed", "tip"]
# Interaction types, zero-filled in the interactions report ('int' = liked or replied post).
INTERACTION_TYPES = ["like", "reply", "int", "tag", "follow"]
# Audit types the interaction reports read.
AUDIT_TYPES = ["like", "reply", "tag", "follow"]
# Star ratings of the reviews report (FB only).
RATINGS = ["1", "2", "3", "4", "5"]
REVIEW_SOURCES = ["FB"]
# Segment keys: hours '00'..'23' plus 'total' (built from the rule below, not listed).
HOURS = ["%02d" % h for h in range(24)]
SEGMENT_KEYS = HOURS + ["total"]
# Punctuation removed from a word's two ends by the keyword normaliser (16 characters).
PUNCTUATION = ".,!?:;\"'$&%*()_-"
# Delimiters of the tokenizer: space, double quote, comma, parentheses, star.
TOKEN_DELIMITERS = " \",()*"
# Keyword word length bounds (raw length 3..16, stripped length >= 3).
MIN_WORD, MAX_WORD = 3, 16
# ---------------------------------------------------------------------------------------------

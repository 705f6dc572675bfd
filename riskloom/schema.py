"""Schemas of the canonical tables and of the result shapes."""

from __future__ import annotations

from pyspark.sql import types as T

# Input transactions, positional under a CSV header (9 columns).
TRANSACTION_SCHEMA = T.StructType([
    T.StructField("txn_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("card_country", T.StringType()),
    T.StructField("ip_country", T.StringType()),
    T.StructField("merchant_mcc", T.IntegerType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
])

TRANSACTION_COLUMNS = [f.name for f in TRANSACTION_SCHEMA.fields]
STRING_COLUMNS = [f.name for f in TRANSACTION_SCHEMA.fields if isinstance(f.dataType, T.StringType)]

# `seq` is our addition: arrival order, the tie-breaker the history dialect
# needs when two transactions of a user share a timestamp.  It must be unique.
SEQ = "seq"
CANONICAL_COLUMNS = TRANSACTION_COLUMNS + [SEQ]

RULE_POINT_COLUMNS = [
    "r_high_amount",
    "r_country_mismatch",
    "r_blacklisted_mcc",
    "r_high_velocity",
    "r_night_time",
    "r_new_device",
]

# Wide scored table (window dialect), in the order of the committed golden file.
SCORED_WINDOW_COLUMNS = TRANSACTION_COLUMNS + [
    "r_high_amount",
    "r_country_mismatch",
    "r_blacklisted_mcc",
    "txn_count_window",
    "r_high_velocity",
    "r_night_time",
    "first_seen_device",
    "r_new_device",
    "total_score",
    "severity",
    "status",
]

# Wide scored table (history dialect): same, without the window-only
# `first_seen_device`; `txn_count_window` is the count of *earlier* rows.
SCORED_HISTORY_COLUMNS = [c for c in SCORED_WINDOW_COLUMNS if c != "first_seen_device"]

# Console projection of the batch scorer.
CONSOLE_COLUMNS = ["txn_id", "user_id", "amount", "currency", "timestamp",
                   "total_score", "severity", "status"] + RULE_POINT_COLUMNS

RULE_HIT = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("points", T.IntegerType(), False),
    T.StructField("details", T.StringType()),
])
RULE_HITS = T.ArrayType(RULE_HIT, False)

"""Result shapes built on a scored table.

Input is the output of :func:`riskloom.operators.scoring.score` (or
``with_hits`` of it).  All shapes are projections or one global aggregate;
only the flagged sample sorts, and it is a top-N (TakeOrderedAndProject:
each partition keeps N rows, the driver merges N x partitions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..config import RuleConfig
from ..functions import text as X
from ..functions.timecols import iso_time
from ..schema import CONSOLE_COLUMNS
from ..session import materialize
from .scoring import with_hits


def console_view(scored: DataFrame) -> DataFrame:
    """The batch scorer's console projection (caller may ``limit(20)``)."""
    return scored.select(*CONSOLE_COLUMNS)


def in_time_order(df: DataFrame) -> DataFrame:
    """O1: presentation order of the sequential scorer — timestamp, then arrival.

    A global sort (range-partitioned); apply it only where the order is shown
    or written, never inside scoring.
    """
    return df.orderBy(F.col("timestamp").asc_nulls_last(), F.col("seq").asc())


def with_position(df: DataFrame) -> DataFrame:
    """Add ``position``, each row's place (from 1) in time order, without one task that sees all rows.

    The sorted rows are written once, which fixes the partition each row lies in; a row's
    place is its place in the partition plus the rows of earlier partitions (one number each).
    """
    in_part = (1 << 33) - 1   # monotonically_increasing_id: partition << 33 | row
    rows = materialize(in_time_order(df).withColumn("_mid", F.monotonically_increasing_id()), "ordered")
    rows = rows.withColumn("_part", F.shiftright("_mid", 33))
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))   # one row a partition
    return (rows.join(F.broadcast(offsets), "_part")
            .withColumn("position", F.col("_before") + F.col("_mid").bitwiseAND(F.lit(in_part)) + 1)
            .drop("_part", "_mid", "_before"))


def flagged(scored: DataFrame) -> DataFrame:
    """R12."""
    return scored.where(F.col("status") == F.lit(C.STATUS_FLAG))


def nested_results(scored: DataFrame, rules: RuleConfig) -> DataFrame:
    """One record per transaction with its ordered rule hits."""
    return with_hits(scored, rules).select(
        "txn_id", "user_id", "amount", "currency", "card_country", "ip_country",
        iso_time(scored).alias("timestamp"),
        F.col("total_score").alias("score"), "severity", "status", "rules_triggered")


def flat_short(scored: DataFrame, rules: RuleConfig) -> DataFrame:
    """Display-named flat table with short rule text."""
    h = with_hits(scored, rules)
    return h.select(
        iso_time(scored).alias("Timestamp"),
        F.col("txn_id").alias("Txn ID"),
        F.col("user_id").alias("User ID"),
        F.col("amount").alias("Amount"),
        F.col("currency").alias("Currency"),
        F.col("total_score").alias("Score"),
        F.col("severity").alias("Severity"),
        F.col("status").alias("Status"),
        X.hits_short_text(F.col("rules_triggered")).alias("Rules Triggered"),
    )


def flat_detailed(scored: DataFrame, rules: RuleConfig, keep_rule_objects: bool = True,
                  extra: dict | None = None) -> DataFrame:
    """Flat table with detailed rule text, plus the hit array for explainers.

    ``extra`` names further columns, as expressions over the scored row and its hit array.
    """
    h = with_hits(scored, rules)
    cols = [
        "txn_id", "user_id", "amount", "currency", "card_country", "ip_country", "merchant_mcc", "device_id",
        iso_time(scored).alias("timestamp"),
        F.col("total_score").alias("score"), "severity", "status",
        X.hits_detailed_text(F.col("rules_triggered")).alias("rules_triggered"),
    ]
    if keep_rule_objects:
        cols.append(F.col("rules_triggered").alias("_rule_objects"))
    return h.select(*cols, *[c.alias(name) for name, c in (extra or {}).items()])


def display_table(flat: DataFrame) -> DataFrame:
    """R13 + F4: the display subset of a detailed flat table, money-formatted amount."""
    cols = ["timestamp", "txn_id", "user_id", X.money(F.col("amount")).alias("amount"),
            "score", "severity", "status", "rules_triggered"]
    if "ai_explanation" in flat.columns:
        cols.append("ai_explanation")
    return flat.select(*cols)


def summary(scored: DataFrame) -> DataFrame:
    """A1: total / flagged / ok in one global aggregate (zeros for no rows)."""
    agg = scored.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == F.lit(C.STATUS_FLAG)).alias("flagged"),
    )
    return agg.withColumn("ok", F.col("total") - F.col("flagged"))


def sample_line(txn_id, user_id, score, ts_text):
    """``txn | user | score | timestamp`` with ``None`` for missing values."""
    return F.concat_ws(" | ", X.py_str(txn_id), X.py_str(user_id), X.py_str(score), X.py_str(ts_text))


def flagged_sample(scored: DataFrame, top_n: int = 10) -> DataFrame:
    """O2: the first ``top_n`` flagged rows in (timestamp, seq) order (not by score)."""
    f = flagged(scored).select(
        "txn_id", "user_id", F.col("total_score").alias("score"), "timestamp", "seq",
        iso_time(scored).alias("ts_text"))
    top = f.orderBy(F.col("timestamp").asc_nulls_last(), F.col("seq").asc()).limit(int(top_n))
    return top.select(
        "txn_id", "user_id", "score", F.col("ts_text").alias("timestamp"), "seq",
        sample_line(F.col("txn_id"), F.col("user_id"), F.col("score"), F.col("ts_text")).alias("line"))

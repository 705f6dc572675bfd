"""Scoring: context -> six rule points -> total, severity, status -> rule hits.

Everything after the context step is row-local and stays inside one
whole-stage-codegen Project.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import DEFAULT_EXEC, ExecConfig, RuleConfig
from ..functions import rules as R
from ..functions import text as X
from ..functions.timecols import OFFSET, local_time
from ..schema import SCORED_HISTORY_COLUMNS, SCORED_WINDOW_COLUMNS
from .blacklist import LISTED, with_listed
from .context import with_context


def score(tx: DataFrame, rules: RuleConfig = RuleConfig(), dialect: str = C.DIALECT_WINDOW,
          exec_cfg: ExecConfig = DEFAULT_EXEC, key_counts: DataFrame | None = None,
          rows_upper_bound: int | None = None, split=None, blacklist: DataFrame | None = None) -> DataFrame:
    """Canonical transactions (+ ``seq``) -> every column needed downstream.

    Keeps the canonical columns, ``seq`` and the context columns, adds the six
    ``r_*`` point columns, ``total_score``, ``severity`` and ``status``.  A ``blacklist`` table
    (see ``operators.blacklist``) takes the place of the rules' list of codes.
    """
    ctx = with_context(tx, rules, dialect, exec_cfg, key_counts, rows_upper_bound, split)
    if blacklist is not None:
        return apply_rules(with_listed(ctx, blacklist, exec_cfg), rules, dialect).drop(LISTED)
    return apply_rules(ctx, rules, dialect)


def apply_rules(df: DataFrame, rules: RuleConfig, dialect: str) -> DataFrame:
    """Row-local part of scoring, given the context columns (batch or streaming input)."""
    ts = F.col("timestamp")
    if dialect == C.DIALECT_WINDOW:
        new_dev = R.new_device_points_window(ts, F.col("first_seen_device"))
    else:
        new_dev = R.new_device_points_history(F.col("_new_device"))
    points = {
        "r_high_amount": R.high_amount_points(F.col("amount"), rules.high_amount_threshold, dialect),
        "r_country_mismatch": R.country_mismatch_points(F.col("card_country"), F.col("ip_country"), dialect),
        "r_blacklisted_mcc": (R.listed_mcc_points(F.col(LISTED)) if LISTED in df.columns else
                              R.blacklisted_mcc_points(F.col("merchant_mcc"), rules.blacklisted_mcc)),
        "r_high_velocity": R.high_velocity_points(F.col("txn_count_window"), rules.velocity_max_allowed),
        "r_night_time": R.night_time_points(ts if dialect == C.DIALECT_WINDOW else local_time(df)),
        "r_new_device": new_dev,
    }
    df = df.withColumns(points)
    total = R.total_points([F.col(c) for c in points])
    df = df.withColumn("total_score", total)
    return df.withColumns({
        "severity": R.severity(F.col("total_score")),
        "status": R.status(F.col("total_score"), rules.flag_threshold),
    })


def scored_table(tx: DataFrame, rules: RuleConfig = RuleConfig(), dialect: str = C.DIALECT_WINDOW,
                 exec_cfg: ExecConfig = DEFAULT_EXEC, key_counts: DataFrame | None = None,
                 rows_upper_bound: int | None = None) -> DataFrame:
    """The wide result table (20 columns for window, 19 for history; and ``utc_offset`` if the input has it)."""
    cols = SCORED_WINDOW_COLUMNS if dialect == C.DIALECT_WINDOW else SCORED_HISTORY_COLUMNS
    cols = [*cols, OFFSET] if OFFSET in tx.columns else cols
    return score(tx, rules, dialect, exec_cfg, key_counts, rows_upper_bound).select(*cols)


def rule_hits(rules: RuleConfig, clock: Column | None = None) -> Column:
    """Ordered ``array<struct<name, points, details>>`` of the rules that fired; ``clock`` is the wall-clock time."""
    amount, user = F.col("amount"), F.col("user_id")
    by_rule = {  # rule name -> (points column, detail text)
        C.RULE_HIGH_AMOUNT: ("r_high_amount", X.detail_high_amount(amount, rules.high_amount_threshold)),
        C.RULE_COUNTRY_MISMATCH: ("r_country_mismatch",
                                  X.detail_country_mismatch(F.col("card_country"), F.col("ip_country"))),
        C.RULE_BLACKLISTED_MCC: ("r_blacklisted_mcc", X.detail_blacklisted_mcc(F.col("merchant_mcc"))),
        C.RULE_HIGH_VELOCITY: ("r_high_velocity",
                               X.detail_high_velocity(F.col("txn_count_window"), rules.velocity_window_minutes, user)),
        C.RULE_NIGHT_TIME: ("r_night_time", X.detail_night_time(F.col("timestamp") if clock is None else clock)),
        C.RULE_NEW_DEVICE: ("r_new_device", X.detail_new_device(F.col("device_id"), user)),
    }
    candidates = [
        F.when(F.col(pc) > 0, F.struct(F.lit(name).alias("name"), F.col(pc).alias("points"),
                                       det.alias("details")))
        for name in C.RULE_ORDER
        for pc, det in [by_rule[name]]
    ]
    return F.filter(F.array(*candidates), lambda h: h.isNotNull())


def with_hits(scored: DataFrame, rules: RuleConfig) -> DataFrame:
    return scored.withColumn("rules_triggered", rule_hits(rules, local_time(scored)))


def hits_long(scored: DataFrame, rules: RuleConfig) -> DataFrame:
    """One row per fired rule: ``txn_id, pos, name, points, details`` (pos is 1-based)."""
    return (with_hits(scored, rules)
            .select("txn_id", F.posexplode("rules_triggered").alias("pos", "hit"))
            .select("txn_id", (F.col("pos") + 1).alias("pos"), F.col("hit.name").alias("name"),
                    F.col("hit.points").alias("points"), F.col("hit.details").alias("details")))

"""Rule configuration, fixed scoring values and execution (scale) knobs.

Everything here is driver-side scalar configuration: it is inlined into the
plans as literals, never shipped as data.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference scorer's (points, cut-offs, rule
# names in evaluation order, dialect names, default parameters).
# ---------------------------------------------------------------------------
POINTS_HIGH_AMOUNT = 30
POINTS_VERY_HIGH_AMOUNT = 50  # amount >= 2 x threshold
POINTS_COUNTRY_MISMATCH = 40
POINTS_BLACKLISTED_MCC = 25
POINTS_HIGH_VELOCITY = 30
POINTS_NIGHT_TIME = 10
POINTS_NEW_DEVICE = 20

NIGHT_START_HOUR = 0  # inclusive
NIGHT_END_HOUR = 5  # exclusive

SEVERITY_HIGH = 80
SEVERITY_MEDIUM = 50
SEVERITY_LOW = 20

# Rule names, in the order the sequential scorer evaluates and lists them.
RULE_HIGH_AMOUNT = "HighAmount"
RULE_COUNTRY_MISMATCH = "CountryMismatch"
RULE_BLACKLISTED_MCC = "BlacklistedMCC"
RULE_HIGH_VELOCITY = "HighVelocity"
RULE_NIGHT_TIME = "NightTime"
RULE_NEW_DEVICE = "NewDevice"
RULE_ORDER = (
    RULE_HIGH_AMOUNT,
    RULE_COUNTRY_MISMATCH,
    RULE_BLACKLISTED_MCC,
    RULE_HIGH_VELOCITY,
    RULE_NIGHT_TIME,
    RULE_NEW_DEVICE,
)

STATUS_FLAG = "FLAG"
STATUS_OK = "OK"

DEFAULT_FLAG_THRESHOLD = 50
DEFAULT_HIGH_AMOUNT_THRESHOLD = 2000.0
DEFAULT_VELOCITY_WINDOW_MINUTES = 5
DEFAULT_VELOCITY_MAX_ALLOWED = 3
DEFAULT_BLACKLISTED_MCC = (4829, 7995)

# Scoring dialects (see README): "window" counts the current transaction and
# its same-second peers in the trailing window; "history" scores every
# transaction only against the user's strictly earlier transactions.
DIALECT_WINDOW = "window"
DIALECT_HISTORY = "history"
DIALECTS = (DIALECT_WINDOW, DIALECT_HISTORY)


@dataclass(frozen=True)
class RuleConfig:
    """Tunable rule parameters (the reference's command-line / sidebar values)."""

    flag_threshold: int = DEFAULT_FLAG_THRESHOLD
    high_amount_threshold: float = DEFAULT_HIGH_AMOUNT_THRESHOLD
    velocity_window_minutes: int = DEFAULT_VELOCITY_WINDOW_MINUTES
    velocity_max_allowed: int = DEFAULT_VELOCITY_MAX_ALLOWED
    blacklisted_mcc: tuple[int, ...] = DEFAULT_BLACKLISTED_MCC

    def __post_init__(self):
        object.__setattr__(self, "high_amount_threshold", float(self.high_amount_threshold))
        object.__setattr__(self, "blacklisted_mcc", tuple(int(m) for m in self.blacklisted_mcc))
        if self.velocity_window_minutes < 0:
            raise ValueError("velocity_window_minutes must be >= 0")

    @property
    def window_seconds(self) -> int:
        return int(self.velocity_window_minutes) * 60

    @property
    def window_micros(self) -> int:
        return int(self.velocity_window_minutes) * 60_000_000

    def with_(self, **kw) -> "RuleConfig":
        return replace(self, **kw)


# Configuration used for the driver's `events` table: the defaults would almost
# never fire on it (amounts are small and users are slow), so the registered
# queries use a threshold near the 90th percentile of `value` and a one-day
# velocity window.
EVENTS_RULES = RuleConfig(
    flag_threshold=50,
    high_amount_threshold=100.0,
    velocity_window_minutes=1440,
    velocity_max_allowed=3,
    blacklisted_mcc=(4829, 7995),
)


def parse_mcc_list(text: str | None, empty_on_error: bool = False) -> tuple[int, ...]:
    """Merchant category codes of a comma separated list; empty entries are ignored.

    A mistyped code raises ValueError, because dropping the list would switch the
    blacklist rule off unnoticed.  ``empty_on_error`` gives an empty list instead.
    """
    codes: list[int] = []
    for entry in (text or "").split(","):
        entry = entry.strip()
        if not entry:
            continue
        if not re.fullmatch(r"[+-]?[0-9]+", entry):
            if empty_on_error:
                return ()
            raise ValueError(f"not a merchant category code: {entry!r}")
        codes.append(int(entry))
    return tuple(codes)


@dataclass(frozen=True)
class ExecConfig:
    """Scale knobs: they choose the physical strategy, not the result (rows are joined by an internal id).

    hot_key_rows
        A user (or user/device pair) with more rows than this is *hot*: it is
        taken out of the per-user window path (one task per user) and scored by
        the skew-proof path (range-partitioned sort + prefix offsets, joins with
        broadcast hot keys).  ``0`` sends every user through the skew-proof path.
    max_broadcast_keys
        Upper bound on the rows of any key table we broadcast.  The number of
        hot keys is at most ``rows / hot_key_rows``; it is counted before the
        broadcast and, above this bound, a shuffle join (AQE skew-split) is
        used instead.
    max_broadcast_dim_rows
        Dimension tables (nation, customer, supplier) are broadcast only when
        their row count (read from Parquet footers) is at most this.
    range_rows
        Rows that one time range of a hot user should hold.  A range with more than four
        times as many, its halo counted, is *dense* and is counted by prefix sums.
    sort_rows_per_partition
        Target rows per range partition in the sort of dense ranges.
    hot_partition_factor
        A user is only a straggler risk relative to the partition size: when
        the input size is known, the hot threshold is raised to
        ``factor x rows / spark.sql.shuffle.partitions`` (a user holding
        several average partitions), but never above ``hot_key_ceiling`` rows.
        ``0`` keeps the absolute threshold.
    hot_key_ceiling
        Most rows of one user that may stay in one task, whatever the input's size.
    """

    hot_key_rows: int = 2_000_000
    max_broadcast_keys: int = 1_000_000
    max_broadcast_dim_rows: int = 2_000_000
    range_rows: int = 500_000
    sort_rows_per_partition: int = 4_000_000
    hot_partition_factor: float = 4.0
    hot_key_ceiling: int = 8_000_000

    def with_(self, **kw) -> "ExecConfig":
        return replace(self, **kw)


DEFAULT_EXEC = ExecConfig()
SKEWPROOF_EXEC = ExecConfig(hot_key_rows=0)

"""The six scoring rules as Catalyst expressions (row-local parts).

Each function returns an ``IntegerType`` column of points.  The two dialects
differ only where documented:

* high amount: the history dialect never fires on NaN (Python ``NaN >= x`` is
  false); Spark orders NaN above every number, so the window dialect does.
* country mismatch: the history dialect treats ``''`` as missing (falsy).
* new device: window dialect compares against the first sighting time of the
  (user, device) pair; history dialect asks whether the user had *other*
  devices before (see ``operators.context``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def _pts(cond: Column, points: int) -> Column:
    return F.when(cond, F.lit(points)).otherwise(F.lit(0))


def high_amount_points(amount: Column, threshold: float, dialect: str) -> Column:
    t = float(threshold)
    guard = ~F.isnan(amount) if dialect == C.DIALECT_HISTORY else F.lit(True)
    return (
        F.when(guard & (amount >= F.lit(t * 2)), F.lit(C.POINTS_VERY_HIGH_AMOUNT))
        .when(guard & (amount >= F.lit(t)), F.lit(C.POINTS_HIGH_AMOUNT))
        .otherwise(F.lit(0))
    )


def country_mismatch_points(card: Column, ip: Column, dialect: str) -> Column:
    present = card.isNotNull() & ip.isNotNull()
    if dialect == C.DIALECT_HISTORY:
        present = present & (card != F.lit("")) & (ip != F.lit(""))
    return _pts(present & (card != ip), C.POINTS_COUNTRY_MISMATCH)


def blacklisted_mcc_points(mcc: Column, blacklist: tuple[int, ...]) -> Column:
    if not blacklist:
        return F.lit(0)
    return _pts(mcc.isin(list(blacklist)), C.POINTS_BLACKLISTED_MCC)


def listed_mcc_points(listed: Column) -> Column:
    """The same points where a table has told whether the code is listed."""
    return _pts(listed, C.POINTS_BLACKLISTED_MCC)


def high_velocity_points(count: Column, max_allowed: int) -> Column:
    return _pts(count >= F.lit(int(max_allowed)), C.POINTS_HIGH_VELOCITY)


def night_time_points(ts: Column) -> Column:
    h = F.hour(ts)
    return _pts((h >= F.lit(C.NIGHT_START_HOUR)) & (h < F.lit(C.NIGHT_END_HOUR)), C.POINTS_NIGHT_TIME)


def new_device_points_window(ts: Column, first_seen: Column) -> Column:
    # `ts > first_seen` is NULL for a NULL timestamp, which scores like a first sighting.
    return F.when(ts > first_seen, F.lit(0)).otherwise(F.lit(C.POINTS_NEW_DEVICE))


def new_device_points_history(is_new_device: Column) -> Column:
    return _pts(is_new_device, C.POINTS_NEW_DEVICE)


def total_points(point_cols: list[Column]) -> Column:
    total = point_cols[0]
    for c in point_cols[1:]:
        total = total + c
    return total


def severity(score: Column) -> Column:
    return (
        F.when(score >= F.lit(C.SEVERITY_HIGH), F.lit("HIGH"))
        .when(score >= F.lit(C.SEVERITY_MEDIUM), F.lit("MEDIUM"))
        .when(score >= F.lit(C.SEVERITY_LOW), F.lit("LOW"))
        .otherwise(F.lit("INFO"))
    )


def status(score: Column, flag_threshold: int) -> Column:
    return F.when(score >= F.lit(int(flag_threshold)), F.lit(C.STATUS_FLAG)).otherwise(F.lit(C.STATUS_OK))

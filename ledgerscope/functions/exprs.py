"""Scalar expressions used inside operators. All are Catalyst built-ins, so
they stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000
MICROS_PER_DAY = 86_400 * MICROS_PER_SECOND

# Fixed thresholds of the reference features and rules.
NEAR_THRESHOLD_LOW = 8000.0
NEAR_THRESHOLD_HIGH = 10000.0
ROUND_UNIT = 1000.0
RAPID_SECONDS = 300.0
NIGHT_START_HOUR = 22
NIGHT_END_HOUR = 6
CASH_TYPES = ["cash_deposit", "cash_withdrawal"]
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

__all__ = [
    "MICROS_PER_SECOND", "MICROS_PER_DAY", "NEAR_THRESHOLD_LOW", "NEAR_THRESHOLD_HIGH",
    "ROUND_UNIT", "RAPID_SECONDS", "NIGHT_START_HOUR", "NIGHT_END_HOUR", "CASH_TYPES",
    "DAY_NAMES", "col_", "epoch_micros", "day_of_week", "is_weekend", "is_night",
    "near_threshold", "is_round_amount", "is_self_transfer", "pair_low", "pair_high",
    "clip01", "flag", "rate_band",
]


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(ts="timestamp") -> Column:
    """Microseconds since the epoch for a timestamp or timestamp_ntz column
    (the session time zone is UTC, so the NTZ cast is the identity)."""
    return F.unix_micros(col_(ts).cast("timestamp"))


def day_of_week(ts="timestamp") -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(col_(ts))


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 int; null -> 0 (pandas compares null as False)."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def is_weekend(ts="timestamp") -> Column:
    return flag(day_of_week(ts) >= 5)


def is_night(ts="timestamp") -> Column:
    h = F.hour(col_(ts))
    return flag((h < NIGHT_END_HOUR) | (h >= NIGHT_START_HOUR))


def near_threshold(amount="amount", low=NEAR_THRESHOLD_LOW, high=NEAR_THRESHOLD_HIGH) -> Column:
    a = col_(amount)
    return flag((a >= low) & (a < high))


def is_round_amount(amount="amount", unit=ROUND_UNIT) -> Column:
    return flag(F.pmod(col_(amount), F.lit(unit)) == 0)


def is_self_transfer(sender="sender_account", receiver="receiver_account") -> Column:
    return flag(col_(sender) == col_(receiver))


def pair_low(a="sender_account", b="receiver_account") -> Column:
    """Smaller side of an unordered pair; null unless both sides are known."""
    return F.when(col_(a).isNotNull() & col_(b).isNotNull(), F.least(col_(a), col_(b)))


def pair_high(a="sender_account", b="receiver_account") -> Column:
    return F.when(col_(a).isNotNull() & col_(b).isNotNull(), F.greatest(col_(a), col_(b)))


def clip01(c) -> Column:
    return F.least(F.greatest(col_(c), F.lit(0.0)), F.lit(1.0))


def rate_band(rate, low=0.5, high=0.8) -> Column:
    """PF10: band a detection rate as 'low' (< low), 'medium' (< high) or 'high'."""
    r = col_(rate)
    return F.when(r < low, "low").when(r < high, "medium").otherwise("high")

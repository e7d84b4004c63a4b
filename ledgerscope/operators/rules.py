"""Rule detector (D8-D13): five weighted rules, schema-adaptive.

Each rule picks its definition from the columns present when the plan is
built, like the reference picks it from the frame's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.functions.exprs import CASH_TYPES, RAPID_SECONDS, clip01, flag

# Fixed rule weights and thresholds of the reference.
RULE_WEIGHTS = {
    "rule_structuring": 0.30,
    "rule_large_cash": 0.25,
    "rule_rapid": 0.20,
    "rule_night_activity": 0.15,
    "rule_round_amount": 0.10,
}
STRUCTURING_MIN_DAILY_COUNT = 3
LARGE_CASH_AMOUNT = 50000.0
NIGHT_AMOUNT = 10000.0
ROUND_AMOUNT = 5000.0
RULE_ALERT_LEVEL = 0.3  # the rule detector's own alert count uses score > 0.3

RULE_COLUMNS = list(RULE_WEIGHTS)


def rule_details(df: DataFrame, strict: bool = True) -> dict:
    """Column expressions for the five rules (0.0 / 1.0). ``strict=False`` is
    the dashboard variant of rule 1 (near-threshold alone)."""
    cols = set(df.columns)
    zero = F.lit(0.0)

    if "near_threshold" in cols and "txn_count_1d" in cols and strict:
        r1 = flag((F.col("near_threshold") == 1) &
                  (F.col("txn_count_1d") >= STRUCTURING_MIN_DAILY_COUNT))
    elif "near_threshold" in cols:
        r1 = F.coalesce(F.col("near_threshold"), F.lit(0))
    else:
        r1 = zero

    if "amount" in cols and "transaction_type" in cols:
        r2 = flag((F.col("amount") > LARGE_CASH_AMOUNT) & F.col("transaction_type").isin(CASH_TYPES))
    elif "amount" in cols:
        r2 = flag(F.col("amount") > LARGE_CASH_AMOUNT)
    else:
        r2 = zero

    if "is_rapid" in cols:
        r3 = F.coalesce(F.col("is_rapid"), F.lit(0))
    elif "time_since_last_txn" in cols:
        r3 = flag(F.col("time_since_last_txn") < RAPID_SECONDS)
    else:
        r3 = zero

    if "is_night" in cols and "amount" in cols:
        r4 = flag((F.col("is_night") == 1) & (F.col("amount") > NIGHT_AMOUNT))
    else:
        r4 = zero

    if "is_round_amount" in cols and "amount" in cols:
        r5 = flag((F.col("is_round_amount") == 1) & (F.col("amount") > ROUND_AMOUNT))
    else:
        r5 = zero

    return {name: e.cast("double") for name, e in zip(RULE_COLUMNS, [r1, r2, r3, r4, r5])}


def rule_scores(df: DataFrame, strict: bool = True, score_col: str = "rule_score") -> DataFrame:
    """Weighted rule sum clipped to [0, 1], plus one detail column per
    rule. Terms are added in rule order so doubles agree with the reference."""
    det = rule_details(df, strict)
    out = df.withColumns(det)
    total = F.lit(0.0)
    for name, w in RULE_WEIGHTS.items():
        total = total + F.col(name) * F.lit(w)
    return out.withColumn(score_col, clip01(total))


def rule_alert_flag(score_col: str = "rule_score"):
    """The rule detector's own alert condition: strictly above 0.3."""
    return (F.col(score_col) > RULE_ALERT_LEVEL).cast("int")

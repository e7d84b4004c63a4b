"""Registered queries: sources, flags, features (IO1-IO2, PF1-PF8, W1-W7, A1-A8, J1-J4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerscope.functions import exprs as X
from ledgerscope.operators import features as FE
from ledgerscope.plans.oracle_sql import ACCT_VIEW, FEAT_VIEW, TXN_VIEW, US, velocity_sql, with_views
from ledgerscope.plans.registry import register, sql_cols, views

TXN_SPEC = ("transaction_id:i, timestamp:t, sender_account:i, receiver_account:i, amount:d, "
            "transaction_type:s, currency:s, is_suspicious:i, pattern_type:s")
TIME_SPEC = ("hour:i, day_of_week:i, is_weekend:i, is_night:i, month:i, "
             "time_since_last_txn:d, is_rapid:i")
AMOUNT_SPEC = ("acct_avg_amount:d, acct_std_amount:d, acct_median_amount:d, acct_min_amount:d, "
               "acct_max_amount:d, acct_total_txns:i, amount_zscore:d, amount_to_avg_ratio:d, "
               "is_round_amount:i, near_threshold:i")
NET_SPEC = "n_unique_receivers:i, n_unique_senders:i, pair_txn_count:i, is_self_transfer:i"
VEL_SPEC = ", ".join(f"txn_count_{n}d:i, txn_sum_{n}d:d" for n in (1, 7, 30))
FEAT_SPEC = ", ".join([TXN_SPEC, TIME_SPEC, AMOUNT_SPEC, NET_SPEC, VEL_SPEC])


def _sql(select_spec: str, body: str, *extra_views: str) -> str:
    return with_views(f"SELECT {sql_cols(select_spec)} {body}", TXN_VIEW, *extra_views)


# -- sources -----------------------------------------------------------------

@register("io1_transactions", _sql(TXN_SPEC, "FROM txn"))
def io1_transactions(spark, sf):
    """IO1: the transfer ledger with its explicit schema."""
    txn, _ = views(spark, sf)
    return txn


@register("io2_accounts", with_views(
    "SELECT " + sql_cols("account_id:i, account_type:s, country:s, risk_rating:s, "
                         "opening_balance:d") + " FROM acct", ACCT_VIEW))
def io2_accounts(spark, sf):
    """IO2: the account dimension."""
    _, acct = views(spark, sf)
    return acct


# -- row flags ---------------------------------------------------------------

@register("pf5_near_threshold", _sql(
    "transaction_id:i, amount:d, near_threshold:i=CASE WHEN amount >= 8000 AND amount < 10000 THEN 1 ELSE 0 END",
    "FROM txn"))
def pf5(spark, sf):
    txn, _ = views(spark, sf)
    return txn.select("transaction_id", "amount", X.near_threshold().alias("near_threshold"))


@register("pf6_round_amount", _sql(
    "transaction_id:i, amount:d, is_round_amount:i=CASE WHEN amount % 1000 = 0 THEN 1 ELSE 0 END",
    "FROM txn"))
def pf6(spark, sf):
    txn, _ = views(spark, sf)
    return txn.select("transaction_id", "amount", X.is_round_amount().alias("is_round_amount"))


@register("pf7_self_transfer", _sql(
    "transaction_id:i, is_self_transfer:i=CASE WHEN sender_account = receiver_account THEN 1 ELSE 0 END",
    "FROM txn"))
def pf7(spark, sf):
    txn, _ = views(spark, sf)
    return txn.select("transaction_id", X.is_self_transfer().alias("is_self_transfer"))


@register("pf8_weekend_night", _sql(
    "transaction_id:i, is_weekend:i=CASE WHEN isodow(\"timestamp\") >= 6 THEN 1 ELSE 0 END, "
    "is_night:i=CASE WHEN hour(\"timestamp\") < 6 OR hour(\"timestamp\") >= 22 THEN 1 ELSE 0 END",
    "FROM txn"))
def pf8(spark, sf):
    txn, _ = views(spark, sf)
    return txn.select("transaction_id", X.is_weekend().alias("is_weekend"),
                      X.is_night().alias("is_night"))


# -- windows -----------------------------------------------------------------

def _vel_sql(kind: str) -> str:
    cols = ", ".join(f"txn_{kind}_{n}d:{'i' if kind == 'count' else 'd'}" for n in (1, 7, 30))
    inner = ", ".join(velocity_sql(n) for n in (1, 7, 30))
    return _sql(f"transaction_id:i, sender_account:i, {cols}",
                f"FROM (SELECT transaction_id, sender_account, {inner} FROM txn)")


@register("w1_velocity_count", _vel_sql("count"))
def w1(spark, sf):
    """Trailing 1/7/30-day transfer counts per sender."""
    txn, _ = views(spark, sf)
    v = FE.velocity_features(txn)
    return v.select("transaction_id", "sender_account", "txn_count_1d", "txn_count_7d",
                    "txn_count_30d")


@register("w2_velocity_sum", _vel_sql("sum"))
def w2(spark, sf):
    """Trailing 1/7/30-day amount sums per sender."""
    txn, _ = views(spark, sf)
    v = FE.velocity_features(txn)
    return v.select("transaction_id", "sender_account", "txn_sum_1d", "txn_sum_7d", "txn_sum_30d")


_GAP_SQL = (f"coalesce(({US} - lag({US}) OVER (PARTITION BY sender_account "
            f"ORDER BY {US}, transaction_id)) / 1e6, 0.0)")


@register("w3_time_since_last", _sql(
    "transaction_id:i, sender_account:i, time_since_last_txn:d", f"FROM (SELECT *, {_GAP_SQL} AS time_since_last_txn FROM txn)"))
def w3(spark, sf):
    """Seconds since the sender's previous transfer."""
    txn, _ = views(spark, sf)
    return FE.time_features(txn).select("transaction_id", "sender_account", "time_since_last_txn")


@register("w4_rapid_flag", _sql(
    "transaction_id:i, is_rapid:i=CASE WHEN g > 0 AND g < 300 THEN 1 ELSE 0 END",
    f"FROM (SELECT *, {_GAP_SQL} AS g FROM txn)"))
def w4(spark, sf):
    """Rapid flag 0 < gap < 300 s."""
    txn, _ = views(spark, sf)
    return FE.time_features(txn).select("transaction_id", "is_rapid")


@register("w5_time_features", _sql(f"transaction_id:i, {TIME_SPEC}", "FROM featr", FEAT_VIEW))
def w5(spark, sf):
    """The time feature set."""
    txn, _ = views(spark, sf)
    return FE.time_features(txn).select("transaction_id", *FE.TIME_COLUMNS)


@register("w6_all_features", _sql(FEAT_SPEC, "FROM featr", FEAT_VIEW))
def w6(spark, sf):
    """The full 28-input feature frame."""
    txn, _ = views(spark, sf)
    return FE.engineer_all_features(txn)


_W7_SPEC = ", ".join([TXN_SPEC] + [f"{c}:{'d' if c in ('amount', 'acct_avg_amount', 'acct_std_amount', 'acct_median_amount', 'amount_zscore', 'amount_to_avg_ratio', 'time_since_last_txn') else 'i'}"
                                   for c in FE.DASHBOARD_FEATURES if c != "amount"])


@register("w7_dashboard_features", _sql(_W7_SPEC, "FROM featr", FEAT_VIEW))
def w7(spark, sf):
    """The dashboard's 19-column frame."""
    txn, _ = views(spark, sf)
    return FE.engineer_dashboard_features(txn)


@register("pf1_feature_matrix", _sql(
    "transaction_id:i, " + ", ".join(
        f"{c}:{'i' if c.startswith(('is_', 'hour', 'day_of', 'month', 'acct_total', 'n_unique', 'pair_', 'txn_count', 'near_')) else 'd'}"
        for c in ["amount", *FE.TIME_COLUMNS, *FE.AMOUNT_COLUMNS, *FE.NETWORK_COLUMNS,
                  *FE.velocity_columns()]), "FROM featr", FEAT_VIEW))
def pf1(spark, sf):
    """PF1: model inputs chosen by type (every numeric column minus ids/labels)."""
    txn, _ = views(spark, sf)
    f = FE.engineer_all_features(txn)
    return f.select("transaction_id", *FE.feature_columns(f))


# -- aggregates and their joins -------------------------------------------------

_STATS_SQL = ("SELECT sender_account, avg(amount) AS acct_avg_amount, stddev_samp(amount) AS acct_std_amount, "
              "median(amount) AS acct_median_amount, min(amount) AS acct_min_amount, "
              "max(amount) AS acct_max_amount, count(amount) AS acct_total_txns FROM txn GROUP BY sender_account")


@register("a1_sender_stats", _sql(
    "sender_account:i, acct_avg_amount:d, acct_std_amount:d, acct_median_amount:d, "
    "acct_min_amount:d, acct_max_amount:d, acct_total_txns:i", f"FROM ({_STATS_SQL})"))
def a1(spark, sf):
    """A1: per-sender amount statistics (exact median)."""
    txn, _ = views(spark, sf)
    return FE.sender_amount_stats(txn)


@register("pf2_null_fill", _sql(
    "transaction_id:i, acct_std_amount:d=coalesce(s.acct_std_amount, 0)",
    f"FROM txn LEFT JOIN ({_STATS_SQL}) s USING (sender_account)"))
def pf2(spark, sf):
    """PF2: numeric nulls (one-transfer senders' std) filled with 0."""
    txn, _ = views(spark, sf)
    st = FE.sender_amount_stats(txn).select("sender_account", "acct_std_amount")
    return FE.fill_numeric_nulls(txn.join(st, "sender_account", "left")
                                 .select("transaction_id", "acct_std_amount"))


@register("j1_sender_stats_join", _sql(
    "transaction_id:i, sender_account:i, acct_avg_amount:d, acct_total_txns:i",
    f"FROM txn LEFT JOIN ({_STATS_SQL}) s USING (sender_account)"))
def j1(spark, sf):
    """Left equi-join of per-sender statistics to the transfers."""
    txn, _ = views(spark, sf)
    st = FE.sender_amount_stats(txn)
    return (txn.join(st, "sender_account", "left")
            .select("transaction_id", "sender_account", "acct_avg_amount", "acct_total_txns"))


@register("a2_amount_zscore", _sql("transaction_id:i, amount_zscore:d", "FROM featr", FEAT_VIEW))
def a2(spark, sf):
    txn, _ = views(spark, sf)
    return FE.amount_features(txn).select("transaction_id", "amount_zscore")


@register("a3_amount_ratio", _sql("transaction_id:i, amount_to_avg_ratio:d", "FROM featr", FEAT_VIEW))
def a3(spark, sf):
    txn, _ = views(spark, sf)
    return FE.amount_features(txn).select("transaction_id", "amount_to_avg_ratio")


@register("a4_amount_features", _sql(f"transaction_id:i, {AMOUNT_SPEC}", "FROM featr", FEAT_VIEW))
def a4(spark, sf):
    txn, _ = views(spark, sf)
    return FE.fill_numeric_nulls(FE.amount_features(txn)).select("transaction_id", *FE.AMOUNT_COLUMNS)


@register("a5_distinct_receivers", _sql(
    "sender_account:i, n_unique_receivers:i",
    "FROM (SELECT sender_account, count(DISTINCT receiver_account) AS n_unique_receivers FROM txn GROUP BY 1)"))
def a5(spark, sf):
    txn, _ = views(spark, sf)
    return FE.distinct_receivers(txn)


@register("a6_distinct_senders", _sql(
    "receiver_account:i, n_unique_senders:i",
    "FROM (SELECT receiver_account, count(DISTINCT sender_account) AS n_unique_senders FROM txn GROUP BY 1)"))
def a6(spark, sf):
    txn, _ = views(spark, sf)
    return FE.distinct_senders(txn)


@register("a7_pair_counts", _sql(
    "account_lo:i, account_hi:i, pair_txn_count:i",
    "FROM (SELECT least(sender_account, receiver_account) AS account_lo, "
    "greatest(sender_account, receiver_account) AS account_hi, count(*) AS pair_txn_count FROM txn GROUP BY 1, 2)"))
def a7(spark, sf):
    txn, _ = views(spark, sf)
    return (FE.pair_counts(txn).withColumnsRenamed({"_pair_lo": "account_lo",
                                                    "_pair_hi": "account_hi"}))


@register("j2_receivers_join", _sql("transaction_id:i, n_unique_receivers:i", "FROM featr", FEAT_VIEW))
def j2(spark, sf):
    txn, _ = views(spark, sf)
    return (txn.join(FE.distinct_receivers(txn), "sender_account", "left")
            .select("transaction_id", "n_unique_receivers"))


@register("j3_senders_join", _sql("transaction_id:i, n_unique_senders:i", "FROM featr", FEAT_VIEW))
def j3(spark, sf):
    txn, _ = views(spark, sf)
    return (txn.join(FE.distinct_senders(txn), "receiver_account", "left")
            .select("transaction_id", "n_unique_senders"))


@register("j4_pair_lookup", _sql("transaction_id:i, pair_txn_count:i", "FROM featr", FEAT_VIEW))
def j4(spark, sf):
    txn, _ = views(spark, sf)
    return FE.network_features(txn).select("transaction_id", "pair_txn_count")


@register("a8_network_features", _sql(f"transaction_id:i, {NET_SPEC}", "FROM featr", FEAT_VIEW))
def a8(spark, sf):
    txn, _ = views(spark, sf)
    return FE.network_features(txn).select("transaction_id", *FE.NETWORK_COLUMNS)

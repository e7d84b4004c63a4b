"""Typology matchers (T1-T4): structuring, layering chains, round trips, bursts.

The self-joins are band joins on time. Each carries an equi-key of
(account, time bucket) with the bucket as wide as the time band, and one side
is exploded to the neighbouring bucket(s), so a partner can only be found in a
task that holds transfers close in time. Spark's size estimates do not see the
explode, so the joins ask for a sort-merge join: the copied ledger is never
broadcast. Thresholds default to the shapes the reference plants in its synthetic
ledger; all are arguments.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerscope.functions.exprs import MICROS_PER_DAY, MICROS_PER_SECOND, epoch_micros
from ledgerscope.operators.features import velocity_features, window_label

HOUR_US = 3600 * MICROS_PER_SECOND
MINUTE_US = 60 * MICROS_PER_SECOND

# Fixed defaults read off the planted typologies.
STRUCTURING_TYPE = "cash_deposit"
STRUCTURING_LOW, STRUCTURING_HIGH = 8000.0, 10000.0
STRUCTURING_WINDOW_DAYS = 2.0
STRUCTURING_MIN_COUNT = 3
LAYERING_HOPS = 3
LAYERING_BAND = 0.95
LAYERING_SPAN_HOURS = 5.0
ROUND_TRIP_MIN_DAYS, ROUND_TRIP_MAX_DAYS = 1.0, 9.0
ROUND_TRIP_RATIO = (0.90, 1.05)
BURST_MIN_COUNT = 5
BURST_MAX_GAP_MINUTES = 60.0
BURST_MAX_SPAN_HOURS = 5.5


def structuring(df: DataFrame, low: float = STRUCTURING_LOW, high: float = STRUCTURING_HIGH,
                window_days: float = STRUCTURING_WINDOW_DAYS,
                min_count: int = STRUCTURING_MIN_COUNT,
                txn_type: str | None = STRUCTURING_TYPE) -> DataFrame:
    """Near-threshold deposits (low <= amount < high) of one sender with at
    least ``min_count`` of them in the trailing window (t - window, t].
    Returns the transfers at which the count is reached or exceeded."""
    cond = (F.col("amount") >= low) & (F.col("amount") < high)
    if txn_type:
        cond &= F.col("transaction_type") == txn_type
    cand = df.filter(cond).select("transaction_id", "sender_account", "timestamp", "amount")
    v = velocity_features(cand, windows=[window_days])
    cnt = f"txn_count_{window_label(window_days)}d"
    return (v.filter(F.col(cnt) >= min_count)
            .select("transaction_id", "sender_account", "timestamp", "amount",
                    F.col(cnt).alias("n_in_window")))


def _edges(df: DataFrame) -> DataFrame:
    return (df.filter(F.col("sender_account").isNotNull() & F.col("receiver_account").isNotNull()
                      & F.col("amount").isNotNull() & F.col("timestamp").isNotNull())
            .select("transaction_id", F.col("sender_account").alias("src"),
                    F.col("receiver_account").alias("dst"), epoch_micros("timestamp").alias("us"),
                    "amount"))


def _hops(df: DataFrame, band: float, span_us: int, base_range):
    """(edges, first frontier): transfers with their time and log-amount buckets, and chains of one hop."""
    e = _edges(df).filter(F.col("src") != F.col("dst"))
    if base_range is not None:
        e = e.filter((F.col("amount") >= F.lit(band * base_range[0])) & (F.col("amount") <= F.lit(float(base_range[1]))))
    # Amounts of one chain differ by a factor of 1 / band at most: one bucket up or down.
    width = -math.log(band) * (1 + 1e-9) if 0 < band < 1 else 1.0
    bucket = F.when(F.col("amount") > 0, F.floor(F.ln("amount") / F.lit(width))).otherwise(F.lit(-(1 << 40)))
    e = e.withColumns({"tb": F.floor(F.col("us") / F.lit(span_us)), "ab": bucket})
    first = e.select(F.array("transaction_id").alias("txns"), F.array("src", "dst").alias("accounts"),
                     F.col("dst").alias("_end"), F.col("us").alias("_us_last"), F.col("tb").alias("_tb"), F.col("ab").alias("_ab"),
                     F.col("amount").alias("_amt_last"), F.col("us").alias("_us_min"), F.col("us").alias("_us_max"),
                     F.col("amount").alias("min_amount"), F.col("amount").alias("max_amount"))
    return e, first


def _next_hop(cur: DataFrame, e: DataFrame, band: float, span_us: int, ordered: bool) -> DataFrame:
    """Chains one hop longer. A next hop starts at the chain's end, within +-span of its last hop in
    time and one amount bucket; a chain that has left the span or the band goes no further."""
    nxt = (e.withColumn("_nb", F.explode(F.array(F.col("tb") - 1, F.col("tb"), F.col("tb") + 1)))
           .withColumn("_na", F.explode(F.array(F.col("ab") - 1, F.col("ab"), F.col("ab") + 1)))
           .select(F.col("transaction_id").alias("_txn"), F.col("src").alias("_src"), F.col("dst").alias("_dst"),
                   F.col("us").alias("_us"), F.col("amount").alias("_amt"), F.col("tb").alias("_ntb"), F.col("ab").alias("_nab"),
                   "_nb", "_na"))
    j = cur.join(nxt.hint("merge"), (cur["_end"] == nxt["_src"]) & (cur["_tb"] == nxt["_nb"]) & (cur["_ab"] == nxt["_na"]))
    us_min, us_max = F.least("_us_min", "_us"), F.greatest("_us_max", "_us")
    lo, hi = F.least("min_amount", "_amt"), F.greatest("max_amount", "_amt")
    cond = (us_max - us_min <= span_us) & (lo >= F.lit(band) * hi) & ~F.array_contains(F.col("accounts"), F.col("_dst"))
    if ordered:
        cond &= F.col("_us") >= F.col("_us_last")
    return j.filter(cond).select(
        F.concat("txns", F.array("_txn")).alias("txns"), F.concat("accounts", F.array("_dst")).alias("accounts"),
        F.col("_dst").alias("_end"), F.col("_us").alias("_us_last"), F.col("_ntb").alias("_tb"), F.col("_nab").alias("_ab"),
        F.col("_amt").alias("_amt_last"), us_min.alias("_us_min"), us_max.alias("_us_max"), lo.alias("min_amount"), hi.alias("max_amount"))


def _chains(cur: DataFrame, base_range) -> DataFrame:
    if base_range is not None:
        cur = cur.filter((F.col("max_amount") >= F.lit(float(base_range[0]))) & (F.col("max_amount") <= F.lit(float(base_range[1]))))
    return cur.select("txns", "accounts", ((F.col("_us_max") - F.col("_us_min")) / F.lit(float(MICROS_PER_SECOND))).alias("span_seconds"),
                      "min_amount", "max_amount")


def layering_chains(df: DataFrame, hops: int = LAYERING_HOPS, band: float = LAYERING_BAND,
                    span_hours: float = LAYERING_SPAN_HOURS, ordered: bool = False,
                    base_range: tuple[float, float] | None = None) -> DataFrame:
    """Chains of ``hops`` transfers a0 -> a1 -> ... -> a_hops over distinct
    accounts, all within ``span_hours`` of each other and every amount at
    least ``band`` x the chain's largest. ``ordered=True`` also requires hop
    times to increase along the chain (planted chains need not be ordered);
    ``base_range`` keeps chains whose largest amount lies in it (planted chains
    start from 50,000 to 200,000).

    Next hops are joined on (account, time bucket, log-amount bucket), each as wide
    as its band, so a hub account's transfers meet only those close in time and amount.

    One row per chain: txn_1..txn_h, account_0..account_h, span_seconds,
    min_amount, max_amount."""
    span_us = int(span_hours * HOUR_US)
    e, cur = _hops(df, band, span_us, base_range)
    for _ in range(2, hops + 1):
        cur = _next_hop(cur, e, band, span_us, ordered)
    return _chains(cur, base_range).select(
        *[F.col("txns")[i].alias(f"txn_{i + 1}") for i in range(hops)],
        *[F.col("accounts")[i].alias(f"account_{i}") for i in range(hops + 1)], "span_seconds", "min_amount", "max_amount")


def layering_chains_between(df: DataFrame, min_hops: int = LAYERING_HOPS, max_hops: int = 5, band: float = LAYERING_BAND,
                            span_hours: float = LAYERING_SPAN_HOURS, ordered: bool = False,
                            base_range: tuple[float, float] | None = None) -> DataFrame:
    """T2 for every length from ``min_hops`` to ``max_hops`` in one pass: the frontier of chains grows hop by
    hop, and each length is kept on the way. Frontiers are pinned, so a hop is computed once and its
    join reads two tables, whose crowded keys (hubs) Spark can split. Rows: hops, txns, accounts,
    span_seconds, min_amount, max_amount."""
    from ledgerscope.session import pin

    span_us = int(span_hours * HOUR_US)
    e, cur = _hops(df, band, span_us, base_range)
    e, out = pin(e), None
    for h in range(1, max_hops + 1):
        cur = pin(cur if h == 1 else _next_hop(cur, e, band, span_us, ordered))
        if h >= min_hops:
            found = _chains(cur, base_range).select(F.lit(h).alias("hops"), "*")
            out = found if out is None else out.unionByName(found)
    return out


def round_trips(df: DataFrame, min_delay_days: float = ROUND_TRIP_MIN_DAYS,
                max_delay_days: float = ROUND_TRIP_MAX_DAYS,
                ratio=ROUND_TRIP_RATIO) -> DataFrame:
    """A -> B followed by B -> A between ``min_delay_days`` and
    ``max_delay_days`` later (inclusive) at ratio[0]..ratio[1] x the amount.
    Equi-key: the swapped account pair plus a time bucket as wide as the
    largest delay; the outbound side is exploded to buckets b and b + 1."""
    lo_us, hi_us = int(min_delay_days * MICROS_PER_DAY), int(max_delay_days * MICROS_PER_DAY)
    e = _edges(df).filter(F.col("src") != F.col("dst"))
    e = e.withColumn("tb", F.floor(F.col("us") / F.lit(hi_us)))
    out = (e.withColumn("_nb", F.explode(F.array(F.col("tb"), F.col("tb") + 1)))
           .select(F.col("transaction_id").alias("out_txn"), F.col("src").alias("account_a"),
                   F.col("dst").alias("account_b"), F.col("us").alias("_us_a"),
                   F.col("amount").alias("_amt_a"), "_nb"))
    back = e.select(F.col("transaction_id").alias("back_txn"), F.col("src").alias("_bsrc"),
                    F.col("dst").alias("_bdst"), F.col("us").alias("_us_b"),
                    F.col("amount").alias("_amt_b"), F.col("tb").alias("_tbb"))
    j = out.join(back.hint("merge"), (out.account_b == back._bsrc) & (out.account_a == back._bdst)
                 & (out._nb == back._tbb))
    d = F.col("_us_b") - F.col("_us_a")
    j = j.filter((d >= lo_us) & (d <= hi_us)
                 & (F.col("_amt_b") >= F.lit(ratio[0]) * F.col("_amt_a"))
                 & (F.col("_amt_b") <= F.lit(ratio[1]) * F.col("_amt_a")))
    return j.select("out_txn", "back_txn", "account_a", "account_b",
                    (d / F.lit(float(MICROS_PER_SECOND))).alias("delay_seconds"),
                    (F.col("_amt_b") / F.col("_amt_a")).alias("amount_ratio"))


def _running_sum(df: DataFrame, key: str, us: str, val: str, tie: str, out: str,
                 bucket_us: int = MICROS_PER_DAY) -> DataFrame:
    """Running sum of ``val`` per ``key`` in (us, tie) order, computed per
    (key, day) partition plus carried per-day totals, so one key's history is
    spread over many tasks."""
    k = F.struct(F.col(key).alias("s"), F.floor(F.col(us) / F.lit(bucket_us)).alias("b"))
    d = df.withColumn("_rk", k)
    w = Window.partitionBy("_rk").orderBy(us, tie).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_in", F.sum(val).over(w))
    tot = d.groupBy("_rk").agg(F.sum(val).alias("_t"))
    wb = Window.partitionBy(F.col("_rk.s")).orderBy(F.col("_rk.b")).rowsBetween(
        Window.unboundedPreceding, -1)
    tot = tot.select("_rk", F.coalesce(F.sum("_t").over(wb), F.lit(0)).alias("_off"))
    return d.join(tot, "_rk").withColumn(out, F.col("_in") + F.col("_off")).drop("_rk", "_in", "_off")


def bursts(df: DataFrame, min_count: int = BURST_MIN_COUNT,
           max_gap_minutes: float = BURST_MAX_GAP_MINUTES,
           max_span_hours: float = BURST_MAX_SPAN_HOURS) -> DataFrame:
    """T4: bursts of one sender: maximal runs of transfers whose consecutive
    gaps are at most ``max_gap_minutes`` (gaps-and-islands), kept when they
    hold at least ``min_count`` transfers within ``max_span_hours``.
    One row per burst: sender, start, end, n_txns, total_amount, first/last id."""
    from ledgerscope.operators.features import time_features

    t = time_features(df.select("transaction_id", "sender_account", "timestamp", "amount"))
    # A gap above the limit opens a new island; a sender's first transfer is
    # island 0 of that sender (the running sum starts at 0).
    t = t.withColumns({
        "_us": epoch_micros("timestamp"),
        "_brk": F.when(F.col("time_since_last_txn") > max_gap_minutes * 60.0, 1).otherwise(0),
    })
    t = _running_sum(t, "sender_account", "_us", "_brk", "transaction_id", "island")
    g = t.groupBy("sender_account", "island").agg(
        F.count(F.lit(1)).alias("n_txns"), F.min("timestamp").alias("start_ts"),
        F.max("timestamp").alias("end_ts"), F.sum("amount").alias("total_amount"),
        F.min_by("transaction_id", F.struct("_us", "transaction_id")).alias("first_txn"),
        F.max_by("transaction_id", F.struct("_us", "transaction_id")).alias("last_txn"),
        (F.max("_us") - F.min("_us")).alias("_span"))
    return (g.filter((F.col("n_txns") >= min_count) &
                     (F.col("_span") <= int(max_span_hours * HOUR_US)))
            .select("sender_account", "start_ts", "end_ts", "n_txns", "total_amount",
                    "first_txn", "last_txn"))

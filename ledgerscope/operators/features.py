"""Feature frame (W1-W7, A1-A8, J1-J4, PF1-PF8).

Shuffle plan of :func:`engineer_all_features`:

* the ledger's wide rows are shuffled once for the time and velocity features,
  on (sender, time bucket), so a sender with a third of all rows is split across
  its buckets; the buckets' totals come from a narrow scan with map-side
  aggregation;
* per-sender, per-receiver and per-pair aggregates with map-side partial
  aggregation, joined back on their key by :func:`attach_by_key`: a measured list of heavy
  keys is salted and only their statistics are replicated, so no key is hot in
  the join. AQE turns it into a broadcast when the aggregate is measured small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerscope.functions.exprs import (
    MICROS_PER_DAY, MICROS_PER_SECOND, RAPID_SECONDS, day_of_week, epoch_micros, flag,
    is_night, is_round_amount, is_self_transfer, is_weekend, near_threshold, pair_high,
    pair_low,
)
from ledgerscope.sources.schema import NON_FEATURE_COLUMNS

DEFAULT_WINDOWS = (1, 7, 30)
SUM_TYPE = T.DecimalType(38, 10)  # exact running sums; no cancellation error

TIME_COLUMNS = ["hour", "day_of_week", "is_weekend", "is_night", "month",
                "time_since_last_txn", "is_rapid"]
AMOUNT_COLUMNS = ["acct_avg_amount", "acct_std_amount", "acct_median_amount",
                  "acct_min_amount", "acct_max_amount", "acct_total_txns", "amount_zscore",
                  "amount_to_avg_ratio", "is_round_amount", "near_threshold"]
NETWORK_COLUMNS = ["n_unique_receivers", "n_unique_senders", "pair_txn_count",
                   "is_self_transfer"]

# Dashboard feature list (19 columns, fixed).
DASHBOARD_FEATURES = [
    "amount", "hour", "day_of_week", "is_weekend", "is_night", "month",
    "acct_avg_amount", "acct_std_amount", "acct_median_amount", "acct_total_txns",
    "amount_zscore", "amount_to_avg_ratio", "is_round_amount", "near_threshold",
    "n_unique_receivers", "n_unique_senders", "is_self_transfer",
    "time_since_last_txn", "is_rapid",
]


def window_label(n) -> str:
    """'1' for 1 or 1.0 days, '0.5' for half a day."""
    return str(int(n)) if float(n).is_integer() else str(n)


def velocity_columns(windows=DEFAULT_WINDOWS) -> list[str]:
    out = []
    for n in windows:
        out += [f"txn_count_{window_label(n)}d", f"txn_sum_{window_label(n)}d"]
    return out


# ---------------------------------------------------------------------------
# Calendar features (pure projection)
# ---------------------------------------------------------------------------

def calendar_features(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """hour, day_of_week (Mon=0), is_weekend, is_night, month."""
    return df.withColumns({
        "hour": F.hour(ts),
        "day_of_week": day_of_week(ts),
        "is_weekend": is_weekend(ts),
        "is_night": is_night(ts),
        "month": F.month(ts),
    })


# ---------------------------------------------------------------------------
# Per-sender time pass: gap to previous transfer (W3/W4) and trailing windows
# (W1/W2), partitioned by (sender, time bucket).
# ---------------------------------------------------------------------------

def _sender_time_pass(df: DataFrame, windows, with_gap: bool, with_velocity: bool,
                      sender: str, ts: str, amount: str, id_col: str,
                      bucket_days: float) -> DataFrame:
    bucket_us = int(bucket_days * MICROS_PER_DAY)
    windows = list(windows) if with_velocity else []
    idx = list(range(len(windows)))
    zero_dec = F.lit(0).cast(SUM_TYPE)
    # A transfer enters every window at t (event 0) and leaves window i at t + N_i
    # (event i + 1). One explode makes the events, so the ledger is scanned once here.
    shifts = [0, *[int(round(float(n) * MICROS_PER_DAY)) for n in windows]]

    def events(rows: DataFrame) -> DataFrame:
        e = rows.withColumn("_e", F.explode(F.array(*[
            F.struct(F.lit(k).alias("k"), F.lit(x).cast("long").alias("shift")) for k, x in enumerate(shifts)])))
        k, has = F.col("_e.k"), F.col(amount).isNotNull().cast("long")
        amt = F.coalesce(F.col(amount).cast(SUM_TYPE), zero_dec)
        at = epoch_micros(ts) + F.col("_e.shift")
        out = {"_us": at, "_k": k, "_kk": F.when(k == 0, 1).otherwise(0),
               "_key": F.struct(F.col(sender).alias("s"), F.floor(at / F.lit(bucket_us)).alias("b"))}
        for i in idx:
            out[f"_dc{i}"] = F.when(k == 0, has).when(k == i + 1, -has).otherwise(0)
            out[f"_ds{i}"] = F.when(k == 0, amt).when(k == i + 1, -amt).otherwise(zero_dec)
        return e.withColumns(out).drop("_e")

    # One partition key for the windows and the join with the totals, so the wide rows
    # are shuffled once. A struct key compares nulls as equal, which keeps null
    # senders together without a null-safe (re-shuffling) join. Leaving events travel
    # without the input columns.
    u = events(df)
    own = [c for c in df.columns if c != sender]
    u = u.withColumns({c: F.when(F.col("_k") == 0, F.col(c)) for c in own})

    # Exits sort before entries at the same instant, so a row exactly N days
    # old has already left the window; entries tied at t are RANGE peers.
    if with_gap:
        w_rows = (Window.partitionBy("_key").orderBy("_us", "_kk", id_col)
                  .rowsBetween(Window.unboundedPreceding, -1))
        u = u.withColumn("_prev", F.last(F.when(F.col("_k") == 0, F.col("_us")),
                                         ignorenulls=True).over(w_rows))
    w_range = (Window.partitionBy("_key").orderBy("_us", "_kk")
               .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    sums = {}
    for i in idx:
        sums[f"_c{i}"] = F.sum(f"_dc{i}").over(w_range)
        sums[f"_s{i}"] = F.sum(f"_ds{i}").over(w_range)
    if sums:
        u = u.withColumns(sums)

    # Per-bucket totals carried forward as offsets: one row per sender and active
    # bucket, from a narrow scan with map-side aggregation.
    aggs = []
    for i in idx:
        aggs += [F.sum(f"_dc{i}").alias(f"_tc{i}"), F.sum(f"_ds{i}").alias(f"_ts{i}")]
    if with_gap:
        aggs.append(F.max(F.when(F.col("_k") == 0, F.col("_us"))).alias("_bmax"))
    tot = events(df.select(*dict.fromkeys([sender, ts, amount]))).groupBy("_key").agg(*aggs)
    wb = (Window.partitionBy(F.col("_key.s")).orderBy(F.col("_key.b"))
          .rowsBetween(Window.unboundedPreceding, -1))
    offs = {}
    for i in idx:
        offs[f"_oc{i}"] = F.coalesce(F.sum(f"_tc{i}").over(wb), F.lit(0).cast("long"))
        offs[f"_os{i}"] = F.coalesce(F.sum(f"_ts{i}").over(wb), zero_dec)
    if with_gap:
        offs["_pmax"] = F.max("_bmax").over(wb)
    tot = tot.select("_key", *[c.alias(k) for k, c in offs.items()])

    ent = u.filter(F.col("_k") == 0)
    j = ent.join(tot, "_key", "left")
    out = {}
    if with_gap:
        prev = F.coalesce(F.col("_prev"), F.col("_pmax"))
        gap = F.coalesce((F.col("_us") - prev) / F.lit(float(MICROS_PER_SECOND)), F.lit(0.0))
        out["time_since_last_txn"] = gap
        out["is_rapid"] = flag((gap > 0) & (gap < RAPID_SECONDS))
    for i, n in enumerate(windows):
        lab = window_label(n)
        out[f"txn_count_{lab}d"] = (F.col(f"_c{i}") + F.col(f"_oc{i}")).cast("long")
        out[f"txn_sum_{lab}d"] = (F.col(f"_s{i}") + F.col(f"_os{i}")).cast("double")
    return j.select(*df.columns, *[c.alias(k) for k, c in out.items()])


def time_features(df: DataFrame, sender: str = "sender_account", ts: str = "timestamp",
                  id_col: str = "transaction_id", bucket_days: float = 1.0) -> DataFrame:
    """Calendar flags plus seconds since the sender's previous transfer
    (first transfer -> 0) and the rapid flag 0 < gap < 300 s."""
    g = _sender_time_pass(df, [], True, False, sender, ts, "amount", id_col, bucket_days)
    g = calendar_features(g, ts)
    return g.select(*df.columns, *TIME_COLUMNS)


def velocity_features(df: DataFrame, windows=DEFAULT_WINDOWS, sender: str = "sender_account",
                      ts: str = "timestamp", amount: str = "amount",
                      id_col: str = "transaction_id", bucket_days: float = 1.0) -> DataFrame:
    """Per sender, count of non-null amounts and their sum over the
    trailing window (t - N days, t]; rows at exactly t - N are out, rows tied
    at t are all in."""
    return _sender_time_pass(df, windows, False, True, sender, ts, amount, id_col, bucket_days)


# ---------------------------------------------------------------------------
# Amount features (A1-A4)
# ---------------------------------------------------------------------------

HEAVY_ROWS = 100_000  # rows of one key that one task may take
HEAVY_SHARE = 2000    # and a heavy key has 1/2000 of all rows, so there are at most 2000 of them


def heavy_keys(df: DataFrame, keys: dict, heavy_rows: int = HEAVY_ROWS, heavy_share: int = HEAVY_SHARE) -> dict:
    """Measured heavy hitters: {name: [(key hash, salts)]} for each ``name: [key expressions]`` over ``df``.
    One narrow scan counts all of them; a key gets a salt per ``heavy_rows`` rows (or per
    1/20000 of the table, if that is more)."""
    n = df.count()
    least, chunk = max(heavy_rows, n // heavy_share), max(heavy_rows, n // 20000)
    names = list(keys)
    each = F.explode(F.array(*[F.when(_known(keys[k]), F.struct(F.lit(i).alias("k"), F.xxhash64(*keys[k]).alias("h")))
                               for i, k in enumerate(names)]))
    found = (df.select(each.alias("e")).filter("e is not null").groupBy("e.k", "e.h").agg(F.count(F.lit(1)).alias("n"))
             .filter(F.col("n") >= least).collect())
    out = {k: [] for k in names}
    for r in found:
        out[names[r.k]].append((r.h, -(-r.n // chunk)))
    return out


def _known(exprs: list):
    cond = exprs[0].isNotNull()
    for e in exprs[1:]:
        cond &= e.isNotNull()
    return cond


def attach_by_key(facts: DataFrame, stats: DataFrame, keys: dict, heavy: list, spread: str = "transaction_id") -> DataFrame:
    """Left join of per-key ``stats`` to the rows they came from. ``keys`` maps a column of
    ``stats`` to the matching expression over ``facts``; ``heavy`` is that key's list of :func:`heavy_keys`.

    Rows of a heavy key are salted and only its statistics are replicated, once per salt. Rows
    without a key match nothing and are dealt by a salt alone."""
    exprs = list(keys.values())
    own = F.pmod(F.xxhash64(spread), F.col("_salts"))
    right = stats.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    if heavy:
        table = F.broadcast(facts.sparkSession.createDataFrame(heavy, "_hh long, _salts long"))  # HEAVY_SHARE rows at most
        j = facts.join(table, F.xxhash64(*exprs) == F.col("_hh"), "left")
        salt = F.when(~_known(exprs), F.pmod(F.xxhash64(spread), F.lit(1 << 16))).when(F.col("_salts").isNull(), 0).otherwise(own)
        right = right.join(table, F.xxhash64(*[F.col(f"_r_{k}") for k in keys]) == F.col("_hh"), "left")
        right = right.withColumn("_r_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1)) - 1))) \
            .drop("_hh", "_salts")
    else:
        j, right = facts, right.withColumn("_r_salt", F.lit(0).cast("long"))
        salt = F.when(~_known(exprs), F.pmod(F.xxhash64(spread), F.lit(1 << 16))).otherwise(0)
    j = j.withColumns({"_salt": salt.cast("long"), **{f"_k_{k}": e for k, e in keys.items()}})
    on = F.col("_salt") == F.col("_r_salt")
    for k in keys:
        on &= F.col(f"_k_{k}") == F.col(f"_r_{k}")
    return j.join(right, on, "left").select(*facts.columns, *[c for c in stats.columns if c not in keys])


MEDIAN_PIECES = 64


def _exact_median_by(df: DataFrame, key: str, value: str, pieces: int = MEDIAN_PIECES) -> DataFrame:
    """Exact median per key from value counts: equal values of a key collapse on the map side.
    The value range is cut at the ledger's own quantiles, so a piece holds about 1/``pieces`` of all
    rows and a key's rows in it no more: a sender with most rows is counted in as many tasks.
    Totals of the pieces (at most ``pieces`` rows a key) show which of them hold the middle ranks;
    only their values are ranked. One scalar job for the cuts; every size takes the same path."""
    known = df.filter(F.col(value).isNotNull())
    cuts = known.agg(F.percentile_approx(value, [i / pieces for i in range(1, pieces)], 10000)).first()[0] or []
    piece = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c < F.col(value).cast("double"))) if cuts else F.lit(0)
    counts = known.groupBy(key, value).agg(F.count(F.lit(1)).alias("_n")).withColumn("_piece", piece)
    w = Window.partitionBy(key)
    totals = counts.groupBy(key, "_piece").agg(F.sum("_n").alias("_t")).withColumns({
        "_before": F.coalesce(F.sum("_t").over(w.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_all": F.sum("_t").over(w)})
    lo, hi = F.floor((F.col("_all") - 1) / 2), F.floor(F.col("_all") / 2)
    middle = totals.filter((F.col("_before") <= hi) & (F.col("_before") + F.col("_t") > lo))
    ranked = counts.join(middle, [key, "_piece"]).withColumn(
        "_upto", F.col("_before") + F.sum("_n").over(Window.partitionBy(key, "_piece").orderBy(value)))
    v = F.col(value).cast("double")
    return ranked.groupBy(key).agg(
        ((F.min(F.when(F.col("_upto") > lo, v)) + F.min(F.when(F.col("_upto") > hi, v))) / 2)
        .alias("acct_median_amount"))


def sender_amount_stats(df: DataFrame, sender: str = "sender_account", amount: str = "amount",
                        approx_median: bool = False, with_min_max: bool = True,
                        receiver: str | None = None) -> DataFrame:
    """A1: mean, sample std, median, min, max and count of amounts per sender.

    Mean, std, min, max and count aggregate partially on the map side. The
    median is exact (see :func:`_exact_median_by`); ``approx_median=True`` uses a bounded-memory
    quantile sketch instead. With ``receiver``, A5 (distinct receivers) comes out
    of the same aggregate."""
    a = F.col(amount)
    aggs = [F.avg(a).alias("acct_avg_amount"), F.stddev_samp(a).alias("acct_std_amount")]
    if approx_median:
        aggs.append(F.percentile_approx(a, 0.5, 10000).cast("double").alias("acct_median_amount"))
    if with_min_max:
        aggs += [F.min(a).alias("acct_min_amount"), F.max(a).alias("acct_max_amount")]
    aggs.append(F.count(a).alias("acct_total_txns"))
    if receiver:
        count = F.approx_count_distinct if approx_median else F.count_distinct
        aggs.append(count(receiver).alias("n_unique_receivers"))
    stats = df.groupBy(sender).agg(*aggs)
    if not approx_median:
        stats = stats.join(_exact_median_by(df, sender, amount), sender, "left")
    cols = ["acct_avg_amount", "acct_std_amount", "acct_median_amount"]
    cols += ["acct_min_amount", "acct_max_amount"] if with_min_max else []
    return stats.select(sender, *cols, "acct_total_txns", *(["n_unique_receivers"] if receiver else []))


def amount_features(df: DataFrame, sender: str = "sender_account", amount: str = "amount",
                    approx_median: bool = False, with_min_max: bool = True, id_col: str = "transaction_id") -> DataFrame:
    """A4: A1 joined back (J1, see :func:`attach_by_key`) plus z-score (A2), ratio to mean (A3), round
    flag (PF6) and near-threshold flag (PF5)."""
    stats = sender_amount_stats(df, sender, amount, approx_median, with_min_max)
    heavy = heavy_keys(df, {"sender": [F.col(sender)]})
    j = attach_by_key(df, stats, {sender: F.col(sender)}, heavy["sender"], id_col)
    a, avg, std = F.col(amount), F.col("acct_avg_amount"), F.col("acct_std_amount")
    return j.withColumns({
        "amount_zscore": F.when(std > 0, (a - avg) / std).otherwise(F.lit(0.0)),
        "amount_to_avg_ratio": F.when(avg > 0, a / avg).otherwise(F.lit(0.0)),
        "is_round_amount": is_round_amount(amount),
        "near_threshold": near_threshold(amount),
    })


# ---------------------------------------------------------------------------
# Network features
# ---------------------------------------------------------------------------

def distinct_receivers(df: DataFrame, sender="sender_account", receiver="receiver_account",
                       approx: bool = False) -> DataFrame:
    """A5: distinct receivers per sender (nulls not counted)."""
    f = F.approx_count_distinct if approx else F.count_distinct
    return df.groupBy(sender).agg(f(receiver).alias("n_unique_receivers"))


def distinct_senders(df: DataFrame, sender="sender_account", receiver="receiver_account",
                     approx: bool = False) -> DataFrame:
    """Distinct senders per receiver."""
    f = F.approx_count_distinct if approx else F.count_distinct
    return df.groupBy(receiver).agg(f(sender).alias("n_unique_senders"))


def pair_counts(df: DataFrame, sender="sender_account", receiver="receiver_account") -> DataFrame:
    """Transfers per unordered account pair (both directions together);
    a transfer with an unknown side belongs to no pair."""
    return (df.filter(F.col(sender).isNotNull() & F.col(receiver).isNotNull()).groupBy(pair_low(sender, receiver).alias("_pair_lo"),
                       pair_high(sender, receiver).alias("_pair_hi"))
            .agg(F.count(F.lit(1)).alias("pair_txn_count")))


def _pair_keys(sender, receiver) -> dict:
    """The pair as join key, null for a transfer with an unknown side."""
    both = F.col(sender).isNotNull() & F.col(receiver).isNotNull()
    return {"_pair_lo": F.when(both, pair_low(sender, receiver)), "_pair_hi": F.when(both, pair_high(sender, receiver))}


def _account_heavy(df: DataFrame, sender, receiver, with_pairs: bool) -> dict:
    keys = {"sender": [F.col(sender)], "receiver": [F.col(receiver)]}
    return heavy_keys(df, keys | ({"pair": list(_pair_keys(sender, receiver).values())} if with_pairs else {}))


def network_features(df: DataFrame, sender="sender_account", receiver="receiver_account",
                     with_pairs: bool = True, approx: bool = False, id_col: str = "transaction_id") -> DataFrame:
    """Distinct counterparties both ways (J2, J3), pair count (J4) and
    self-transfer flag (PF7); the joins are those of :func:`attach_by_key`."""
    heavy = _account_heavy(df, sender, receiver, with_pairs)
    j = attach_by_key(df, distinct_receivers(df, sender, receiver, approx), {sender: F.col(sender)}, heavy["sender"], id_col)
    j = attach_by_key(j, distinct_senders(df, sender, receiver, approx), {receiver: F.col(receiver)}, heavy["receiver"], id_col)
    if with_pairs:
        j = attach_by_key(j, pair_counts(df, sender, receiver), _pair_keys(sender, receiver), heavy["pair"], id_col).withColumn(
            "pair_txn_count", F.coalesce(F.col("pair_txn_count"), F.lit(0)).cast("long"))
    return j.withColumn("is_self_transfer", is_self_transfer(sender, receiver))


# ---------------------------------------------------------------------------
# Full frame (W6), dashboard subset (W7), column selection (PF1), null fill (PF2)
# ---------------------------------------------------------------------------

def fill_numeric_nulls(df: DataFrame, value: float = 0) -> DataFrame:
    """PF2: numeric nulls -> 0, strings stay null."""
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return df.na.fill(value, subset=num) if num else df


def feature_columns(df: DataFrame, exclude=NON_FEATURE_COLUMNS) -> list[str]:
    """PF1: every numeric column except identifiers and labels."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def _fused_frame(df: DataFrame, windows, with_velocity: bool, with_pairs: bool,
                 with_min_max: bool, sender, receiver, ts, amount, id_col, approx, bucket_days,
                 columns: list[str]) -> DataFrame:
    """Time pass, three aggregate joins, then one projection computing every
    derived column and the null fill (few DataFrame operations, so plan
    analysis stays cheap)."""
    t = _sender_time_pass(df, windows, True, with_velocity, sender, ts, amount, id_col, bucket_days)
    heavy = _account_heavy(df, sender, receiver, with_pairs)
    stats = sender_amount_stats(df, sender, amount, approx, with_min_max, receiver)
    t = attach_by_key(t, stats, {sender: F.col(sender)}, heavy["sender"], id_col)
    t = attach_by_key(t, distinct_senders(df, sender, receiver, approx), {receiver: F.col(receiver)}, heavy["receiver"], id_col)
    if with_pairs:
        t = attach_by_key(t, pair_counts(df, sender, receiver), _pair_keys(sender, receiver), heavy["pair"], id_col)
    a, avg, std = F.col(amount), F.col("acct_avg_amount"), F.col("acct_std_amount")
    derived = {
        "hour": F.hour(ts), "day_of_week": day_of_week(ts), "is_weekend": is_weekend(ts),
        "is_night": is_night(ts), "month": F.month(ts),
        "amount_zscore": F.when(std > 0, (a - avg) / std).otherwise(F.lit(0.0)),
        "amount_to_avg_ratio": F.when(avg > 0, a / avg).otherwise(F.lit(0.0)),
        "is_round_amount": is_round_amount(amount), "near_threshold": near_threshold(amount),
        "is_self_transfer": is_self_transfer(sender, receiver),
    }
    if with_pairs:
        derived["pair_txn_count"] = F.coalesce(F.col("pair_txn_count"), F.lit(0)).cast("long")
    types = {f.name: f.dataType for f in t.schema.fields}
    out = []
    for c in columns:
        e = derived.get(c, F.col(c))
        numeric = c in derived or isinstance(types.get(c), T.NumericType)
        out.append((F.coalesce(e, F.lit(0)) if numeric else e).alias(c))
    return t.select(*out)


def engineer_all_features(df: DataFrame, windows=DEFAULT_WINDOWS, *,
                          sender="sender_account", receiver="receiver_account",
                          ts="timestamp", amount="amount", id_col="transaction_id",
                          approx: bool = False, bucket_days: float = 1.0) -> DataFrame:
    """Time -> amount -> network -> velocity -> null fill, as one lazy plan.
    The gap and the trailing windows share one exchange on (sender, bucket)."""
    cols = [*df.columns, *TIME_COLUMNS, *AMOUNT_COLUMNS, *NETWORK_COLUMNS,
            *velocity_columns(windows)]
    return _fused_frame(df, windows, bool(windows), True, True, sender, receiver, ts, amount,
                        id_col, approx, bucket_days, cols)


def engineer_dashboard_features(df: DataFrame, *, sender="sender_account",
                                receiver="receiver_account", ts="timestamp",
                                amount="amount", id_col="transaction_id",
                                approx: bool = False, bucket_days: float = 1.0) -> DataFrame:
    """The dashboard's lighter frame: no velocity, no pair count, no
    min/max of amount."""
    cols = [*df.columns, *[c for c in DASHBOARD_FEATURES if c not in df.columns]]
    return _fused_frame(df, [], False, False, False, sender, receiver, ts, amount, id_col,
                        approx, bucket_days, cols)


ACCOUNT_VECTOR_COLUMNS = ["f_avg", "f_std", "f_cnt", "f_rcv"]


def account_vectors(df: DataFrame, sender="sender_account", receiver="receiver_account",
                    amount="amount") -> DataFrame:
    """Per-sender behaviour vector (mean amount, sample std or 0, transfer
    count, distinct receivers): the unit the account-level LOF and DBSCAN
    queries cluster."""
    a = F.col(amount)
    return df.groupBy(sender).agg(
        F.avg(a).alias("f_avg"), F.coalesce(F.stddev_samp(a), F.lit(0.0)).alias("f_std"),
        F.count(a).cast("double").alias("f_cnt"),
        F.count_distinct(receiver).cast("double").alias("f_rcv"))

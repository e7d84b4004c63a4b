"""Feature operators: reference-style range checks plus exact edge frames."""

from pyspark.sql import functions as F

from conftest import txn_frame
from ledgerscope.operators import features as FE


def _rows(df, key="transaction_id"):
    return {r[key]: r for r in df.collect()}


def test_amount_features_ranges(features):
    r = features.agg(F.min("amount_to_avg_ratio"), F.min("near_threshold"), F.max("near_threshold"),
                     F.min("is_round_amount"), F.max("is_round_amount")).first()
    assert r[0] >= 0
    assert {r[1], r[2]} <= {0, 1} and {r[3], r[4]} <= {0, 1}
    bad = features.filter((F.col("near_threshold") == 1) &
                          ((F.col("amount") < 8000) | (F.col("amount") >= 10000))).count()
    assert bad == 0
    assert features.filter((F.col("is_round_amount") == 1) & (F.pmod("amount", F.lit(1000.0)) != 0)).count() == 0


def test_zscore_zero_when_no_spread(features):
    assert features.filter((F.col("acct_std_amount") == 0) & (F.col("amount_zscore") != 0)).count() == 0


def test_network_features(features):
    assert features.filter(F.col("n_unique_receivers") < 1).count() == 0
    selfs = features.filter(F.col("sender_account") == F.col("receiver_account"))
    assert selfs.filter(F.col("is_self_transfer") != 1).count() == 0


def test_time_features(features):
    r = features.agg(F.min("hour"), F.max("hour"), F.min("is_weekend"), F.max("is_weekend"),
                     F.min("is_rapid"), F.max("is_rapid")).first()
    assert 0 <= r[0] and r[1] <= 23
    assert {r[2], r[3], r[4], r[5]} <= {0, 1}


def test_full_pipeline_columns_and_no_nulls(features):
    cols = FE.feature_columns(features)
    assert len(cols) == 28
    nulls = features.select([F.sum(F.col(c).isNull().cast("int")).alias(c) for c in cols]).first()
    assert all(v == 0 for v in nulls)


def test_edge_window_velocity(spark):
    # FIXTURES edge_window: exactly one day back is excluded, ties count each other.
    df = txn_frame(spark, [
        (1, "2024-01-01 00:00:00", 2, 9, 1.0), (2, "2024-01-01 13:00:00", 2, 9, 2.0),
        (3, "2024-01-02 00:00:00", 2, 9, 4.0), (4, "2024-01-02 00:00:00", 2, 9, 8.0),
        (5, "2024-01-01 12:00:00", 1, 9, 10.0)])
    for bucket in (1.0, 0.1):  # split into many (sender, bucket) partitions: same answer
        v = _rows(FE.velocity_features(df, windows=[1], bucket_days=bucket))
        assert v[3]["txn_sum_1d"] == 14.0 and v[4]["txn_sum_1d"] == 14.0
        assert v[3]["txn_count_1d"] == 3 and v[1]["txn_count_1d"] == 1
        assert v[2]["txn_sum_1d"] == 3.0 and v[5]["txn_sum_1d"] == 10.0


def test_edge_single_and_gap(spark):
    df = txn_frame(spark, [
        (1, "2024-01-01 00:00:00", 7, 8, 5.0), (2, "2024-01-01 00:00:00", 3, 8, 1.0),
        (3, "2024-01-01 00:00:01", 3, 8, 1.0), (4, "2024-01-01 00:05:00", 3, 8, 1.0),
        (5, "2024-01-01 00:10:00", 3, 8, 1.0)])
    f = _rows(FE.engineer_all_features(df))
    assert f[1]["acct_std_amount"] == 0 and f[1]["amount_zscore"] == 0 and f[1]["time_since_last_txn"] == 0
    gaps = [f[i]["time_since_last_txn"] for i in (2, 3, 4, 5)]
    assert gaps == [0.0, 1.0, 299.0, 300.0]
    assert [f[i]["is_rapid"] for i in (2, 3, 4, 5)] == [0, 1, 1, 0]


def test_edge_gap_across_buckets(spark):
    # previous transfer several buckets back is still found
    df = txn_frame(spark, [(1, "2024-01-01 10:00:00", 3, 8, 1.0), (2, "2024-01-05 10:00:00", 3, 8, 1.0)])
    t = _rows(FE.time_features(df, bucket_days=1.0))
    assert t[2]["time_since_last_txn"] == 4 * 86400.0


def test_edge_nulls(spark):
    df = txn_frame(spark, [(1, "2024-01-01 00:00:00", None, None, None), (2, "2024-01-01 00:00:00", 4, 5, 10.0)])
    f = _rows(FE.engineer_all_features(df))
    assert f[1]["acct_avg_amount"] == 0 and f[1]["txn_count_1d"] == 0 and f[1]["is_self_transfer"] == 0


def test_edge_amount_flags(spark):
    amts = [7999.99, 8000.0, 9999.99, 10000.0, 50000.0, 50000.01, -1000.0]
    df = txn_frame(spark, [(i, "2024-01-01 00:00:00", 1, 2, a) for i, a in enumerate(amts)])
    f = _rows(FE.amount_features(df))
    assert [f[i]["near_threshold"] for i in range(7)] == [0, 1, 1, 0, 0, 0, 0]
    assert [f[i]["is_round_amount"] for i in range(7)] == [0, 1, 0, 1, 1, 0, 1]


def test_edge_hours(spark):
    ts = ["2024-01-05 05:59:00", "2024-01-06 06:00:00", "2024-01-07 21:59:00", "2024-01-08 22:00:00"]
    df = txn_frame(spark, [(i, t, 1, 2, 1.0) for i, t in enumerate(ts)])
    f = _rows(FE.calendar_features(df))
    assert [f[i]["is_night"] for i in range(4)] == [1, 0, 0, 1]
    assert [f[i]["day_of_week"] for i in range(4)] == [4, 5, 6, 0]
    assert [f[i]["is_weekend"] for i in range(4)] == [0, 1, 1, 0]


def test_edge_pairs(spark):
    df = txn_frame(spark, [(1, "2024-01-01 00:00:00", 1, 2, 1.0), (2, "2024-01-01 00:00:00", 2, 1, 1.0),
                           (3, "2024-01-01 00:00:00", 1, 1, 1.0)])
    f = _rows(FE.network_features(df))
    assert [f[i]["pair_txn_count"] for i in (1, 2, 3)] == [2, 2, 1]
    assert [f[i]["is_self_transfer"] for i in (1, 2, 3)] == [0, 0, 1]


def test_exact_median_hot_senders(spark, ledger):
    txn = ledger[0]
    want = txn.toPandas().groupby("sender_account")["amount"].median().to_dict()
    got = FE.sender_amount_stats(txn).collect()
    assert len(got) == len(want)
    assert all(abs(r.acct_median_amount - want[r.sender_account]) < 1e-9 for r in got)


def test_time_pass_scans(spark, ledger):
    """The wide ledger is scanned once for all events, and once narrowly for the bucket totals."""
    import re

    def scans(df):
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        return len(re.findall("FileScan", plan.split("== Initial Plan ==")[0]))
    assert scans(FE.velocity_features(ledger[0])) <= 2
    assert scans(FE.engineer_all_features(ledger[0], windows=(1, 8))) <= 7  # not the cached fixture


def test_hot_sender_and_unknown_accounts_are_dealt_out(spark):
    """One sender with half the rows, a quarter without sender: the joins equal the plain ones and no
    partition of the shuffle join gets the hot rows together."""
    n = 8000
    df = spark.range(n).select(
        F.col("id").alias("transaction_id"), (F.lit("2024-01-01").cast("timestamp") + F.make_interval(mins=F.col("id").cast("int"))).alias("timestamp"),
        F.when(F.col("id") % 2 == 0, 1).when(F.col("id") % 4 == 1, F.lit(None)).otherwise(F.col("id") % 50).cast("long").alias("sender_account"),
        F.when(F.col("id") % 9 == 0, F.lit(None)).otherwise(F.col("id") % 7).cast("long").alias("receiver_account"),
        (F.col("id") * 37 % 1009 / 3).alias("amount"))
    pdf = df.toPandas()
    stats, key = FE.sender_amount_stats(df), {"sender_account": F.col("sender_account")}
    heavy = FE.heavy_keys(df, {"sender": list(key.values())}, heavy_rows=200)["sender"]
    assert len(heavy) == 1 and heavy[0][1] >= 20  # 4,000 rows of sender 1 and more
    got = {r.transaction_id: r for r in FE.attach_by_key(df, stats, key, heavy).collect()}
    assert len(got) == n
    g = pdf.dropna(subset=["sender_account"]).groupby("sender_account")["amount"]
    mean, median, count = g.mean(), g.median(), g.count()
    for r in got.values():
        if r.sender_account is None:
            assert r.acct_avg_amount is None and r.acct_total_txns is None
        else:
            assert abs(r.acct_avg_amount - mean[r.sender_account]) < 1e-9
            assert abs(r.acct_median_amount - median[r.sender_account]) < 1e-9 and r.acct_total_txns == count[r.sender_account]
    pairs = pdf.dropna(subset=["sender_account", "receiver_account"])
    lo, hi = pairs[["sender_account", "receiver_account"]].min(axis=1), pairs[["sender_account", "receiver_account"]].max(axis=1)
    want = dict(zip(pairs.transaction_id, lo.groupby([lo, hi]).transform("size")))
    net = {r.transaction_id: r.pair_txn_count for r in FE.network_features(df).collect()}
    assert net == {i: int(want.get(i, 0)) for i in range(n)}
    # The join's own keys, dealt to partitions: hot and unknown senders carry a salt.
    plan = FE.attach_by_key(df, stats, key, heavy)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        sizes = [r.n for r in plan.select("transaction_id", F.spark_partition_id().alias("p")).groupBy("p").agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sizes.sort()
    assert len(sizes) < 2 or sizes[-1] <= 2 * sizes[len(sizes) // 2]

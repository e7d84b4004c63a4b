"""Report operators on edge frames, IO round trip, partition invariance."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL, txn_frame
from ledgerscope.operators import features as FE
from ledgerscope.operators import report as RP
from ledgerscope.sources import io as IO


def test_edge_weeks_spine_and_sunday_label(spark):
    # Sunday 2024-01-07 13:00 belongs to the week ending that Sunday; the
    # week ending 2024-01-14 is empty and must appear with zeros.
    df = txn_frame(spark, [(1, "2024-01-07 13:00:00", 1, 2, 10.0), (2, "2024-01-21 09:00:00", 1, 2, 5.0)])
    df = df.withColumn("is_alert", F.lit(1))
    w = {r.week_end: r for r in RP.weekly_volume(df).collect()}
    assert sorted(w) == [dt.date(2024, 1, 7), dt.date(2024, 1, 14), dt.date(2024, 1, 21)]
    assert (w[dt.date(2024, 1, 14)].total, w[dt.date(2024, 1, 14)].volume) == (0, 0.0)
    assert w[dt.date(2024, 1, 7)].total == 1


def test_heatmap_has_all_days(spark):
    df = txn_frame(spark, [(1, "2024-01-01 03:00:00", 1, 2, 1.0)]).withColumn("is_suspicious", F.lit(1))
    h = RP.suspicious_heatmap(df).orderBy("day_of_week").collect()
    assert [r.day_name for r in h][:2] == ["Monday", "Tuesday"] and len(h) == 7
    assert h[0].h03 == 1 and sum(r.h03 for r in h) == 1


def test_filter_view_inclusive(spark):
    df = txn_frame(spark, [(1, "2024-01-05 00:00:00", 1, 2, 100.0), (2, "2024-01-20 23:59:59", 1, 2, 20000.0),
                           (3, "2024-01-21 00:00:00", 1, 2, 50.0), (4, "2024-01-10 00:00:00", 1, 2, 600000.0)])
    df = df.withColumn("ensemble_score", F.lit(0.3))
    v = RP.filter_view(df, start="2024-01-05", end="2024-01-20", amount_min=100, threshold=0.3)
    assert sorted(r.transaction_id for r in v.collect()) == [1, 2, 4]
    capped = RP.filter_view(df, start="2024-01-05", end="2024-01-20", amount_min=100, amount_max=20000)
    assert sorted(r.transaction_id for r in capped.collect()) == [1, 2]
    assert v.agg(F.min("is_alert")).first()[0] == 1


def test_no_default_bound_drops_a_row(spark):
    df = txn_frame(spark, [(1, "2024-01-05 00:00:00", 1, 2, 600000.0), (2, "2024-01-20 00:00:00", 1, 2, -5.0),
                           (3, "2024-01-21 00:00:00", 1, 2, None)]).withColumn("ensemble_score", F.lit(0.9))
    assert RP.filter_view(df).count() == 3 and RP.kpis(RP.filter_view(df)).first()[0] == 3


def test_text_ids_round_trip_and_malformed_rows_raise(spark):
    import os

    import pytest
    folder = tempfile.mkdtemp(prefix="ledgerscope-io-")
    head = "transaction_id,timestamp,sender_account,receiver_account,amount,transaction_type,currency,is_suspicious,pattern_type\n"
    good, bad = os.path.join(folder, "good.csv"), os.path.join(folder, "bad.csv")
    row = "TXN00000001,2024-01-01 10:00:00,ACC000001,ACC000002,12.5,ach,USD,0,normal\n"
    for path, body in ((good, row), (bad, row + row.replace("12.5", "twelve"))):
        with open(path, "w") as f:
            f.write(head + body)
    r = IO.read_transactions(spark, good).first()
    assert (r.transaction_id, r.sender_account, r.receiver_account, r.amount) == ("TXN00000001", "ACC000001", "ACC000002", 12.5)
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        IO.read_transactions(spark, bad).collect()
    with pytest.raises(FileNotFoundError):
        IO.read_accounts(spark, folder + "/none.csv")


def test_unknown_side_belongs_to_no_pair(spark):
    df = txn_frame(spark, [(1, "2024-01-05 00:00:00", 5, 5, 1.0), (2, "2024-01-05 00:00:00", 5, None, 1.0),
                           (3, "2024-01-05 00:00:00", None, 5, 1.0)])
    assert [tuple(r) for r in FE.pair_counts(df).collect()] == [(5, 5, 1)]
    got = {r.transaction_id: r.pair_txn_count for r in FE.network_features(df).collect()}
    assert got == {1: 1, 2: 0, 3: 0}


def test_forest_labels_new_data_with_the_training_offset(spark):
    import random

    from ledgerscope.operators import iforest as IF
    rng = random.Random(4)
    train = spark.createDataFrame([(i, rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(1000)], "id long, a double, b double")
    new = spark.createDataFrame([(i, rng.gauss(0, .1), rng.gauss(0, .1)) for i in range(200)] + [(999, 9.0, 9.0)],
                                "id long, a double, b double")
    model = IF.fit_isolation_forest(train, "id", ["a", "b"], n_estimators=50)
    own = IF.isolation_forest_scores(train, "id", ["a", "b"], n_estimators=50)
    assert own.filter("if_label = -1").count() == 30  # three percent of the training rows
    assert [r.id for r in IF.isolation_forest_scores(new, "id", ["a", "b"], model=model).filter("if_label = -1").collect()] == [999]


def test_csv_roundtrip(spark, ledger):
    txn = ledger[0]
    path = tempfile.mkdtemp(prefix="ledgerscope-io-") + "/t"
    IO.write_table(txn, path, fmt="csv")
    back = IO.read_transactions(spark, path, fmt="csv", id_type=T.LongType())
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, txn.collect()))


def test_feature_frame_partition_invariant(spark, ledger):
    txn = ledger[0]
    a = FE.engineer_all_features(txn)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        b = FE.engineer_all_features(txn.repartition(5), bucket_days=0.25)
        rb = sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in b.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    ra = sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in a.collect())
    assert ra == rb

"""Typology matchers on hand-built ledgers."""

from conftest import txn_frame
from ledgerscope.operators import patterns as PT


def test_layering_chain(spark):
    df = txn_frame(spark, [
        (1, "2024-01-01 10:00:00", 1, 2, 100000.0), (2, "2024-01-01 10:30:00", 2, 3, 98000.0),
        (3, "2024-01-01 11:00:00", 3, 4, 97000.0), (4, "2024-01-01 11:10:00", 3, 1, 97000.0),  # back to start
        (5, "2024-01-02 11:00:00", 3, 5, 97000.0)])  # too late
    c = PT.layering_chains(df, hops=3).collect()
    assert [(r.txn_1, r.txn_2, r.txn_3) for r in c] == [(1, 2, 3)]
    two = sorted((r.txn_1, r.txn_2) for r in PT.layering_chains(df, hops=2, ordered=True).collect())
    assert two == [(1, 2), (2, 3), (2, 4)]


def test_layering_lengths_in_one_pass(spark):
    rows = [(i, f"2024-01-01 10:{i:02d}:00", i, i + 1, 100000.0 - 500 * i) for i in range(1, 8)]  # 1 -> 2 -> ... -> 8
    rows += [(20 + i, f"2024-01-01 11:{i:02d}:00", 3, 100 + i, 99000.0) for i in range(30)]  # a hub
    rows.append((60, "2024-01-01 11:00:00", 4, 5, 1000.0))  # outside the band
    df = txn_frame(spark, rows)
    got = PT.layering_chains_between(df, 2, 5).collect()
    for h in (2, 3, 4, 5):
        one = {tuple(r[f"txn_{i}"] for i in range(1, h + 1)) for r in PT.layering_chains(df, hops=h).collect()}
        assert {tuple(r.txns) for r in got if r.hops == h} == one and one
    assert len({tuple(r.txns) for r in got}) == len(got) and all(len(set(r.accounts)) == r.hops + 1 for r in got)


def test_exploded_sides_are_never_broadcast(spark):
    df = txn_frame(spark, [(i, f"2024-01-01 10:{i:02d}:00", i, i + 1, 100000.0 - i) for i in range(1, 8)])
    for found in (PT.layering_chains(df, hops=3), PT.round_trips(df)):
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "SortMergeJoin" in plan


def test_round_trip(spark):
    df = txn_frame(spark, [
        (1, "2024-01-01 00:00:00", 1, 2, 50000.0), (2, "2024-01-04 00:00:00", 2, 1, 49000.0),
        (3, "2024-01-01 00:00:00", 3, 4, 50000.0), (4, "2024-01-01 12:00:00", 4, 3, 50000.0),  # too soon
        (5, "2024-01-05 00:00:00", 2, 1, 60000.0)])  # ratio too high
    r = PT.round_trips(df).collect()
    assert [(x.out_txn, x.back_txn) for x in r] == [(1, 2)]
    assert r[0].delay_seconds == 3 * 86400


def test_bursts_and_structuring(spark):
    rows = [(i, f"2024-01-01 10:{i * 5:02d}:00", 7, 8, 9000.0, "cash_deposit") for i in range(6)]
    rows.append((99, "2024-01-03 10:00:00", 7, 8, 9000.0, "cash_deposit"))
    df = txn_frame(spark, rows)
    b = PT.bursts(df).collect()
    assert len(b) == 1 and b[0].n_txns == 6 and b[0].first_txn == 0 and b[0].last_txn == 5
    s = {r.transaction_id: r.n_in_window for r in PT.structuring(df).collect()}
    # 99 is exactly 48 h after transfer 0 (excluded) and sees 1..5 plus itself
    assert s[2] == 3 and s[5] == 6 and s[99] == 6 and 0 not in s

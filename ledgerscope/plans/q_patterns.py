"""Registered queries: typology matchers."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from ledgerscope.operators import patterns as PT
from ledgerscope.plans.oracle_sql import TXN_VIEW, US, with_views
from ledgerscope.plans.registry import register, sql_cols, views


def _sql(spec: str, body: str) -> str:
    return with_views(f"SELECT {sql_cols(spec)} {body}", TXN_VIEW)


@register("t1_structuring", _sql(
    "transaction_id:i, sender_account:i, timestamp:t, amount:d, n_in_window:i",
    f"FROM (SELECT *, count(amount) OVER (PARTITION BY sender_account ORDER BY {US} "
    f"RANGE BETWEEN {2 * 86_400_000_000 - 1} PRECEDING AND CURRENT ROW) AS n_in_window "
    "FROM txn WHERE transaction_type = 'cash_deposit' AND amount >= 8000 AND amount < 10000) "
    "WHERE n_in_window >= 3"))
def t1(spark, sf):
    """>= 3 near-threshold cash deposits by one sender within 48 h."""
    txn, _ = views(spark, sf)
    return PT.structuring(txn)


_HOPS, _BAND, _SPAN_US = 3, 0.5, 5 * 3600 * 1_000_000


def _layering_sql(hops: int, band: float, span_us: int) -> str:
    frm = ", ".join(f"e h{i}" for i in range(1, hops + 1))
    conds = [f"h{i}.src = h{i - 1}.dst" for i in range(2, hops + 1)]
    accts = ["h1.src"] + [f"h{i}.dst" for i in range(1, hops + 1)]
    conds += [f"{a} <> {b}" for a, b in combinations(accts, 2)]
    us = ", ".join(f"h{i}.us" for i in range(1, hops + 1))
    am = ", ".join(f"h{i}.amount" for i in range(1, hops + 1))
    conds += [f"greatest({us}) - least({us}) <= {span_us}",
              f"least({am}) >= CAST({band!r} AS DOUBLE) * greatest({am})"]
    spec = ", ".join([f"txn_{i}:i=h{i}.transaction_id" for i in range(1, hops + 1)]
                     + [f"account_{i}:i={a}" for i, a in enumerate(accts)]
                     + [f"span_seconds:d=(greatest({us}) - least({us})) / 1e6",
                        f"min_amount:d=least({am})", f"max_amount:d=greatest({am})"])
    body = (f"FROM {frm} WHERE " + " AND ".join(conds))
    edges = (f"e AS (SELECT transaction_id, sender_account AS src, receiver_account AS dst, "
             f"{US} AS us, amount FROM txn WHERE sender_account IS NOT NULL AND receiver_account "
             "IS NOT NULL AND amount IS NOT NULL AND \"timestamp\" IS NOT NULL "
             "AND sender_account <> receiver_account)")
    return with_views(f"SELECT {sql_cols(spec)} {body}", TXN_VIEW, edges)


@register("t2_layering_chains", _layering_sql(_HOPS, _BAND, _SPAN_US))
def t2(spark, sf):
    """3-hop chains over distinct accounts within 5 h, amounts within
    0.5x of the chain's largest (a looser band than the planted 0.95, so the
    fixture ledger yields chains)."""
    txn, _ = views(spark, sf)
    return PT.layering_chains(txn, hops=_HOPS, band=_BAND, span_hours=5.0)


@register("t2b_layering_chains_ordered", _layering_sql(2, 0.95, _SPAN_US).replace(
    "WHERE h2.src = h1.dst", "WHERE h2.us >= h1.us AND h2.src = h1.dst"))
def t2b(spark, sf):
    """Time-ordered 2-hop chains at the planted 95 % band."""
    txn, _ = views(spark, sf)
    return PT.layering_chains(txn, hops=2, band=0.95, span_hours=5.0, ordered=True)


def _lengths_sql(shortest: int, longest: int, band: float, span_us: int) -> str:
    edges = (f"e AS (SELECT transaction_id AS id, sender_account AS src, receiver_account AS dst, {US} AS us, amount FROM txn "
             "WHERE amount IS NOT NULL AND \"timestamp\" IS NOT NULL AND sender_account <> receiver_account)")
    chains = ("c(hops, txns, accounts, tail, t0, t1, lo, hi) AS (SELECT 1, [id], [src, dst], dst, us, us, amount, amount FROM e "
              "UNION ALL SELECT hops + 1, list_append(txns, e.id), list_append(accounts, e.dst), e.dst, least(t0, e.us), "
              "greatest(t1, e.us), least(lo, e.amount), greatest(hi, e.amount) FROM c JOIN e ON e.src = c.tail "
              f"WHERE hops < {longest} AND NOT list_contains(accounts, e.dst) AND greatest(t1, e.us) - least(t0, e.us) <= {span_us} "
              f"AND least(lo, e.amount) >= CAST({band!r} AS DOUBLE) * greatest(hi, e.amount))")
    spec = sql_cols("hops:i, txns:s=array_to_string(txns, '-'), accounts:s=array_to_string(accounts, '-'), "
                    "span_seconds:d=(t1 - t0) / 1e6, min_amount:d=lo, max_amount:d=hi")
    return with_views(f"SELECT {spec} FROM c WHERE hops >= {shortest}", TXN_VIEW, edges, chains, recursive=True)


@register("t2c_layering_3_to_5_hops", _lengths_sql(3, 5, _BAND, _SPAN_US))
def t2c(spark, sf):
    """Chains of 3, 4 and 5 hops from one growing frontier, at the band of ``t2``."""
    txn, _ = views(spark, sf)
    c = PT.layering_chains_between(txn, 3, 5, band=_BAND, span_hours=5.0)
    return c.select("hops", F.array_join(F.col("txns").cast("array<string>"), "-").alias("txns"),
                    F.array_join(F.col("accounts").cast("array<string>"), "-").alias("accounts"),
                    "span_seconds", "min_amount", "max_amount")


@register("t3_round_trips", _sql(
    "out_txn:i=a.transaction_id, back_txn:i=b.transaction_id, account_a:i=a.sender_account, "
    "account_b:i=a.receiver_account, delay_seconds:d=(epoch_us(b.\"timestamp\") - epoch_us(a.\"timestamp\")) / 1e6, "
    "amount_ratio:d=b.amount / a.amount",
    "FROM txn a JOIN txn b ON b.sender_account = a.receiver_account AND b.receiver_account = a.sender_account "
    "WHERE a.sender_account <> a.receiver_account AND a.amount IS NOT NULL AND b.amount IS NOT NULL "
    "AND epoch_us(b.\"timestamp\") - epoch_us(a.\"timestamp\") BETWEEN 86400000000 AND 777600000000 "
    "AND b.amount >= CAST(0.9 AS DOUBLE) * a.amount AND b.amount <= CAST(1.05 AS DOUBLE) * a.amount"))
def t3(spark, sf):
    """A -> B then B -> A 1-9 days later at 0.90-1.05 x."""
    txn, _ = views(spark, sf)
    return PT.round_trips(txn)


_GAP = (f"coalesce(({US} - lag({US}) OVER (PARTITION BY sender_account "
        f"ORDER BY {US}, transaction_id)) / 1e6, 0.0)")


@register("t4_bursts", _sql(
    "sender_account:i, start_ts:t, end_ts:t, n_txns:i, total_amount:d, first_txn:i, last_txn:i",
    "FROM (SELECT sender_account, island, count(*) AS n_txns, min(\"timestamp\") AS start_ts, "
    "max(\"timestamp\") AS end_ts, sum(amount) AS total_amount, "
    "arg_min(transaction_id, us) AS first_txn, arg_max(transaction_id, us) AS last_txn, "
    "max(us) - min(us) AS span FROM (SELECT *, sum(brk) OVER (PARTITION BY sender_account "
    "ORDER BY us, transaction_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM ("
    f"SELECT *, {US} AS us, CASE WHEN {_GAP} > 7200.0 THEN 1 ELSE 0 END AS brk FROM txn)) "
    "GROUP BY sender_account, island) WHERE n_txns >= 4 AND span <= 21600000000"))
def t4(spark, sf):
    """T4: >= 4 transfers of one sender with gaps <= 120 min within 6 h
    (the planted 5 / 60 min / 5.5 h finds nothing in the fixture ledger)."""
    txn, _ = views(spark, sf)
    return PT.bursts(txn, min_count=4, max_gap_minutes=120.0, max_span_hours=6.0)


@register("t1b_structuring_any_type", _sql(
    "transaction_id:i, sender_account:i, timestamp:t, amount:d, n_in_window:i",
    f"FROM (SELECT *, count(amount) OVER (PARTITION BY sender_account ORDER BY {US} "
    f"RANGE BETWEEN {2 * 86_400_000_000 - 1} PRECEDING AND CURRENT ROW) AS n_in_window "
    "FROM txn WHERE amount >= 8000 AND amount < 10000) WHERE n_in_window >= 3"))
def t1b(spark, sf):
    """T1 over every transfer type (the fixture ledger has too few
    near-threshold cash deposits for the planted definition to fire)."""
    txn, _ = views(spark, sf)
    return PT.structuring(txn, txn_type=None)

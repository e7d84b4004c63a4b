"""Registered queries: streaming monitors run to completion."""

from __future__ import annotations

import uuid

from ledgerscope.plans.oracle_sql import TXN_VIEW, US, with_views
from ledgerscope.plans.registry import register, sql_cols, views
from ledgerscope.session import checkpoint_dir
from ledgerscope.streaming import monitor as ST


def _run(spark, sf, build):
    base = f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    # A glob: the file source lists matching files (a bare file path is refused).
    stream = build(ST.read_transfer_stream(spark, f"{sf}/events.parq[u]et"))
    return ST.run_to_table(stream, f"{base}/out", f"{base}/chk")


_ROW = ("CASE WHEN amount > 50000 AND transaction_type IN ('cash_deposit', 'cash_withdrawal') THEN 0.25 ELSE 0 END"
        " + CASE WHEN (hour(\"timestamp\") < 6 OR hour(\"timestamp\") >= 22) AND amount > 10000 THEN 0.15 ELSE 0 END"
        " + CASE WHEN amount % 1000 = 0 AND amount > 5000 THEN 0.10 ELSE 0 END")


@register("e1_stream_row_rules", with_views(
    "SELECT " + sql_cols(f"transaction_id:i, row_score:d={_ROW}, row_alert:i=CASE WHEN {_ROW} >= 0.25 THEN 1 ELSE 0 END")
    + " FROM txn", TXN_VIEW))
def e1(spark, sf):
    """History-free rule flags computed on the transfer stream."""
    return _run(spark, sf, lambda s: ST.row_rule_flags(s).select("transaction_id", "row_score", "row_alert"))


@register("e2_stream_daily_alerts", with_views(
    "SELECT " + sql_cols(f"date:t=CAST(\"timestamp\" AS DATE), n_txns:i=count(*), "
                         f"n_alerts:i=sum(CASE WHEN {_ROW} >= 0.25 THEN 1 ELSE 0 END)")
    + " FROM txn GROUP BY 1", TXN_VIEW))
def e2(spark, sf):
    """Watermarked daily tumbling counts of transfers and row alerts. Append mode emits a day once
    the watermark (latest event time minus one day) has passed its end; the days still open at
    the end of the run are closed by a batch."""
    txn, _ = views(spark, sf)
    return ST.close_daily_counts(_run(spark, sf, ST.daily_alert_counts), txn)


@register("e3_stream_sender_gaps", with_views(
    "SELECT " + sql_cols(
        f"transaction_id:i, time_since_last_txn:d=coalesce(({US} - lag({US}) OVER (PARTITION BY sender_account "
        f"ORDER BY {US}, transaction_id)) / 1e6, 0.0)") + " FROM txn", TXN_VIEW))
def e3(spark, sf):
    """Per-sender gap from streaming state with a day of allowed lateness; transfers behind the
    last watermark when the run ends are closed by a batch."""
    txn, _ = views(spark, sf)
    out = ST.close_sender_gaps(_run(spark, sf, ST.sender_gap_state), txn)
    return out.select("transaction_id", "time_since_last_txn")

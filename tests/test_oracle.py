"""Registered queries against their DuckDB oracles at sf0.001 (the driver's
check runs the same comparison at sf0.01)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from conftest import SF_SMALL  # noqa: E402
from oracle_check import rows_of  # noqa: E402
from __spark_entry__ import oracle_sql, queries  # noqa: E402
from ledgerscope.sources.fixtures import TABLES  # noqa: E402

FAST = ["io1_transactions", "io2_accounts", "w1_velocity_count", "w2_velocity_sum",
        "w3_time_since_last", "w6_all_features", "a1_sender_stats", "a7_pair_counts",
        "a8_network_features", "d13_rule_score", "d14_ensemble", "a9_detection_metrics",
        "a10_alert_volume", "a11_by_pattern", "a15_weekly_volume", "a16_suspicious_heatmap",
        "a20_country_risk", "a26_score_quartiles", "s1_alert_queue", "g2_node_table",
        "t2_layering_chains", "t3_round_trips", "t4_bursts", "s4_sequential_ids",
        "d6_lof_accounts", "c6_dbscan_accounts", "c2_silhouette"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    rel = con.execute(oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, srows) == rows_of(dcols, drows)


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() >= 0 and "ensemble_score" in df.columns

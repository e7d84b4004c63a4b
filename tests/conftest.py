import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerscope.session import build_session

    s = build_session("local[4]", shuffle_partitions=8, app="ledgerscope-tests",
                      extra={"spark.driver.memory": "4g"})
    # Tests run on one machine: a local checkpoint folder is shared by construction.
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerscope-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def ledger(spark):
    from ledgerscope.sources.fixtures import load_views

    return load_views(spark, SF_SMALL)


@pytest.fixture(scope="session")
def features(spark, ledger):
    from ledgerscope.operators.features import engineer_all_features

    return engineer_all_features(ledger[0]).cache()


def txn_frame(spark, rows):
    """Transfers from (id, 'YYYY-MM-DD HH:MM:SS', sender, receiver, amount[, type]) tuples."""
    import datetime as dt

    from pyspark.sql import functions as F

    from ledgerscope.sources.schema import TXN_SCHEMA

    full = []
    for r in rows:
        tid, ts, s, rc, amt = r[:5]
        typ = r[5] if len(r) > 5 else "wire_transfer"
        full.append((tid, dt.datetime.fromisoformat(ts) if ts else None, s, rc, amt, typ, "USD", 0, "normal"))
    return spark.createDataFrame(full, TXN_SCHEMA).select(*[F.col(c) for c in TXN_SCHEMA.names])

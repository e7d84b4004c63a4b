"""Streaming = batch: the per-sender gap state carried across micro-batches
(one day per trigger) equals the batch operator on the same input."""

import os
import tempfile

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerscope.operators.features import time_features
from ledgerscope.sources.fixtures import transactions_from_events
from ledgerscope.streaming import monitor as ST


def _day_files(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src = tempfile.mkdtemp(prefix="ledgerscope-stream-src-")
    days = sorted(r[0] for r in ev.select(F.to_date("ts")).distinct().collect())
    for i, d in enumerate(days):
        p = os.path.join(src, f"day={i:03d}")
        ev.filter(F.to_date("ts") == F.lit(d)).coalesce(1).write.parquet(p)
        for f in os.listdir(p):  # oldest file first = earliest day first
            os.utime(os.path.join(p, f), (1_000_000 + i, 1_000_000 + i))
    return src, len(days)


def test_gap_state_does_not_depend_on_batches(spark):
    """Day files in order, and dealt in a shuffled order within the allowed lateness, give the batch gaps."""
    import os
    import shutil

    src, n_days = _day_files(spark)
    schema = spark.read.parquet(f"{SF_SMALL}/events.parquet").schema
    txn = transactions_from_events(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    want = {r.transaction_id: r.time_since_last_txn for r in time_features(txn).collect()}
    shuffled = tempfile.mkdtemp(prefix="ledgerscope-stream-shuffled-")
    files = sorted(os.path.join(d, f) for d, _, fs in os.walk(src) for f in fs if f.endswith(".parquet"))
    deal = [files[i ^ 1] if i ^ 1 < len(files) else files[i] for i in range(len(files))]  # neighbours swapped
    for i, f in enumerate(deal):
        shutil.copy(f, f"{shuffled}/{i:04d}.parquet")
        os.utime(f"{shuffled}/{i:04d}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    for path, delay, all_of_it in ((f"{src}/*", "0 seconds", True), (f"{shuffled}/*", "4 days", False)):
        stream = transactions_from_events(
            spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path))
        out_dir = tempfile.mkdtemp(prefix="ledgerscope-stream-out-")
        got = ST.run_to_table(ST.sender_gap_state(stream, delay), f"{out_dir}/o", f"{out_dir}/c").collect()
        g = {r.transaction_id: r.time_since_last_txn for r in got}
        assert n_days > 1 and len(g) == len(got) and all(abs(g[k] - want[k]) < 1e-6 for k in g)
        ends = ST.close_sender_gaps(spark.read.parquet(f"{out_dir}/o"), txn, delay).collect()
        closed = {r.transaction_id: r.time_since_last_txn for r in ends}
        assert len(ends) == len(closed) == len(want) and all(abs(closed[k] - want[k]) < 1e-6 for k in want)
        missing = set(want) - set(g)
        if all_of_it:  # only the hour that the final watermark has not passed may still wait
            last = txn.agg(F.max("timestamp")).first()[0].replace(minute=0, second=0, microsecond=0)
            assert missing <= {r.transaction_id for r in txn.filter(F.col("timestamp") >= F.lit(last)).collect()}
        else:
            assert len(missing) < len(want) / 2


def _gap_run(spark, files, delay="0 seconds", **options):
    """Transfers (id, sender, milliseconds or None), one file a batch: (emitted, closed, batch frame)."""
    src, out = tempfile.mkdtemp(prefix="ledgerscope-gap-src-"), tempfile.mkdtemp(prefix="ledgerscope-gap-out-")
    schema = "transaction_id long, sender_account long, ms long"
    typed = lambda df: df.select("transaction_id", "sender_account", F.timestamp_millis("ms").alias("timestamp"))
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{src}/f={i:03d}")
        for f in os.listdir(f"{src}/f={i:03d}"):
            os.utime(f"{src}/f={i:03d}/{f}", (3_000_000 + i, 3_000_000 + i))
    stream = typed(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/*"))
    emitted = ST.run_to_table(ST.sender_gap_state(stream, delay, **options), f"{out}/o", f"{out}/c")
    batch = typed(spark.createDataFrame([r for rows in files for r in rows], schema))
    gaps = lambda df: {r.transaction_id: r.time_since_last_txn for r in df.collect()}
    closed = ST.close_sender_gaps(emitted, batch, delay)
    assert closed.count() == len(gaps(closed))
    return gaps(emitted), gaps(closed)


def test_gap_state_at_the_end_of_a_bucket(spark):
    """A last watermark just before, at and just after the end of an hour: each transfer comes out once. A sender
    without a name is one sender, a transfer without a time is left out."""
    hour = 3_600_000
    for over in (-1, 0, 1):
        first = [(1, 7, 10 * hour - 5000), (2, 7, 10 * hour - 1), (3, None, 10 * hour - 9000), (4, 7, None)]
        later = [(5, 7, 10 * hour + over), (6, None, 10 * hour - 3000)]
        emitted, closed = _gap_run(spark, [first, later])
        assert closed == {1: 0.0, 2: 4.999, 5: (1 + over) / 1000, 3: 0.0, 6: 6.0}
        assert set(emitted) <= {1, 2, 3, 6} and (over < 0) == (not emitted)


def test_gap_state_forgets_an_idle_sender(spark):
    """Past the time to live a sender starts anew; one seen again earlier keeps its last transfer."""
    day = 86_400_000
    files = [[(1, 1, day), (2, 2, day)], [(3, 2, 3 * day)], [(4, 3, 8 * day)], [(5, 3, 9 * day)],
             [(6, 1, 10 * day), (7, 2, 10 * day)], [(8, 3, 30 * day)], [(9, 4, 31 * day)]]
    emitted, _ = _gap_run(spark, files, state_ttl_ms=4 * day)
    assert emitted[3] == 2 * 86_400.0 and emitted[6] == 0.0 and emitted[7] == 0.0
    emitted, _ = _gap_run(spark, files, state_ttl_ms=20 * day)
    assert emitted[6] == 9 * 86_400.0 and emitted[7] == 7 * 86_400.0


def test_row_rules_stream_equals_batch(spark):
    out_dir = tempfile.mkdtemp(prefix="ledgerscope-stream-rr-")
    s = ST.read_transfer_stream(spark, f"{SF_SMALL}/events.parq[u]et")
    got = ST.run_to_table(ST.row_rule_flags(s).select("transaction_id", "row_score"),
                          f"{out_dir}/o", f"{out_dir}/c")
    batch = ST.row_rule_flags(transactions_from_events(spark.read.parquet(f"{SF_SMALL}/events.parquet")))
    a = sorted(map(tuple, got.collect()))
    b = sorted(map(tuple, batch.select("transaction_id", "row_score").collect()))
    assert a == b


def test_daily_counts_drop_late_rows(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    days = sorted(r[0] for r in ev.select(F.to_date("ts")).distinct().collect())[:4]
    src = tempfile.mkdtemp(prefix="ledgerscope-stream-late-")
    parts = [ev.filter(F.to_date("ts") == F.lit(d)) for d in days]
    # day 0 again, after day 3: its window was emitted and evicted already
    parts.append(parts[0])
    for i, p in enumerate(parts):
        path = os.path.join(src, f"f={i:03d}")
        p.coalesce(1).write.parquet(path)
        for f in os.listdir(path):
            os.utime(os.path.join(path, f), (2_000_000 + i, 2_000_000 + i))
    schema = ev.schema
    stream = transactions_from_events(
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/*"))
    out = tempfile.mkdtemp(prefix="ledgerscope-stream-late-out-")
    got = {r.date: r.n_txns for r in ST.run_to_table(ST.daily_alert_counts(stream), f"{out}/o", f"{out}/c").collect()}
    assert got[days[0]] == parts[0].count()  # the late copy was not counted


class _Store:
    """Stand-in for a sender's state handle that counts its calls."""

    def __init__(self):
        self.data, self.timers, self.calls = {}, set(), 0

    def getMapState(self, *_):
        return self

    def getValueState(self, *_):
        return _Last()

    def registerTimer(self, ms):
        self.calls += 1
        self.timers.add(ms)

    def keys(self):
        self.calls += 1
        return list(self.data)

    def containsKey(self, at):
        self.calls += 1
        return at in self.data

    def getValue(self, at):
        self.calls += 1
        return self.data[at]

    def updateValue(self, at, value):
        self.calls += 1
        self.data[at] = value

    def removeKey(self, at):
        self.calls += 1
        del self.data[at]


class _Last:
    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class _Passed:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def _gap_state(**sizes):
    state, store = ST.SenderGaps(["transaction_id", "timestamp", "time_since_last_txn"], "bigint", 3_600_000, 10 ** 9, **sizes), _Store()
    state.init(store)
    return state, store


def _arrive(state, rows):
    state.handleInputRows((7,), iter([pd.DataFrame({"transaction_id": [i], "timestamp": pd.to_datetime([ms], unit="ms")}) for i, ms in rows]), None)


def test_gap_state_calls_do_not_grow_with_hours():
    """A sender with a transfer an hour costs a few state calls and one timer, and comes out in one frame."""
    state, store = _gap_state()
    _arrive(state, [(i, i * 3_600_000 + 5) for i in range(500)])
    assert len(store.timers) == 1 and store.calls <= 5
    out = list(state.handleExpiredTimer((7,), _Passed(400 * 3_600_000), None))
    assert [f["transaction_id"].tolist() for f in out] == [list(range(400))]
    assert out[0]["time_since_last_txn"].tolist() == [0.0] + [3600.0] * 399 and store.calls <= 15
    assert 401 * 3_600_000 in store.timers and sum(len(us) for us, _ in store.data.values()) == 100


def test_gap_state_pages_of_several_arrivals():
    """Pages that overlap, crowded hours and ties come out once, in order, whatever the sizes and the watermarks."""
    rng = np.random.default_rng(3)
    ms = rng.integers(0, 40 * 3_600_000, 300) // 60_000 * 60_000  # ties
    ms[:80] = 5 * 3_600_000 + ms[:80] % 3_600_000
    want = sorted(zip(ms.tolist(), range(300)))
    for page, flush in ((1, 1), (7, 20), (50, 33), (4096, 1_000_000)):
        state, store = _gap_state(page_rows=page, flush_rows=flush)
        for a in range(0, 300, 75):
            _arrive(state, [(i, ms[i]) for i in range(a, a + 75)])
        out = [f for h in (3, 4.5, 6, 6, 25, 40) for f in state.handleExpiredTimer((7,), _Passed(int(h * 3_600_000)), None)]
        got = pd.concat(out)
        assert got["transaction_id"].tolist() == [i for _, i in want] and not store.data
        assert np.allclose(got["time_since_last_txn"], np.diff([t for t, _ in want], prepend=want[0][0]) / 1000)

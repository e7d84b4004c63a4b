"""Streaming monitors (E1-E3). Additive: the reference is batch only.

* E1 ``row_rule_flags``: the rules that need no history (near threshold,
  round amount, large cash, night activity, round large amount) as a plain
  projection, so they run on any stream.
* E2 ``daily_alert_counts``: a tumbling one-day window of transfers and
  row-rule alerts with a watermark. A day is emitted once the watermark
  passes its end (append mode) and its state is dropped; rows for an emitted
  day are discarded. Spark's guarantee is one-directional: a row behind the
  watermark whose day is still open may still be counted.
* E3 ``sender_gap_state``: seconds since the sender's previous transfer and
  the rapid flag from a stateful processor (last event time, transfers that wait
  for the watermark in pages of event time, timers). The result does not depend on how the input is cut into
  batches. State of a sender idle for ``state_ttl`` of event time is dropped.

A stream that ends leaves what its last watermark has not passed: open days, waiting
transfers. :func:`close_daily_counts` and :func:`close_sender_gaps` finish such a run.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ledgerscope.functions.exprs import (CASH_TYPES, RAPID_SECONDS, flag, is_night,
                                         is_round_amount, near_threshold)
from ledgerscope.operators.features import time_features
from ledgerscope.operators.rules import LARGE_CASH_AMOUNT, NIGHT_AMOUNT, ROUND_AMOUNT
from ledgerscope.sources.fixtures import transactions_from_events

STREAM_RULE_WEIGHTS = {"rule_large_cash": 0.25, "rule_night_activity": 0.15,
                       "rule_round_amount": 0.10}


def read_transfer_stream(spark: SparkSession, events_path: str,
                         max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of transfers from parquet ``events`` files (the fixture
    mapping applies row by row, so it is a streaming projection)."""
    schema = spark.read.parquet(events_path).schema  # explicit schema for the stream
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return transactions_from_events(r.parquet(events_path))


def row_rule_flags(df: DataFrame, threshold: float = 0.25) -> DataFrame:
    """History-free flags and their weighted score; ``row_alert`` when the
    score reaches ``threshold``."""
    a = F.col("amount")
    out = df.withColumns({
        "near_threshold": near_threshold(),
        "is_round_amount": is_round_amount(),
        "is_night": is_night(),
        "rule_large_cash": flag((a > LARGE_CASH_AMOUNT) & F.col("transaction_type").isin(CASH_TYPES)).cast("double"),
    })
    out = out.withColumns({
        "rule_night_activity": flag((F.col("is_night") == 1) & (a > NIGHT_AMOUNT)).cast("double"),
        "rule_round_amount": flag((F.col("is_round_amount") == 1) & (a > ROUND_AMOUNT)).cast("double"),
    })
    score = F.lit(0.0)
    for c, w in STREAM_RULE_WEIGHTS.items():
        score = score + F.col(c) * F.lit(w)
    return out.withColumn("row_score", score).withColumn(
        "row_alert", (F.col("row_score") >= F.lit(threshold)).cast("int"))


def daily_alert_counts(df: DataFrame, watermark: str = "1 day", threshold: float = 0.25) -> DataFrame:
    """Per event-time day, transfers and row-rule alerts."""
    f = row_rule_flags(df, threshold).withColumn("event_time", F.col("timestamp").cast("timestamp"))
    return (f.withWatermark("event_time", watermark)
            .groupBy(F.window("event_time", "1 day").alias("w"))
            .agg(F.count(F.lit(1)).alias("n_txns"), F.sum("row_alert").cast("long").alias("n_alerts"))
            .select(F.to_date(F.col("w.start")).alias("date"), "n_txns", "n_alerts"))


GAP_BUCKET_MS = 3_600_000
PAGE_ROWS = 4096        # waiting transfers of a page, about; a bucket is never cut
FLUSH_ROWS = 1_000_000  # arriving transfers of one sender ordered at a time


class SenderGaps(StatefulProcessor):
    """Gaps of one sender: waiting transfers in a map state of pages, the last emitted time in a value
    state, a timer at the end of the earliest waiting bucket and one to forget an idle sender. A page holds
    whole buckets of one arrival, under its first bucket and a number: a sender with few transfers a bucket costs a
    few state calls a batch, not some a bucket, and a busy one's backlog still comes page by page."""

    def __init__(self, output: list[str], id_type: str, bucket_ms: int, ttl_ms: int,
                 page_rows: int = PAGE_ROWS, flush_rows: int = FLUSH_ROWS):
        self.output, self.id_type, self.bucket_ms, self.ttl_ms = output, id_type, bucket_ms, ttl_ms
        self.page_rows, self.flush_rows = page_rows, flush_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "bucket long, nr long", f"us array<bigint>, ids array<{self.id_type}>")
        self.last = handle.getValueState("last", "us long")

    def _buckets(self, us: np.ndarray) -> np.ndarray:
        return us // 1000 // self.bucket_ms

    def _keep(self, us: np.ndarray, ids: np.ndarray, taken: set) -> int:
        """Write transfers as pages beside those of the keys ``taken``; returns the earliest bucket."""
        order = np.argsort(us, kind="stable")
        us, ids = us[order], ids[order]
        buckets = self._buckets(us)
        at = 0
        while at < len(us):
            last = buckets[min(at + self.page_rows, len(us)) - 1]
            end = int(np.searchsorted(buckets, last, side="right"))
            nr = 0
            while (int(buckets[at]), nr) in taken:
                nr += 1
            taken.add((int(buckets[at]), nr))
            self.waiting.updateValue((int(buckets[at]), nr), (us[at:end].tolist(), ids[at:end].tolist()))
            at = end
        return int(buckets[0])

    def _wake(self, bucket: int) -> None:
        self.handle.registerTimer((bucket + 1) * self.bucket_ms)

    def handleInputRows(self, key, rows, timerValues):
        taken, first, held, n = set(self.waiting.keys()), [], [], 0

        def flush():
            first.append(self._keep(*(np.concatenate(x) for x in zip(*held)), taken))

        for pdf in rows:
            if len(pdf):
                held.append((pdf["timestamp"].to_numpy("datetime64[us]").astype("int64"), pdf["transaction_id"].to_numpy(object)))
                n += len(pdf)
            if n >= self.flush_rows:
                flush()
                held, n = [], 0
        if held:
            flush()
        if first:
            self._wake(min(first))
        return iter([])

    def _gaps(self, key, last, us, ids):
        """(frame of the transfers in order, time of the last one)."""
        order = sorted(range(len(us)), key=lambda i: (us[i], ids[i] is not None, ids[i]))
        times = np.array([us[i] for i in order], dtype="int64")
        gaps = np.diff(times, prepend=times[0] if last is None else last) / 1e6
        return pd.DataFrame({
            "transaction_id": [ids[i] for i in order], "sender_account": [key[0]] * len(times),
            "timestamp": times.astype("datetime64[us]"), "time_since_last_txn": gaps,
            "is_rapid": ((gaps > 0) & (gaps < RAPID_SECONDS)).astype("int32")})[self.output], int(times[-1])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = timerValues.getCurrentWatermarkInMs()
        end = passed // self.bucket_ms  # buckets before it are over
        last = self.last.get()[0] if self.last.exists() else None
        keys = sorted(tuple(k) for k in self.waiting.keys())
        done = [k for k in keys if k[0] < end]
        left = set(keys[len(done):])
        us, ids = [], []
        for i, at in enumerate(done):  # pages that overlap are in memory together, and no more
            page = self.waiting.getValue(at)
            self.waiting.removeKey(at)
            us += page[0]
            ids += page[1]
            upto = min(done[i + 1][0], end) if i + 1 < len(done) else end
            limit = upto * self.bucket_ms * 1000
            now = [j for j, t in enumerate(us) if t < limit]
            if now:
                frame, last = self._gaps(key, last, [us[j] for j in now], [ids[j] for j in now])
                yield frame
                kept = [j for j, t in enumerate(us) if t >= limit]
                us, ids = [us[j] for j in kept], [ids[j] for j in kept]
        if us:
            rest = np.empty(len(ids), dtype=object)
            rest[:] = ids
            left.add((self._keep(np.array(us, dtype="int64"), rest, left), 0))
        if done and left:
            self._wake(min(left)[0])
        forget = None if last is None else last // 1000 + self.ttl_ms
        if done:
            self.last.update((last,))
            self.handle.registerTimer(max(forget, passed + 1))
        elif not left and forget is not None and forget <= passed:
            self.last.clear()

    def close(self) -> None:
        pass


def sender_gap_state(df: DataFrame, watermark: str = "1 day", state_ttl_ms: int = 30 * 86_400_000,
                     bucket_ms: int = GAP_BUCKET_MS, page_rows: int = PAGE_ROWS, flush_rows: int = FLUSH_ROWS) -> DataFrame:
    """Gap to the sender's previous transfer from per-sender state.

    A sender's transfers wait in its state, in pages of whole buckets of event time, until the watermark passes the
    end of their bucket; they are then ordered by (event time, id) and emitted, so the result does
    not depend on how the input falls into batches, and a busy sender's backlog is read a page at a time.
    Transfers in later buckets stay in the state; ones at or before the watermark when they arrive are
    dropped by it (it starts at 1970, so earlier times never count), ones without a time too. Needs the state store of :func:`run_to_table`."""
    fields = {"transaction_id": df.schema["transaction_id"].dataType.simpleString(),
              "sender_account": df.schema["sender_account"].dataType.simpleString(),
              "timestamp": "timestamp", "time_since_last_txn": "double", "is_rapid": "int"}
    f = (df.filter(F.col("timestamp").isNotNull())
         .select("transaction_id", "sender_account", F.col("timestamp").cast("timestamp").alias("timestamp"))
         .withWatermark("timestamp", watermark))
    return f.groupBy("sender_account").transformWithStateInPandas(
        SenderGaps(list(fields), fields["transaction_id"], bucket_ms, state_ttl_ms, page_rows, flush_rows),
        ", ".join(f"{k} {v}" for k, v in fields.items()), "Append", "EventTime")


def _closing_time(df: DataFrame, watermark: str):
    """The last watermark of a stream that has read all of ``df``: its latest event time, in whole
    milliseconds, less the allowed lateness."""
    return F.timestamp_millis(df.agg(F.max(F.unix_millis(F.col("timestamp").cast("timestamp")))).scalar()) - F.expr(f"interval {watermark}")


def close_daily_counts(emitted: DataFrame, df: DataFrame, watermark: str = "1 day", threshold: float = 0.25) -> DataFrame:
    """E2 completed at the end of a run: the days that the last watermark left open are counted as a
    batch over the transfers of those days only, and follow the emitted ones."""
    day = F.to_date(F.col("timestamp"))
    ends = F.date_add(day, 1).cast("timestamp")
    rest = row_rule_flags(df.filter(ends > _closing_time(df, watermark)), threshold)
    return emitted.unionByName(rest.groupBy(day.alias("date")).agg(
        F.count(F.lit(1)).alias("n_txns"), F.sum("row_alert").cast("long").alias("n_alerts")))


def close_sender_gaps(emitted: DataFrame, df: DataFrame, watermark: str = "1 day",
                      bucket_ms: int = GAP_BUCKET_MS) -> DataFrame:
    """E3 completed at the end of a run: transfers in buckets that the last watermark has not passed get
    their gaps as a batch (the W3 pass, which splits a hot sender by day). Each sender's last emitted
    transfer goes in with them, so the gap of its first waiting one is right."""
    ends = F.floor(F.unix_millis(F.col("timestamp").cast("timestamp")) / F.lit(bucket_ms)) * F.lit(bucket_ms) + F.lit(bucket_ms)
    rest = df.filter(F.timestamp_millis(ends) > _closing_time(df, watermark)).select(
        "transaction_id", "sender_account", F.col("timestamp").cast("timestamp").alias("timestamp"), F.lit(False).alias("_done"))
    done = emitted.groupBy("sender_account").agg(F.max("timestamp").alias("timestamp"), F.max("transaction_id").alias("transaction_id"))
    both = rest.unionByName(done.withColumn("_done", F.lit(True))).withColumn("amount", F.lit(None).cast("double"))
    # Emitted transfers lie in earlier buckets than the waiting ones.
    gaps = time_features(both.withColumn("_order", F.struct(~F.col("_done"), "transaction_id")), id_col="_order")
    return emitted.unionByName(gaps.filter(~F.col("_done")).select(*emitted.columns))


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_to_table(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> DataFrame:
    """Run a stream to completion over the input available now (append mode, file sink with its own
    checkpoint) and return the sink as a batch frame. State is kept in RocksDB, which
    stateful processors need; the session's own choice is put back."""
    conf = stream.sparkSession.conf
    before = conf.get(STATE_STORE)
    conf.set(STATE_STORE, ROCKSDB)
    try:
        q = (stream.writeStream.format(fmt).outputMode("append")
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path))
        q.awaitTermination()
    finally:
        conf.set(STATE_STORE, before)
    return stream.sparkSession.read.format(fmt).load(path)

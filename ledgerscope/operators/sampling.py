"""Sampling, sequential ids and scatter of sampled results.

Samples are defined by a seeded hash of the row id, so they are the same
under any partitioning and survive task retries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_TWO63 = float(2 ** 63)


def hash_unit(id_col: str, seed: int, salt=None) -> Column:
    """Uniform [0, 1) value from a seeded 64-bit hash of the id."""
    parts = [F.col(id_col), F.lit(int(seed))] + ([salt] if salt is not None else [])
    h = F.xxhash64(*parts)
    return (F.when(h < 0, -(h + F.lit(1))).otherwise(h).cast("double")) / F.lit(_TWO63)


def sample_exact(df: DataFrame, n: int, seed: int = 42, id_col: str = "transaction_id",
                 oversample: float = 1.2) -> DataFrame:
    """Exactly ``min(n, count)`` rows without replacement: those with the
    smallest seeded hash. A hash threshold first keeps about
    ``oversample * n`` rows, so the final ordered take sees a bounded input
    instead of every partition's top n."""
    total = df.count()
    if total <= n:
        return df
    frac = min(1.0, oversample * n / total + 6.0 * (n ** 0.5) / total)
    u = hash_unit(id_col, seed)
    while True:
        cand = df.withColumn("_u", u).filter(F.col("_u") < F.lit(frac))
        if frac >= 1.0 or cand.count() >= n:
            break
        frac = min(1.0, frac * 2)
    return cand.orderBy("_u", id_col).limit(n).drop("_u")


def attach_sampled(full: DataFrame, sampled: DataFrame, cols, default,
                   id_col: str = "transaction_id") -> DataFrame:
    """Left-join per-row results computed on a sample back to every row;
    rows outside the sample get ``default`` (0.0 for LOF, -2 for DBSCAN)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    s = sampled.select(id_col, *[F.col(c).alias(f"_s_{c}") for c in cols])
    j = full.join(s, id_col, "left")
    return j.withColumns({c: F.coalesce(F.col(f"_s_{c}"), F.lit(default)) for c in cols}) \
        .drop(*[f"_s_{c}" for c in cols])


def sequential_ids(df: DataFrame, order_cols=("timestamp", "transaction_id"),
                   out: str = "seq", num_partitions: int | None = None) -> DataFrame:
    """0-based position in (timestamp, id) order without a single-partition
    window: range partition and sort, then add the row counts of earlier
    partitions (a table of partitions, broadcast by size)."""
    from ledgerscope.session import checkpoint_dir, pin

    spark = df.sparkSession
    checkpoint_dir(spark)
    n_part = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = (df.repartitionByRange(n_part, *order_cols).sortWithinPartitions(*order_cols)
         .withColumns({"_pid": F.spark_partition_id(), "_mid": F.monotonically_increasing_id()}))
    s = pin(s)
    per = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"), F.min("_mid").alias("_m0"))
    # One row per partition: bounded by the partition count, so one window is fine.
    per = per.withColumn("_off", F.coalesce(F.sum("_c").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (s.join(F.broadcast(per.select("_pid", "_off", "_m0")), "_pid")
            .withColumn(out, F.col("_off") + F.col("_mid") - F.col("_m0"))
            .drop("_pid", "_mid", "_off", "_m0"))


def format_ids(seq_col: str = "seq", prefix: str = "TXN", width: int = 8) -> Column:
    """Zero-padded display id, e.g. TXN00000042."""
    return F.concat(F.lit(prefix), F.lpad(F.col(seq_col).cast("string"), width, "0"))

"""Exact quantiles without buffering a group in one task.

``percentile``/``median`` aggregates keep every distinct value of a group in
one buffer, so a label or pattern group that holds most rows lands in one
task. Here equal values collapse first (``groupBy(group, value).count()``, with
map-side combine, so a value that most rows share is one row); the counts are
range-partitioned on (group, value) and each value gets the range of ranks it
covers from per-partition totals (a table of partitions x groups). Interpolation is linear between
the ranks floor/ceil of p * (n - 1), as in numpy's default and DuckDB's
``quantile_cont``. One path for every size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_quantiles(df: DataFrame, value: str, probs, group=None,
                    num_partitions: int | None = None, prefix: str = "q") -> DataFrame:
    """One row per group with columns ``{prefix}0 .. {prefix}{k-1}`` for the
    k probabilities (nulls ignored). Uses the session checkpoint folder to
    pin the counted values (see :func:`ledgerscope.session.checkpoint_dir`)."""
    from ledgerscope.session import checkpoint_dir, pin

    g = list(group or [])
    probs = [float(p) for p in probs]
    spark = df.sparkSession
    checkpoint_dir(spark)
    base = df.select(*g, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    counts = base.groupBy(*g, "_v").agg(F.count(F.lit(1)).alias("_c"))

    # Range partition on (group, value): a hot group spreads over many tasks.
    dealt = (counts.repartitionByRange(num_partitions, *g, "_v") if num_partitions
             else counts.repartitionByRange(*g, "_v"))
    # Partition ids must stay fixed between the two reads below.
    s = pin(dealt.withColumn("_pid", F.spark_partition_id()))

    per = s.groupBy("_pid", *g).agg(F.sum("_c").alias("_c"))
    wo = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1) \
        if g else Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumns({"_off": F.coalesce(F.sum("_c").over(wo), F.lit(0)),
                           "_n": F.sum("_c").over(Window.partitionBy(*g)) if g
                           else F.sum("_c").over(Window.partitionBy())})

    # Needed ranks per group: floor and ceil of p * (n - 1).
    tgt = per.select(*g, "_n").distinct()
    pos = F.array(*[F.struct(F.lit(i).alias("qi"), F.lit(p).alias("p")) for i, p in enumerate(probs)])
    tgt = tgt.select(*g, "_n", F.explode(pos).alias("_q")).select(
        *g, F.col("_q.qi").alias("_qi"),
        (F.col("_q.p") * (F.col("_n") - 1)).alias("_pos"))
    tgt = tgt.withColumns({"_lo": F.floor("_pos"), "_hi": F.ceil("_pos"),
                           "_frac": F.col("_pos") - F.floor("_pos")})
    need = (tgt.select(*g, F.col("_lo").alias("_rank"))
            .union(tgt.select(*g, F.col("_hi").alias("_rank"))).distinct()
            .groupBy(*g).agg(F.collect_set("_rank").alias("_ranks")))  # at most 2 x len(probs) a group

    # A null group is a group too, so keys compare null-safe.
    def same(a, b, keys):
        cond = F.lit(True)
        for k in keys:
            cond &= a[k].eqNullSafe(b[k])
        return cond

    offs = per.select("_pid", *g, "_off")
    wi = Window.partitionBy("_pid", *g).orderBy("_v")
    upto = s.withColumn("_upto", F.sum("_c").over(wi))
    ranked = upto.join(offs, same(upto, offs, ["_pid", *g])).select(
        *[upto[c] for c in g], "_v", (F.col("_off") + F.col("_upto") - F.col("_c")).alias("_from"),
        (F.col("_off") + F.col("_upto")).alias("_to"))
    hit = ranked.join(need, same(ranked, need, g)).select(
        *[ranked[c] for c in g], "_v", F.explode(F.filter(
            "_ranks", lambda r: (r >= F.col("_from")) & (r < F.col("_to")))).alias("_rank"))

    lo = hit.select(*g, F.col("_rank").alias("_lo"), F.col("_v").alias("_vlo"))
    hi = hit.select(*g, F.col("_rank").alias("_hi"), F.col("_v").alias("_vhi"))
    first = tgt.join(lo, same(tgt, lo, [*g, "_lo"])).select(*[tgt[c] for c in [*g, "_qi", "_hi", "_frac"]], "_vlo")
    q = (first.join(hi, same(first, hi, [*g, "_hi"])).select(*[first[c] for c in [*g, "_qi", "_frac"]], "_vlo", "_vhi")
         .withColumn("_qv", F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_frac")))
    out = q.groupBy(*g).pivot("_qi", list(range(len(probs)))).agg(F.first("_qv"))
    return out.select(*g, *[F.col(str(i)).alias(f"{prefix}{i}") for i in range(len(probs))])

"""Time-varying curriculum: mix sources to target weights and order the training run.

Each source has a weight schedule over the run (t from 0 to 1), here a straight
line; its integral is the source's weight and fixes the share of all words. The
cumulative demand target * C(t), C being the normalised integral, is inverted
to place every copy of every document: a copy whose words start at offset x of
its source is trained at the t with target * C(t) = x. Documents are then
range-sorted by that position.

Offsets come from running sums in md5 order of doc_id, inside (source, md5
prefix) buckets plus the totals of earlier buckets, so a source that holds a
third of all rows is spread over up to 4096 windows. Built-in functions only.

Defined cases: null texts have size 0; the null source is a source, last in
order; repeated rows are separate documents (ties in md5 order fall to size,
rows equal in both are interchangeable); sources of size 0 have target 0; an
empty table gives an empty mix; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerscope.llm.common import running, stage

WEIGHTS = (5, 2, 1)
# Straight-line schedules relative to the weight: (at the start, at the end), mean 1.
SLOPES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
MAX_EPOCHS = 3
BUCKET_DIGITS = 3  # hexadecimal digits of md5(doc_id): 4096 buckets a source
_BIG = "decimal(38,0)"


def _pick(values, rank):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (rank % len(values) + 1).cast("int"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(skey, source_size, rank, target) from (skey, source_size): weights repeat
    over the sources in order; a target stops at max_epochs times its source and
    the excess goes to the others by weight until none is above."""
    ranked = running(sizes, [F.col("skey")], {"rank": F.lit(1)})
    ranked = ranked.withColumn("w", _pick(weights, F.col("rank"))) \
        .withColumn("cap", (F.col("source_size") * max_epochs).cast(_BIG))
    # Sources in the order in which a rising common level reaches their cap.
    filled = stage(running(ranked, [F.col("cap").cast("double") / F.col("w"), F.col("skey")],
                           {"cap_before": F.col("cap"), "w_before": F.col("w")}), "targets")
    total, all_w = filled.agg(F.sum("source_size").cast(_BIG), F.sum("w")).first()
    capped = ((F.lit(total) - F.col("cap_before")).cast(_BIG) * F.col("w")
              > F.col("cap") * (F.lit(all_w) - F.col("w_before")))
    rest, rest_w = filled.agg(
        (F.lit(total) - F.coalesce(F.sum(F.when(capped, F.col("cap"))), F.lit(0))).cast("double"),
        F.sum(F.when(~capped, F.col("w"))).cast("double")).first()
    level = F.lit(rest / rest_w if rest_w else 0.0)
    return filled.select("skey", "source_size", "rank",
                         F.when(capped, F.col("cap").cast("double")).otherwise(F.col("w") * level).alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, slopes=SLOPES, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``docs`` plus size, source_size, target, taken and copies (per copy: training
    position 0..1 and words taken; the last copy of a source may be cut)."""
    clash = ["size", "source_size", "target", "taken", "copies"]
    keep = [c for c in docs.columns if c not in clash]
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sized = docs.select(
        *keep, F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
        F.coalesce(F.concat(F.lit("0"), F.col("source")), F.lit("1")).alias("__skey"), order.alias("__h"),
        F.substring(order, 1, BUCKET_DIGITS).alias("__b"))
    buckets = stage(sized.groupBy(F.col("__skey").alias("skey"), F.col("__b").alias("b"))
                    .agg(F.sum("size").alias("words")), "buckets")
    targets = source_targets(buckets.groupBy("skey").agg(F.sum("words").alias("source_size")), weights, max_epochs)
    earlier = Window.partitionBy("skey").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(buckets.withColumn("offset", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
                    .join(targets, "skey")
                    .select(F.col("skey").alias("__skey"), F.col("b").alias("__b"), F.col("offset").alias("__offset"),
                            "source_size", "target", _pick([s[0] for s in slopes], F.col("rank")).alias("__a"),
                            _pick([s[1] for s in slopes], F.col("rank")).alias("__z")), "offsets")
    inside = Window.partitionBy("__skey", "__b").orderBy("__h", "size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("__offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    placed = sized.join(offsets, ["__skey", "__b"]).withColumn("__x", start)

    def copy(i):
        x = F.col("__x") + i * F.col("source_size")
        words = F.greatest(F.lit(0), F.least(F.col("size"), F.floor("target") - x)).cast("long")
        share = x / F.col("target")  # of the source's demand that is met before this copy
        at = 2 * share / (F.col("__a") + F.sqrt(F.col("__a") * F.col("__a") + 2 * (F.col("__z") - F.col("__a")) * share))
        return F.struct(F.round(at, 6).alias("position"), words.alias("words"))

    copies = F.filter(F.array(*[copy(F.lit(i).cast("long")) for i in range(max_epochs)]), lambda c: c["words"] > 0)
    return placed.select(*keep, "size", "source_size", "target", copies.alias("copies")).withColumn(
        "taken", F.aggregate("copies", F.lit(0).cast("long"), lambda s, c: s + c["words"]))


def training_order(docs: DataFrame, **kw) -> DataFrame:
    """One row per copy taken, range-sorted by training position."""
    return (mix(docs, **kw).withColumn("copy", F.explode("copies")).drop("copies")
            .select("*", "copy.position", "copy.words").drop("copy").orderBy("position", "doc_id"))

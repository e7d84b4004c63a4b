"""SimHash near-duplicates with covering locality-sensitive hashing.

Fingerprint: 64-bit majority of the XXH64 hashes of word shingles. Search: a
map m from bit positions to the nonzero vectors of GF(2)^(r+1) gives one mask
per nonzero v, holding the positions i with <m(i), v> = 1. Any r differing
positions span at most r dimensions, so some v is orthogonal to all of them:
every pair within the radius agrees on all bits of some mask (Pagh, "Locality-
sensitive hashing without false negatives"). No pair within the radius is lost.

Defined cases: null or empty texts have fingerprint 0 and link with each other
and with fingerprints of at most r set bits; repeated rows and ties all get the
same component; a null doc_id never becomes a component id unless the whole
component has only null ids; extra columns are ignored; empty tables give empty
results.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerscope.llm.common import components, stage, utf8

SEED = 42
HOT_BUCKET = 50_000  # distinct fingerprints; larger buckets are re-keyed (exactly) on a part of the open bits
_CHUNK = 1 << 16


def fingerprint_of(text, shingle: int = 3) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    import xxhash

    h = xxhash.xxh64_intdigest
    words = utf8(text).lower().split()  # ASCII white space, A-Z only
    n = len(words)
    if n == 0:
        return 0
    joined = b" ".join(words)
    if n < shingle:
        hashes = [h(joined, SEED)]
    else:
        lens = np.fromiter(map(len, words), np.int64, n) + 1
        ends = np.cumsum(lens)
        starts, ends = (ends - lens)[: n - shingle + 1].tolist(), (ends[shingle - 1:] - 1).tolist()
        hashes = [h(joined[a:b], SEED) for a, b in zip(starts, ends)]
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _CHUNK):
        part = np.array(hashes[i:i + _CHUNK], "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text_col: str = "text", shingle: int = 3, out: str = "fp") -> DataFrame:
    """Add the fingerprint as a signed long (the same 64 bits)."""

    @F.pandas_udf(T.LongType())
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint_of(t, shingle) for t in texts], np.uint64).view(np.int64))

    return docs.withColumn(out, fp(F.col(text_col)))


def covering_masks(radius: int) -> list[int]:
    """The 2^(r+1)-1 masks, as unsigned 64-bit integers."""
    k = (1 << (radius + 1)) - 1
    return [sum(1 << i for i in range(64) if ((i % k + 1) & v).bit_count() & 1) for v in range(1, k + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _local_roots(fps: np.ndarray, radius: int) -> np.ndarray:
    """Smallest fingerprint of each one's component inside a bucket (distinct, sorted input)."""
    n = len(fps)
    label = np.arange(n)
    step = max(1, (1 << 22) // n)
    u = fps.view(np.uint64)
    while True:  # label propagation over blocks of the pair matrix, never kept whole
        new = label.copy()
        for i in range(0, n, step):
            near = np.bitwise_count(u[i:i + step, None] ^ u[None, :]) <= radius
            new[i:i + step] = np.where(near, label[None, :], n).min(axis=1)
        new = new[new]
        if (new == label).all():
            return fps[label]
        label = new


def _bucket_links(radius: int):
    def run(batches):
        held_k, held_f = [], []

        def close(keys, fps):
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            firsts, sizes = np.r_[0, cuts], np.diff(np.r_[0, cuts, len(fps)])
            two = firsts[sizes == 2]
            a, b = fps[two], fps[two + 1]
            hit = np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)) <= radius
            out = [(b[hit], a[hit])]
            for f, s in zip(firsts[sizes > 2], sizes[sizes > 2]):
                part = fps[f:f + s]
                roots = _local_roots(part, radius)
                move = roots != part
                out.append((part[move], roots[move]))
            return pd.DataFrame({"a": np.concatenate([x for x, _ in out]), "b": np.concatenate([y for _, y in out])})

        for pdf in batches:
            if not len(pdf):
                continue
            keys, fps = pdf[["v", "key"]].to_numpy(np.int64), pdf["fp"].to_numpy(np.int64)
            held_k.append(keys)
            held_f.append(fps)
            if (keys[0] == keys[-1]).all() and (held_k[0][0] == keys[-1]).all():
                continue  # still inside one bucket
            keys, fps = np.concatenate(held_k), np.concatenate(held_f)
            last = len(keys) - int(np.argmax((keys[::-1] != keys[-1]).any(axis=1)))
            yield close(keys[:last], fps[:last])
            held_k, held_f = [keys[last:]], [fps[last:]]
        if held_k:
            yield close(np.concatenate(held_k), np.concatenate(held_f))
    return run


def link_components(fps: DataFrame, radius: int = 2, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """(fp, root) for every linked fingerprint of ``fps`` (one long column fp, distinct)."""
    masks = covering_masks(radius)
    keyed = stage(fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("v"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
        for i, m in enumerate(masks)])).alias("t")).select("fp", "t.v", "t.key"), "keyed")
    sizes = stage(keyed.groupBy("v", "key").count().filter("count > 1"), "buckets")
    full = keyed.join(sizes, ["v", "key"])
    small = full.filter(F.col("count") <= hot_bucket).select("v", "key", "fp")
    # A hot bucket's members agree on the mask; at most r of the open bits differ, so of r+1
    # equal parts of the open bits one agrees too. Re-keying on each part loses no pair.
    parts = []
    for i, m in enumerate(masks):
        open_bits = [b for b in range(64) if not m >> b & 1]
        for j in range(radius + 1):
            sub = m | sum(1 << b for b in open_bits[j::radius + 1])
            parts.append(F.when(F.col("v") == i, F.struct(
                F.lit(len(masks) + i * (radius + 1) + j).alias("v"),
                F.col("fp").bitwiseAND(F.lit(_signed(sub))).alias("key"))))
    hot = (full.filter(F.col("count") > hot_bucket)
           .select("fp", F.explode(F.filter(F.array(*parts), lambda x: x.isNotNull())).alias("t"))
           .select("t.v", "t.key", "fp"))
    edges = (small.union(hot).repartition("v", "key").sortWithinPartitions("v", "key", "fp")
             .mapInPandas(_bucket_links(radius), "a long, b long"))
    return components(edges).select(F.col("node").alias("fp"), "root")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp (long), component_id, root (the component's smallest fp)."""
    rows = stage(with_fingerprint(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")),
                                  "text", shingle).select("doc_id", "fp"), "fp")
    reps = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "reps")
    roots = link_components(reps.select("fp"), radius)
    tagged = reps.join(roots, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    firsts = tagged.groupBy("root").agg(F.min("first_id").alias("component_id"))
    member = stage(tagged.join(firsts, "root").select("fp", "component_id", "root"), "member")
    return rows.join(member, "fp").select("doc_id", "fp", "component_id", "root")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` without near copies: of each component one row with its smallest doc_id stays (where
    all its ids are null, one of them). An id that several rows share may be the smallest
    of several components; its rows are told apart by their fingerprints."""
    groups = simhash_groups(docs, shingle=shingle, radius=radius)
    firsts = groups.filter("doc_id is null and component_id is null or doc_id = component_id") \
        .groupBy("doc_id", "root").agg(F.min("fp").alias("fp"))
    shared = groups.groupBy("doc_id").agg(F.count("*").alias("rows")).filter("rows > 1 or doc_id is null")
    firsts = stage(firsts.join(shared.withColumnRenamed("doc_id", "__id"), F.col("doc_id").eqNullSafe(F.col("__id")), "left")
                   .select("doc_id", "fp", F.col("rows").isNotNull().alias("shared")), "firsts")
    plain = docs.join(firsts.filter("not shared").select("doc_id"), "doc_id", "left_semi").select(*docs.columns)
    # Repeated ids are rare and null ids rarer: only their rows are fingerprinted again.
    some = firsts.filter("shared").select(F.col("doc_id").alias("__id"), F.col("fp").alias("__first"))
    rows = docs.join(some.select("__id").distinct(), F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")
    again = (with_fingerprint(rows, "text", shingle, "__fp")
             .join(some, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__fp") == F.col("__first")), "left_semi")
             .dropDuplicates(["doc_id", "__fp"]).select(*docs.columns))
    return plain.union(again)

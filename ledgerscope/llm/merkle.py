"""Merkle manifest of a dataset as a content-addressed DAG, and proofs by descent.

Every row is a leaf: the SHA-256 of its fields, each with its length. Per
language the leaves stand in order of id and every ``FANOUT`` consecutive nodes
become one node, level by level, until one is left; the languages' last nodes
build the root in the same way. The store keeps one record per inner digest:
digest, children. Levels and ranks are not in a record: a digest names its
children wherever it occurs, and equal subtrees are one record.

A proof descends from the root. A request carries the rank of its leaf; its
base-``FANOUT`` digits choose one child a level, and the children not chosen make
that level's path segment. Requests for neighbouring leaves share their first
digits, so they go down as one row until their digits differ: a level has one
row per node on a requested path. At the leaves the segments are read in reverse
order, from the leaf to the root.

Digests are computed before any shuffle, so texts never move: a leaf is a row of
about a hundred bytes. Ranks come from range partitions with offsets. Groups have
``FANOUT`` rows at most. A digest that many requests meet at once (equal subtrees) stands
against one record, on tables that Spark can split.

Defined cases: null fields hash as ``-``; the null language comes first; null ids
come first in their language; rows with one id follow each other by digest, so
equal rows are interchangeable; a language of one row is its leaf; an empty
table has no root and no rows; extra columns are ignored and may not take part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerscope.llm.common import running, stage

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left:string,right:string>>"


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields, each its UTF-8 byte count, ``:`` and value, or ``-`` if null."""
    def one(c):
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.sha2(F.concat(*[one(c) for c in fields]), 256)


def leaves(docs: DataFrame, tampered: Column | None = None, fields=FIELDS, id_col: str = "doc_id",
           group_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(id, grp, rank, n, leaf, tampered): grp sorts like the group with null first, rank counts
    from 0 inside it, n is its size; ``tampered`` is the leaf of the row with A-Z of its text
    lower-cased where that condition holds, else null."""
    lowered = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = leaf_digest([lowered if f == text_col else F.col(f) for f in fields])
    group = F.coalesce(F.concat(F.lit("1"), F.col(group_col).cast("string")), F.lit("0"))
    rows = stage(docs.select(F.col(id_col).alias("id"), group.alias("grp"), leaf_digest([F.col(f) for f in fields]).alias("leaf"),
                             F.when(F.lit(False) if tampered is None else tampered, changed).alias("tampered"),
                             F.monotonically_increasing_id().alias("row")), "leaves")
    # The row number only lets many equal rows lie in several range partitions.
    placed = stage(running(rows, [F.col("grp"), F.col("id").asc_nulls_first(), F.col("leaf"), F.col("row")],
                           {"at": F.lit(1).cast("long")}), "ranks")
    sizes = stage(placed.groupBy("grp").agg(F.min("at").alias("first"), F.count("*").alias("n")), "sizes")
    return placed.join(sizes, "grp").select("id", "grp", (F.col("at") - F.col("first")).alias("rank"), "n", "leaf", "tampered")


def _climb(nodes: DataFrame, tallest: int):
    """From nodes (grp, rank, node, n), n being the nodes of the group on that level: the records
    (digest, children) of each level from 1 up, and per group its last node with its height."""
    records, last, level = [None], [], nodes
    for height in range(tallest + 1):
        last.append(level.filter("n = 1").select("grp", "node", F.lit(height).alias("height")))
        if height < tallest:
            runs = level.filter("n > 1").groupBy("grp", F.floor(F.col("rank") / FANOUT).alias("rank")).agg(
                F.transform(F.array_sort(F.collect_list(F.struct("rank", "node"))), lambda c: c["node"]).alias("children"),
                F.ceil(F.max("n") / FANOUT).alias("n"))
            level = stage(runs.withColumn("node", F.sha2(F.array_join("children", ""), 256)), "level")
            # Content-addressed: equal subtrees are one record.
            records.append(level.select(F.col("node").alias("digest"), "children").dropDuplicates(["digest"]))
    ends = last[0]
    for more in last[1:]:
        ends = ends.unionByName(more)
    return records, stage(ends, "last-nodes")


def _height(n: int) -> int:
    """Levels above n nodes until one is left."""
    h = 0
    while n > 1:
        n, h = -(-n // FANOUT), h + 1
    return h


class Manifest:
    """The stored DAG: ``root``; ``records`` and ``top_records``, by level, (digest, children);
    ``subroots`` (grp, rank among the groups, node, height); ``top_height``."""

    def __init__(self, records, top_records, subroots, root, top_height):
        self.records, self.top_records, self.subroots = records, top_records, subroots
        self.root, self.top_height = root, top_height


def build(rows: DataFrame) -> Manifest | None:
    """The manifest over ``leaves``; None if there are none."""
    most = rows.agg(F.max("n")).first()[0]
    if most is None:
        return None
    records, ends = _climb(rows.select("grp", "rank", F.col("leaf").alias("node"), "n"), _height(most))
    subroots = stage(running(ends, [F.col("grp")], {"rank": F.lit(1).cast("long")}), "subroots")
    groups = subroots.count()
    top_records, top = _climb(subroots.select(F.lit("").alias("grp"), "rank", "node", F.lit(groups).cast("long").alias("n")),
                              _height(groups))
    return Manifest(records, top_records, subroots, top.first()["node"], _height(groups))


def _segment(children: Column, digit: Column) -> Column:
    """What stays of a record when one child is chosen: the digests left and right of it."""
    return F.struct(F.array_join(F.slice(children, F.lit(1), digit), "").alias("left"),
                    F.array_join(F.slice(children, digit + 2, F.lit(FANOUT)), "").alias("right"))


def _descend(front: DataFrame, records: DataFrame, wanted: DataFrame | None, digits_left: int) -> DataFrame:
    """One level down: every row of ``front`` (grp, rank, node, subroot, path) meets its record and goes
    on as one row per chosen child; rank gains the digit, path the segment. ``wanted`` (grp, rank)
    are the requested leaves, ``digits_left`` the digits of theirs that are not yet used."""
    down = (front.join(records, F.col("node") == F.col("digest"))
            .select("grp", "rank", "subroot", "path", "children", F.posexplode("children").alias("digit", "child"))
            .select("grp", (F.col("rank") * FANOUT + F.col("digit")).alias("rank"), F.col("child").alias("node"), "subroot",
                    F.concat("path", F.array(_segment(F.col("children"), F.col("digit")))).alias("path")))
    if wanted is None:
        return down
    begun = wanted.select("grp", F.floor(F.col("rank") / FANOUT ** digits_left).alias("rank")).distinct()
    return down.join(begun, ["grp", "rank"], "left_semi")


def _last_records(manifest: Manifest, wanted: DataFrame | None) -> DataFrame:
    """(grp, rank, subroot, path, children): the leaves' parents on requested paths, rank being the
    leaf's without its last digit. Groups of one leaf have null children."""
    spark = manifest.subroots.sparkSession
    start = spark.createDataFrame([("", 0, manifest.root, [])], f"grp string, rank long, node string, path {_PATH}")
    front = start.withColumn("subroot", F.lit(None).cast("string"))
    for height in range(manifest.top_height, 0, -1):
        front = _descend(front, manifest.top_records[height], None, 0)
    # At the end of the tree over the groups every node is a group's last node.
    tops = stage(front.select("rank", "path").join(manifest.subroots, "rank")
                 .select("grp", F.lit(0).cast("long").alias("rank"), "node", F.col("node").alias("subroot"), "path", "height"),
                 "tops")
    if wanted is not None:
        tops = tops.join(wanted.select("grp").distinct(), "grp", "left_semi")
    front = None
    for height in range(len(manifest.records) - 1, 0, -1):
        starts = tops.filter(F.col("height") == height).drop("height")
        front = starts if front is None else starts.unionByName(front)
        if height > 1:
            front = stage(_descend(front, manifest.records[height], wanted, height - 1), "descent")
    lone = tops.filter("height = 0").select("grp", "rank", "subroot", "path", F.lit(None).cast("array<string>").alias("children"))
    if front is None:
        return lone
    return lone.unionByName(front.join(manifest.records[1], F.col("node") == F.col("digest"))
                            .select("grp", "rank", "subroot", "path", "children"))


def proofs(manifest: Manifest, rows: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """``rows`` (of ``leaves``) on requested paths, all if ``wanted`` (grp, rank) is None, plus subroot
    and path: the segments (left, right) from the leaf up to the root."""
    if wanted is not None:
        rows = rows.join(wanted, ["grp", "rank"], "left_semi")
    # Leaves come to their parent in runs of FANOUT at most, so a path is shuffled once for all of them.
    runs = rows.groupBy("grp", F.floor(F.col("rank") / FANOUT).alias("rank")).agg(
        F.collect_list(F.struct(F.col("rank").alias("leaf_rank"), "id", "leaf", "tampered")).alias("members"))
    last = F.when(F.col("children").isNull(), F.array().cast(_PATH)).otherwise(
        F.array(_segment(F.col("children"), (F.col("m.leaf_rank") % FANOUT).cast("int"))))
    return (_last_records(manifest, wanted).join(runs, ["grp", "rank"])
            .withColumn("m", F.explode("members"))
            .select("grp", "m.id", F.col("m.leaf_rank").alias("rank"), "m.leaf", "m.tampered", "subroot",
                    F.reverse(F.concat("path", last)).alias("path")))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path's segments give."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def audited(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Per row of ``docs`` (whose ``FIELDS`` are read): doc_id, leaf, subroot, root, proof (all siblings,
    leaf to root), folded_root from the tampered leaf if there is one, and whether it is the root."""
    rows = stage(leaves(docs, tampered), "ranked-leaves")
    manifest = build(rows)
    if manifest is None:
        out = rows.select(F.col("id").alias("doc_id"), "leaf", F.col("leaf").alias("subroot"), F.col("leaf").alias("root"),
                          F.lit("").alias("proof"), F.col("leaf").alias("folded_root"))
    else:
        out = proofs(manifest, rows).select(
            F.col("id").alias("doc_id"), "leaf", "subroot", F.lit(manifest.root).alias("root"),
            F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "").alias("proof"),
            folded(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))

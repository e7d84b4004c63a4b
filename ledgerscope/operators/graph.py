"""Edge and node tables of the flagged-transfer network."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NODE_SIZE_PER_EDGE = 3
NODE_SIZE_MIN = 6
NODE_SIZE_MAX = 30


def flagged_edges(top: DataFrame, score: str = "ensemble_score") -> DataFrame:
    """G1: (src, dst, amount, score) for each flagged transfer in ``top``."""
    return top.select("transaction_id", F.col("sender_account").alias("src"),
                      F.col("receiver_account").alias("dst"), "amount",
                      F.col(score).alias("score"))


def node_table(edges: DataFrame) -> DataFrame:
    """G2 + G3: per account the mean score and number of incident edges
    (a self-loop counts once) and the display size clamp(3 * degree, 6, 30)."""
    ends = edges.select("score", F.explode(F.array_distinct(F.array("src", "dst"))).alias("node"))
    g = ends.groupBy("node").agg(F.avg("score").alias("avg_score"),
                                 F.count(F.lit(1)).alias("degree"))
    size = F.least(F.greatest(F.col("degree") * NODE_SIZE_PER_EDGE, F.lit(NODE_SIZE_MIN)),
                   F.lit(NODE_SIZE_MAX))
    return g.withColumn("node_size", size.cast("long"))


def edge_accounts(edges: DataFrame) -> DataFrame:
    """Distinct accounts on either side of an edge set."""
    return (edges.select(F.col("src").alias("account"))
            .union(edges.select(F.col("dst").alias("account"))).distinct())


def union_all(*frames: DataFrame) -> DataFrame:
    """Bag union by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out

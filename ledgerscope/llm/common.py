"""Shared helpers: table access, staging in the shared folder, components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscope.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder of ``spark.checkpoint.dir``
    and read it back: the lineage is cut, the upstream runs once, later reads
    prune columns, and a lost executor loses nothing. Removed when the JVM ends."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(conf).deleteOnExit(hpath)
    return spark.read.schema(df.schema).parquet(path)


def unstage(*frames: DataFrame) -> None:
    """Remove the files that these staged frames read. Only for tables that nothing reads any more."""
    for df in frames:
        jvm, conf = df.sparkSession._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            hpath = jvm.org.apache.hadoop.fs.Path(folder)
            hpath.getFileSystem(conf).delete(hpath, True)


class Shipped:
    """A broadcast value whose classes travel with it: executors need no copy of this package.
    Spark's own broadcast pickles classes by name."""

    def __init__(self, spark: SparkSession, value):
        from pyspark import cloudpickle

        self._held, self._value = spark.sparkContext.broadcast(cloudpickle.dumps(value)), value

    def __getstate__(self):
        return {"_held": self._held, "_value": None}

    @property
    def value(self):
        if self._value is None:
            import pickle

            self._value = pickle.loads(self._held.value)
        return self._value


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of the undirected ``edges``; root is the
    smallest node reachable. Min-label propagation with pointer jumping, one
    staged table per round, until no label changes. Labels only fall, so it
    always ends; a chain of n nodes takes about log2(n) rounds."""
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
    both = stage(both.union(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
                 .filter("u is not null and v is not null").distinct(), "edges")
    labels = stage(both.groupBy(F.col("u").alias("node"))
                   .agg(F.least(F.min("v"), F.first("u")).alias("root")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("v"), "root"), "v")
                .groupBy(F.col("u").alias("node")).agg(F.min("root").alias("near")))
        cand = (labels.join(near, "node")
                .select("node", "root", F.least("root", "near").alias("cand")))
        hop = labels.select(F.col("node").alias("cand"), F.col("root").alias("jump"))
        nxt = stage(cand.join(hop, "cand")
                    .select("node", F.col("root").alias("old"), F.least("cand", "jump").alias("root")), "labels")
        changed = nxt.filter("root <> old").limit(1).count()
        labels = nxt.select("node", "root")
        if not changed:
            return labels


def utf8(text) -> bytes:
    """UTF-8 bytes of a str (None: empty); lone surrogates cannot occur in Spark strings."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def running(df: DataFrame, order: list, sums: dict) -> DataFrame:
    """``df`` plus, per entry name -> column of ``sums``, its sum over all rows
    before this one in the global ``order``. Range partitions, their totals, and
    a window inside each partition: no single-partition window over the rows."""
    from pyspark.sql import Window

    parts = stage(df.repartitionByRange(*order).withColumn("__pid", F.spark_partition_id()), "range")
    totals = parts.groupBy("__pid").agg(*[F.sum(c).alias(f"__{n}") for n, c in sums.items()])
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = totals.select("__pid", *[F.coalesce(F.sum(f"__{n}").over(before), F.lit(0)).alias(f"__{n}") for n in sums])
    own = Window.partitionBy("__pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = parts.join(offsets, "__pid")
    for n, c in sums.items():
        joined = joined.withColumn(n, F.col(f"__{n}") + F.coalesce(F.sum(c).over(own), F.lit(0)))
    return joined.drop("__pid", *[f"__{n}" for n in sums])

"""Python kernels must run on executors that cannot import this package
(the driver's working directory is not the repository)."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
from ledgerscope.operators.knn import knn_edges
df = spark.createDataFrame([(i, float(i % 7), float(i % 5)) for i in range(50)], "id long, a double, b double")
print("EDGES", knn_edges(df, df, "id", ["a", "b"], 3).count())
import tempfile
from pyspark.sql import functions as F
from ledgerscope.operators.dbscan import dbscan
print("CORE", dbscan(df, "id", ["a", "b"], 1.0, 4, scale=False).agg(F.sum("is_core")).first()[0])
from ledgerscope.streaming import monitor as ST
src = tempfile.mkdtemp(prefix="ledgerscope-gaps-")
spark.createDataFrame([(i, i % 2, 86400000 + i * 60000) for i in range(20)], "transaction_id long, sender_account long, ms long") \\
    .coalesce(1).write.mode("overwrite").parquet(src)
read = lambda r: r.parquet(src).withColumn("timestamp", F.timestamp_millis("ms"))
out = ST.run_to_table(ST.sender_gap_state(read(spark.readStream.schema("transaction_id long, sender_account long, ms long")),
                                          "0 seconds", bucket_ms=600000), src + "-o", src + "-c")
print("GAPS", out.count(), ST.close_sender_gaps(out, read(spark.read), "0 seconds", 600000).filter("time_since_last_txn = 120").count())
"""


def test_kernels_run_without_package_on_workers():
    cwd = tempfile.mkdtemp(prefix="ledgerscope-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True,
                       text=True, timeout=600)
    for said in ("EDGES 150", "CORE 50", "GAPS 10 18"):
        assert said in r.stdout, r.stdout + r.stderr[-2000:]

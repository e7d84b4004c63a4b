"""Readers and writers (IO1-IO5). Schemas are explicit; nothing is inferred.

Identifiers are text unless the caller passes another type; a CSV or JSON row that
does not fit the schema is an error, never a silent null."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerscope.sources.schema import acct_schema, txn_schema

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def _fmt(path: str, fmt: str | None) -> str:
    if fmt:
        return fmt
    p = path.rstrip("/").lower()
    if p.endswith(".csv") or p.endswith(".csv.gz"):
        return "csv"
    if p.endswith(".json"):
        return "json"
    return "parquet"


def _require(spark: SparkSession, path: str, what: str) -> None:
    # Asked of the path's own file system, which on a cluster is not the driver's disk.
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not (fs.globStatus(p) or ()):
        raise FileNotFoundError(f"{what} not found: {path}")


def _read(spark: SparkSession, path: str, schema, fmt: str | None) -> DataFrame:
    f = _fmt(path, fmt)
    r = spark.read.schema(schema).option("mode", "FAILFAST")
    # Partition directories (e.g. txn_month=...) are discovered as extra
    # columns; return exactly the declared schema.
    if f == "csv":
        return (r.option("header", True).option("timestampNTZFormat", TIMESTAMP_FORMAT).csv(path)
                .select(*schema.names))
    if f == "json":
        return r.json(path).select(*schema.names)
    # Parquet carries its own types; select in schema order and cast.
    df = spark.read.parquet(path)
    return df.select([F.col(fl.name).cast(fl.dataType).alias(fl.name) for fl in schema.fields])


def read_transactions(spark: SparkSession, path: str, fmt: str | None = None,
                      id_type: T.DataType = T.StringType()) -> DataFrame:
    """IO1: transfer ledger, timestamp parsed; a missing path or a malformed row is an error."""
    _require(spark, path, "Transaction file")
    return _read(spark, path, txn_schema(id_type), fmt)


def read_accounts(spark: SparkSession, path: str, fmt: str | None = None,
                  id_type: T.DataType = T.StringType()) -> DataFrame:
    """IO2: account dimension. The path is explicit (no string substitution)."""
    _require(spark, path, "Account file")
    return _read(spark, path, acct_schema(id_type), fmt)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """IO3: a feature table written by :func:`write_table` (typed parquet)."""
    _require(spark, path, "Processed data")
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by_month: bool = True, mode: str = "overwrite") -> None:
    """IO4: land a transfer-shaped table. Parquet partitioned by month lets
    later date filters prune whole directories."""
    w = df
    if partition_by_month and "timestamp" in df.columns:
        w = df.withColumn("txn_month", F.date_format("timestamp", "yyyy-MM"))
    writer = w.write.mode(mode)
    if partition_by_month and "timestamp" in df.columns:
        writer = writer.partitionBy("txn_month")
    if fmt == "csv":
        writer.option("header", True).option("timestampNTZFormat", TIMESTAMP_FORMAT).csv(path)
    else:
        writer.format(fmt).save(path)


def write_report(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """IO5: the one-row nested summary as a single JSON document."""
    report.coalesce(1).write.mode(mode).json(path)

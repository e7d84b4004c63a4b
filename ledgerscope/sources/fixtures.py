"""Transfer ledger and account dimension derived from the driver's test tables.

``events`` becomes the transfer ledger (one row per event) and
``customer`` joined to ``nation`` becomes the account dimension. The same
derivations exist as SQL text in :mod:`ledgerscope.plans.oracle_sql` so DuckDB can
check our results on identical inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

# Fixed value mappings of the fixture view (must equal the oracle SQL).
EVENT_TYPE_TO_TXN_TYPE = {
    "click": "ach",
    "view": "wire_transfer",
    "purchase": "cash_deposit",
    "signup": "cash_withdrawal",
}
OTHER_TXN_TYPE = "internal_transfer"
CURRENCIES = ["USD", "EUR", "GBP", "CHF"]
PATTERNS = ["structuring", "layering", "round_tripping", "rapid_movement"]
SEGMENT_TO_ACCOUNT_TYPE = {
    "HOUSEHOLD": "personal",
    "AUTOMOBILE": "personal",
    "FURNITURE": "personal",
    "BUILDING": "business",
    "MACHINERY": "corporate",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(col, mapping: dict, default):
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == F.lit(k), F.lit(v)) if expr is None
                else expr.when(col == F.lit(k), F.lit(v)))
    return expr.otherwise(F.lit(default))


def transactions_from_events(events: DataFrame) -> DataFrame:
    """``events`` -> transfer ledger with the transaction schema.

    A pure projection: no shuffle, and filters on the result push into the
    parquet scan of ``events``."""
    eid = F.col("event_id")
    amount = (F.when(eid % 10 == 0, F.ceil(F.col("value") * 200 / 1000).cast("double") * 1000)
              .otherwise(F.round(F.col("value") * 200, 2)))
    pattern = (F.when(eid % 33 != 0, F.lit("normal"))
               .otherwise(F.element_at(F.array(*[F.lit(p) for p in PATTERNS]),
                                       (F.expr("event_id div 33") % 4 + 1).cast("int"))))
    return events.select(
        eid.alias("transaction_id"),
        F.col("ts").alias("timestamp"),
        F.col("user_id").alias("sender_account"),
        F.regexp_extract("props", r"([0-9]+)", 1).cast("bigint").alias("receiver_account"),
        amount.cast("double").alias("amount"),
        _case(F.col("event_type"), EVENT_TYPE_TO_TXN_TYPE, OTHER_TXN_TYPE).alias("transaction_type"),
        F.element_at(F.array(*[F.lit(c) for c in CURRENCIES]), (eid % 4 + 1).cast("int")).alias("currency"),
        F.when(eid % 33 == 0, 1).otherwise(0).cast("int").alias("is_suspicious"),
        pattern.alias("pattern_type"),
    )


def accounts_from_tables(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """``customer`` joined to ``nation`` -> account dimension.

    ``nation`` is a fixed 25-row reference table, so broadcasting it is bounded."""
    bal = F.col("c_acctbal")
    return (customer.join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey, "left")
            .select(
                F.col("c_custkey").alias("account_id"),
                _case(F.col("c_mktsegment"), SEGMENT_TO_ACCOUNT_TYPE, None).alias("account_type"),
                F.col("n_name").alias("country"),
                F.when(bal < 2000, "high").when(bal < 5000, "medium").otherwise("low").alias("risk_rating"),
                bal.alias("opening_balance"),
            ))


def load_views(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(txn, acct) for one scale-factor directory."""
    txn = transactions_from_events(read_table(spark, sf_dir, "events"))
    acct = accounts_from_tables(read_table(spark, sf_dir, "customer"),
                                read_table(spark, sf_dir, "nation"))
    return txn, acct

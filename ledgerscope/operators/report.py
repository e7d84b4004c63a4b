"""Dashboard aggregates over a scored table (PF3, PF9, PF10, A13-A28, J5, S1-S3).

Every panel is a filter plus an aggregate; filters push into the scan of a
materialised scored table (partitioned by month) when one is used."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerscope.functions.exprs import DAY_NAMES, day_of_week, rate_band
from ledgerscope.operators.ensemble import alert_flag
from ledgerscope.operators.quantiles import exact_quantiles

QUARTILES = [0.0, 0.25, 0.5, 0.75, 1.0]
HOURS = list(range(24))


def _hour_cols(prefix="h"):
    return [f"{prefix}{h:02d}" for h in HOURS]


# -- filters -----------------------------------------------------------------

def filter_view(df: DataFrame, start=None, end=None, amount_min: float | None = None,
                amount_max: float | None = None, pattern: str | None = None,
                threshold: float = 0.5, score: str = "ensemble_score") -> DataFrame:
    """PF3: inclusive date and amount ranges, optional pattern equality, and
    the alert flag recomputed at ``threshold`` (PF4). A bound that is not
    passed drops no row, null amounts included."""
    cond = F.lit(True)
    if amount_min is not None:
        cond &= F.col("amount") >= F.lit(float(amount_min))
    if amount_max is not None:
        cond &= F.col("amount") <= F.lit(float(amount_max))
    d = F.to_date("timestamp")
    if start is not None:
        cond &= d >= F.lit(_as_date(start))
    if end is not None:
        cond &= d <= F.lit(_as_date(end))
    if pattern is not None and pattern != "All":
        cond &= F.col("pattern_type") == F.lit(pattern)
    return df.filter(cond).withColumn("is_alert", alert_flag(score, threshold))


def _as_date(x):
    return x if isinstance(x, _dt.date) else _dt.date.fromisoformat(str(x))


def filter_domains(df: DataFrame) -> DataFrame:
    """PF9: slider domains in one aggregate."""
    return df.agg(F.to_date(F.min("timestamp")).alias("min_date"),
                  F.to_date(F.max("timestamp")).alias("max_date"),
                  F.min("amount").alias("min_amount"), F.max("amount").alias("max_amount"))


def pattern_options(df: DataFrame) -> DataFrame:
    """PF9: sorted distinct pattern values."""
    return df.select("pattern_type").distinct().orderBy("pattern_type")


def detection_band(df: DataFrame, rate: str = "detection_rate") -> DataFrame:
    """PF10: band a detection rate (< 0.5 low, < 0.8 medium, else high)."""
    return df.withColumn("band", rate_band(rate))


# -- KPI row and flagged summary ---------------------------------------------------

def kpis(df: DataFrame, score: str = "ensemble_score") -> DataFrame:
    """Count, flagged, alert rate, distinct patterns among suspicious
    alerts, total amount, mean score."""
    a = F.col("is_alert")
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("n_total"),
        F.coalesce(F.sum(a), F.lit(0)).cast("long").alias("n_flagged"),
        F.when(n > 0, F.coalesce(F.sum(a), F.lit(0)) / n).otherwise(F.lit(0.0)).alias("alert_rate"),
        F.count_distinct(F.when((F.col("is_suspicious") == 1) & (a == 1), F.col("pattern_type")))
        .alias("n_patterns"),
        F.coalesce(F.sum("amount"), F.lit(0.0)).alias("total_value"),
        F.avg(score).alias("avg_score"),
    )


def flagged_summary(df: DataFrame, score: str = "ensemble_score") -> DataFrame:
    """Flagged count, mean flagged amount, max score, true positives
    (0 when nothing is flagged)."""
    f = df.filter(F.col("is_alert") == 1)
    return f.agg(F.count(F.lit(1)).alias("n_flagged"),
                 F.coalesce(F.avg("amount"), F.lit(0.0)).alias("avg_flagged_amount"),
                 F.coalesce(F.max(score), F.lit(0.0)).alias("max_score"),
                 F.coalesce(F.sum("is_suspicious"), F.lit(0)).cast("long").alias("true_positives"))


# -- time series ---------------------------------------------------------------

def daily_alerts(df: DataFrame) -> DataFrame:
    """Alerts and transfers per calendar day."""
    return (df.groupBy(F.to_date("timestamp").alias("date"))
            .agg(F.sum("is_alert").cast("long").alias("n_alerts"),
                 F.count("amount").alias("n_txns")))


def week_end(ts="timestamp"):
    """Label of the week ending on Sunday (a Sunday belongs to its own week)."""
    return F.next_day(F.date_sub(F.to_date(ts), 1), "Sun")


def weekly_volume(df: DataFrame) -> DataFrame:
    """Weekly transfers, alerts and amount; weeks without transfers
    between the first and last week appear with zeros (calendar spine)."""
    w = df.withColumn("week_end", week_end())
    agg = w.groupBy("week_end").agg(F.count("amount").alias("total"),
                                    F.sum("is_alert").cast("long").alias("flagged"),
                                    F.sum("amount").alias("volume"))
    spine = (agg.agg(F.min("week_end").alias("lo"), F.max("week_end").alias("hi"))
             .select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 7 DAYS"))).alias("week_end")))
    return (spine.join(agg, "week_end", "left")
            .select("week_end",
                    F.coalesce("total", F.lit(0)).cast("long").alias("total"),
                    F.coalesce("flagged", F.lit(0)).cast("long").alias("flagged"),
                    F.coalesce("volume", F.lit(0.0)).alias("volume")))


# -- heatmaps ------------------------------------------------------------------

def suspicious_heatmap(df: DataFrame) -> DataFrame:
    """Labelled-suspicious transfers by weekday (Monday first, all seven
    rows) x hour (h00..h23), missing cells 0."""
    s = df.filter(F.col("is_suspicious") == 1).withColumns(
        {"day_of_week": day_of_week("timestamp"), "hour": F.hour("timestamp")})
    p = s.groupBy("day_of_week").pivot("hour", HOURS).count()
    days = df.sparkSession.range(7).select(F.col("id").cast("int").alias("day_of_week"))
    names = F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES]), F.col("day_of_week") + 1)
    out = days.join(p, "day_of_week", "left").na.fill(0)
    return out.select("day_of_week", names.alias("day_name"),
                      *[F.coalesce(F.col(str(h)), F.lit(0)).cast("long").alias(c)
                        for h, c in zip(HOURS, _hour_cols())])


def pattern_hour_scores(df: DataFrame, score: str = "ensemble_score") -> DataFrame:
    """Mean score of labelled-suspicious transfers by pattern x hour,
    missing cells 0."""
    s = df.filter(F.col("is_suspicious") == 1).withColumn("hour", F.hour("timestamp"))
    p = s.groupBy("pattern_type").pivot("hour", HOURS).agg(F.avg(score))
    return p.select("pattern_type", *[F.coalesce(F.col(str(h)), F.lit(0.0)).alias(c)
                                      for h, c in zip(HOURS, _hour_cols())])


# -- accounts ------------------------------------------------------------------

def account_risk(df: DataFrame, score: str = "ensemble_score") -> DataFrame:
    """Per sender mean / max score, transfers, total amount, alerts."""
    return df.groupBy("sender_account").agg(
        F.avg(score).alias("avg_score"), F.max(score).alias("max_score"),
        F.count(F.lit(1)).alias("txn_count"), F.sum("amount").alias("total_amount"),
        F.sum("is_alert").cast("long").alias("flagged_count"))


def account_risk_with_accounts(df: DataFrame, acct: DataFrame,
                               score: str = "ensemble_score") -> DataFrame:
    """A19 left-joined to the account dimension (keys differ in name).
    Both sides hold one row per account; AQE picks broadcast or sort-merge
    from their measured sizes."""
    r = account_risk(df, score)
    return (r.join(acct, r.sender_account == acct.account_id, "left").drop("account_id"))


def top_risky_accounts(risk: DataFrame, n: int = 30) -> DataFrame:
    """The n accounts with the highest mean score (ties by account)."""
    return risk.orderBy(F.desc("avg_score"), F.asc("sender_account")).limit(n)


def country_type_risk(risk: DataFrame) -> DataFrame:
    """Mean account score by country x account type as one row per cell,
    for whatever types occur; a pair without accounts has no row (the panel
    shows 0 there). Rows without a country or type are dropped (as a pivot drops them)."""
    r = risk.filter(F.col("country").isNotNull() & F.col("account_type").isNotNull())
    return r.groupBy("country", "account_type").agg(F.avg("avg_score").alias("avg_score"))


def country_risk(risk: DataFrame) -> DataFrame:
    """A20 + A21: per country the mean of account means, distinct accounts and
    alerts; marked when strictly above the median of the country means.
    The country table is small by nature (one row per country), so its
    median is a scalar computed from it."""
    from ledgerscope.session import checkpoint_dir, pin

    checkpoint_dir(risk.sparkSession)
    c = (risk.filter(F.col("country").isNotNull()).groupBy("country")
         .agg(F.avg("avg_score").alias("avg_score"),
              F.count_distinct("sender_account").alias("n_accounts"),
              F.sum("flagged_count").cast("long").alias("total_flagged")))
    # Pin the (small) country table so the scored input is computed once for
    # both the median and the result.
    c = pin(c)
    med = c.agg(F.median("avg_score")).first()[0]
    above = (F.col("avg_score") > F.lit(med)) if med is not None else F.lit(False)
    return c.withColumn("above_median", above.cast("int")).orderBy(F.desc("avg_score"), "country")


# -- distributions -----------------------------------------------------------------

def pattern_distribution(df: DataFrame, only_suspicious: bool = True) -> DataFrame:
    """Transfers per pattern, most frequent first."""
    s = df.filter(F.col("is_suspicious") == 1) if only_suspicious else df
    return s.groupBy("pattern_type").agg(F.count(F.lit(1)).alias("count")).orderBy(
        F.desc("count"), "pattern_type")


def score_histogram(df: DataFrame, score: str = "ensemble_score", bins: int = 80) -> DataFrame:
    """Fixed-width histogram of a [0, 1] score; 1.0 falls in the last bin."""
    b = F.least(F.floor(F.col(score) * F.lit(bins)).cast("long") + 1, F.lit(bins).cast("long"))
    return (df.filter(F.col(score).isNotNull()).groupBy(b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumns({"bin_low": (F.col("bin") - 1) / F.lit(float(bins)),
                          "bin_high": F.col("bin") / F.lit(float(bins))}))


def score_quartiles(df: DataFrame, score: str = "ensemble_score",
                    label: str = "is_suspicious") -> DataFrame:
    """Min, quartiles and max of the score per truth label (exact)."""
    return exact_quantiles(df, score, QUARTILES, [label])


def amount_by_pattern(df: DataFrame) -> DataFrame:
    """A27 (box part): exact amount quartiles per pattern, suspicious rows."""
    return exact_quantiles(df.filter(F.col("is_suspicious") == 1), "amount", QUARTILES,
                           ["pattern_type"])


def amount_log_histogram(df: DataFrame, bins_per_decade: int = 10) -> DataFrame:
    """A27 (density part): amounts of suspicious rows in log10 buckets per pattern."""
    s = df.filter((F.col("is_suspicious") == 1) & (F.col("amount") > 0))
    b = F.floor(F.log10("amount") * F.lit(bins_per_decade)).cast("long")
    return s.groupBy("pattern_type", b.alias("log_bin")).agg(F.count(F.lit(1)).alias("n_rows"))


# -- alert lists -----------------------------------------------------------------

ALERT_QUEUE_COLUMNS = ["transaction_id", "timestamp", "sender_account", "receiver_account",
                       "amount", "currency", "transaction_type", "pattern_type",
                       "ensemble_score", "is_suspicious"]


def alert_queue(df: DataFrame, n: int = 500, score: str = "ensemble_score") -> DataFrame:
    """Alerts by score, highest first, first n, ten columns (ties by id).
    Planned as a per-partition top-n merged on one task (n rows each)."""
    cols = [c for c in ALERT_QUEUE_COLUMNS if c in df.columns]
    return (df.filter(F.col("is_alert") == 1)
            .orderBy(F.desc(score), F.asc("transaction_id")).limit(n).select(*cols))


def top_flagged(df: DataFrame, n: int = 200, score: str = "ensemble_score") -> DataFrame:
    """S3: the n highest-scored alerts."""
    return (df.filter(F.col("is_alert") == 1)
            .orderBy(F.desc(score), F.asc("transaction_id")).limit(n))


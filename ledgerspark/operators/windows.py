"""Window-style operators: metric drift z-score, latest row per key, latest flag."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions.num import round_to
from ledgerspark.operators.joins import sized_broadcast

DRIFT_ZSCORE_THRESHOLD = 3.0
MIN_PRIOR_PERIODS = 3


def margin_drift(pnl: DataFrame, metric: str = "operating_margin_pct",
                 threshold: float = DRIFT_ZSCORE_THRESHOLD, min_prior: int = MIN_PRIOR_PERIODS) -> DataFrame:
    """Latest value of ``metric`` per segment vs mean / population std-dev of all prior periods.

    One row per (non-null) segment. A segment is evaluated only with more than
    ``min_prior`` prior periods, no null values and a non-zero std-dev; a
    warning is raised when |z| > threshold. Runs on the P&L mart (months x
    segments rows), one window partition per segment.
    """
    d = pnl.where(F.col("segment").isNotNull()).select("segment", "period_month", F.col(metric).alias("v"))
    w = Window.partitionBy("segment").orderBy("period_month")
    prior = w.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("segment")
    x = d.select(
        "segment", "period_month", "v",
        F.count(F.lit(1)).over(whole).alias("n"),
        F.max("period_month").over(whole).alias("latest_period"),
        F.sum(F.when(F.col("v").isNull(), 1).otherwise(0)).over(whole).alias("n_null"),
        F.avg("v").over(prior).alias("mean"),
        F.stddev_pop("v").over(prior).alias("sd"))
    x = x.where(F.col("period_month") == F.col("latest_period"))
    ok = (F.col("n") >= min_prior + 1) & (F.col("n_null") == 0) & (F.col("sd") != 0)
    z = F.when(ok, (F.col("v") - F.col("mean")) / F.col("sd"))
    return x.select(
        "segment", "latest_period", F.col("v").alias("latest_value"),
        (F.col("n") - 1).cast("long").alias("prior_periods"),
        round_to("mean", 6).alias("prior_mean"), round_to("sd", 6).alias("prior_stdev"),
        round_to(z, 6).alias("z_score"),
        F.coalesce(F.abs(z) > F.lit(threshold), F.lit(False)).alias("is_drift_warning"))


def latest_per_key(df: DataFrame, key: str, ts: str, max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """All rows whose ``ts`` equals the maximum ``ts`` of their ``key`` (ties kept).

    Aggregate-then-semi-join rather than a window: the max is a partial
    aggregation (a hot key is combined map-side, never gathered into one task),
    and the join back is a broadcast of one row per key when that is small,
    otherwise a shuffle on (key, ts), which spreads a hot key across tasks.
    Rows with a null key are dropped, like an inner self-join on the key.
    """
    latest = df.groupBy(key).agg(F.max(ts).alias(ts)).where(F.col(key).isNotNull())
    return df.join(sized_broadcast(latest, max_broadcast_rows), [key, ts], "left_semi")


def is_latest_flag(df: DataFrame, key: str, ts: str, flag: str = "is_latest",
                   max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """Every row plus a boolean: is its ``ts`` the latest of its ``key`` (null key is a group)."""
    latest = df.groupBy(key).agg(F.max(ts).alias("_latest_ts")).withColumnRenamed(key, "_k")
    j = df.join(sized_broadcast(latest, max_broadcast_rows), F.col(key).eqNullSafe(F.col("_k")), "left")
    return j.withColumn(flag, F.col(ts) == F.col("_latest_ts")).drop("_k", "_latest_ts")

"""Reporting marts built from the mapped postings.

Aggregations are hash aggregates with map-side partial aggregation, so a hot
segment or month is combined before the shuffle. Month-over-month windows run
on the aggregated marts (months x grain rows), each window spec computed once
and referenced by column, so every mart has a single Exchange + Sort for its
window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerspark.functions.num import MONEY_SUM, pct_change, ratio_pct


def _month(c: str = "entry_date") -> F.Column:
    return F.trunc(F.col(c), "month").alias("period_month")


def _typed_sum(cond, value="amount_inr") -> F.Column:
    # sum(case when cond then amount else 0 end)
    return F.sum(F.when(cond, F.col(value)).otherwise(F.lit(0))).cast(MONEY_SUM)


def pnl_summary(mapped: DataFrame) -> DataFrame:
    """Month x segment P&L: revenue, cogs, opex (costs negative), margins, count."""
    at = F.col("account_type")
    g = (mapped.groupBy(_month(), F.col("segment_governed").alias("segment"))
         .agg(_typed_sum(at == "Revenue").alias("revenue"),
              _typed_sum(at == "COGS").alias("cogs"),
              _typed_sum(at == "OpEx").alias("opex"),
              F.count(F.lit(1)).alias("entry_count")))
    gm = (F.col("revenue") + F.col("cogs")).cast(MONEY_SUM)
    oi = (F.col("revenue") + F.col("cogs") + F.col("opex")).cast(MONEY_SUM)
    return g.select(
        "period_month", "segment", "revenue", "cogs",
        gm.alias("gross_margin"), "opex", oi.alias("operating_income"),
        ratio_pct(F.col("revenue") + F.col("cogs"), "revenue").alias("gross_margin_pct"),
        ratio_pct(F.col("revenue") + F.col("cogs") + F.col("opex"), "revenue").alias("operating_margin_pct"),
        "entry_count",
    )


def revenue_trends(mapped: DataFrame) -> DataFrame:
    """Revenue by month x segment x project with month-over-month change (% of |prev|)."""
    m = (mapped.where(F.col("account_type") == "Revenue")
         .groupBy(_month(), F.col("segment_governed").alias("segment"), "project_code",
                  F.col("project_name_governed").alias("project_name"), "client_name")
         .agg(F.sum("amount_inr").cast(MONEY_SUM).alias("revenue_inr"),
              F.count(F.lit(1)).alias("entry_count")))
    w = Window.partitionBy("segment", "project_code").orderBy("period_month")
    m = m.withColumn("prev_month_revenue", F.lag("revenue_inr").over(w))
    return m.withColumn("mom_change_pct", pct_change("revenue_inr", "prev_month_revenue", absolute_base=True))


def cost_analysis(mapped: DataFrame) -> DataFrame:
    """Cost (absolute) by month x segment x cost centre x account, MoM change (% of prev)."""
    m = (mapped.where(F.col("account_type").isin("COGS", "OpEx"))
         .groupBy(_month(), F.col("segment_governed").alias("segment"), "cost_centre", "cost_centre_name",
                  "cost_centre_location", "cost_centre_country", "account_type", "account_code", "account_name")
         .agg(F.sum(F.abs("amount_inr")).cast(MONEY_SUM).alias("cost_inr"),
              F.count(F.lit(1)).alias("entry_count")))
    w = Window.partitionBy("segment", "cost_centre", "account_code").orderBy("period_month")
    m = m.withColumn("prev_month_cost", F.lag("cost_inr").over(w))
    return m.withColumn("mom_change_pct", pct_change("cost_inr", "prev_month_cost", absolute_base=False))


def variance_analysis(pnl: DataFrame) -> DataFrame:
    """Month-over-month variance per segment against the previous existing month."""
    w = Window.partitionBy("segment").orderBy("period_month")
    lagged = pnl.select(
        "period_month", "segment", "revenue", "gross_margin", "operating_income",
        F.lag("revenue").over(w).alias("prev_revenue"),
        F.lag("gross_margin").over(w).alias("prev_gross_margin"),
        F.lag("operating_income").over(w).alias("prev_operating_income"))

    def var(cur, prev):
        return (F.col(cur) - F.coalesce(F.col(prev), F.lit(0))).cast(MONEY_SUM)

    oi, poi = F.col("operating_income"), F.col("prev_operating_income")
    material = F.coalesce(
        poi.isNotNull() & (poi != 0)
        & (F.abs((oi - poi).cast("double") / F.abs(poi).cast("double")) > F.lit(0.10)),
        F.lit(False))
    return lagged.select(
        "period_month", "segment",
        "revenue", "prev_revenue", var("revenue", "prev_revenue").alias("revenue_variance"),
        pct_change("revenue", "prev_revenue").alias("revenue_variance_pct"),
        "gross_margin", "prev_gross_margin", var("gross_margin", "prev_gross_margin").alias("gm_variance"),
        pct_change("gross_margin", "prev_gross_margin").alias("gm_variance_pct"),
        "operating_income", "prev_operating_income",
        var("operating_income", "prev_operating_income").alias("oi_variance"),
        pct_change("operating_income", "prev_operating_income").alias("oi_variance_pct"),
        material.alias("is_material_variance"),
    )


# The governed metric dictionary (11 rows, must equal the reference's).
METRIC_DICTIONARY = [
    ("revenue", "Revenue", "sum(amount_inr) where account_type = 'Revenue'", "INR", "mart_pnl_summary", "P&L Summary, Revenue Trends"),
    ("cogs", "Cost of Goods Sold", "sum(amount_inr) where account_type = 'COGS' (stored negative)", "INR", "mart_pnl_summary", "P&L Summary, Cost Analysis"),
    ("gross_margin", "Gross Margin", "revenue + cogs (cogs is negative, so effectively revenue - |cogs|)", "INR", "mart_pnl_summary", "P&L Summary, Variance Analysis"),
    ("gross_margin_pct", "Gross Margin %", "(revenue + cogs) / revenue * 100", "%", "mart_pnl_summary", "P&L Summary"),
    ("opex", "Operating Expenses", "sum(amount_inr) where account_type = 'OpEx' (stored negative)", "INR", "mart_pnl_summary", "P&L Summary, Cost Analysis"),
    ("operating_income", "Operating Income", "revenue + cogs + opex", "INR", "mart_pnl_summary", "P&L Summary, Variance Analysis"),
    ("operating_margin_pct", "Operating Margin %", "(revenue + cogs + opex) / revenue * 100", "%", "mart_pnl_summary", "P&L Summary"),
    ("revenue_mom_change", "Revenue MoM Change %", "(current - prior) / |prior| * 100 partitioned by segment+project", "%", "mart_revenue_trends", "Revenue Trends"),
    ("cost_mom_change", "Cost MoM Change %", "(current - prior) / prior * 100 partitioned by segment+cc+account", "%", "mart_cost_analysis", "Cost Analysis"),
    ("oi_variance_pct", "OI Variance %", "(current OI - prior OI) / |prior OI| * 100", "%", "mart_variance_analysis", "Variance Analysis"),
    ("is_material_variance", "Material Variance Flag", "true when |oi_variance_pct| > 10%", "bool", "mart_variance_analysis", "Variance Analysis"),
]
METRIC_COLUMNS = ["metric_key", "metric_name", "calculation_logic", "unit", "source_model", "used_in_views"]


def metric_dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(METRIC_DICTIONARY, ",".join(f"{c} string" for c in METRIC_COLUMNS))


def metric_lookup(dictionary: DataFrame, metric_key: str) -> DataFrame:
    """Definition of one metric; an unknown key yields one error record."""
    hit = dictionary.where(F.col("metric_key") == metric_key).select(
        "metric_key", "metric_name", "calculation_logic", "unit", F.lit(None).cast("string").alias("error"))
    miss = (dictionary.agg(F.count(F.when(F.col("metric_key") == metric_key, 1)).alias("n"))
            .where(F.col("n") == 0)
            .select(F.lit(None).cast("string").alias("metric_key"), F.lit(None).cast("string").alias("metric_name"),
                    F.lit(None).cast("string").alias("calculation_logic"), F.lit(None).cast("string").alias("unit"),
                    F.lit(f"No metric found for key '{metric_key}'").alias("error")))
    return hit.unionByName(miss)

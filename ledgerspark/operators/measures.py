"""Report measures over the marts: projections in crore, roll-ups, measures that
stay correct at any grain (ratio of sums, never average of ratios), a cube over
every filter context, single-value selection and calendar prior period.

All inputs are marts (aggregated data: months x grain rows), outputs are
grouped aggregates; joins between aggregates use null-safe keys because an
orphan segment is a real (null) group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.num import MONEY_SUM, crore, dbl, safe_div


def _nsjoin(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on keys with null-safe equality, keeping the left key columns."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def pnl_crore(pnl: DataFrame) -> DataFrame:
    """P&L in crore (amounts / 1e7, 2 decimals) with the percentage columns."""
    return pnl.select(
        "period_month", "segment",
        crore("revenue").alias("revenue_cr"), crore("cogs").alias("cogs_cr"),
        crore("gross_margin").alias("gross_margin_cr"), "gross_margin_pct",
        crore("opex").alias("opex_cr"), crore("operating_income").alias("operating_income_cr"),
        "operating_margin_pct", "entry_count")


def pnl_crore_grounding(pnl: DataFrame) -> DataFrame:
    """The five measure columns claims are grounded against."""
    return pnl.select(
        "period_month", "segment",
        crore("revenue").alias("revenue_cr"), crore("gross_margin").alias("gross_margin_cr"),
        "gross_margin_pct", crore("operating_income").alias("operating_income_cr"),
        "operating_margin_pct")


def variance_context(variance: DataFrame) -> DataFrame:
    return variance.select("period_month", "segment", "revenue_variance_pct", "gm_variance_pct",
                           "oi_variance_pct", "is_material_variance")


def revenue_by_segment(trends: DataFrame) -> DataFrame:
    return trends.groupBy("period_month", "segment").agg(crore(F.sum("revenue_inr")).alias("revenue_cr"))


def cost_by_type(cost: DataFrame) -> DataFrame:
    return cost.groupBy("period_month", "segment", "account_type").agg(
        crore(F.sum("cost_inr")).alias("cost_cr"))


def base_measures(pnl: DataFrame, trends: DataFrame, cost: DataFrame, by: list[str]) -> DataFrame:
    """The seven additive totals at the grain ``by`` (any subset of period_month, segment)."""
    p = pnl.groupBy(*by).agg(
        F.sum("revenue").cast(MONEY_SUM).alias("total_revenue"),
        F.sum("cogs").cast(MONEY_SUM).alias("total_cogs"),
        F.sum("gross_margin").cast(MONEY_SUM).alias("total_gross_margin"),
        F.sum("opex").cast(MONEY_SUM).alias("total_opex"),
        F.sum("operating_income").cast(MONEY_SUM).alias("total_operating_income"))
    c = cost.groupBy(*by).agg(F.sum("cost_inr").cast(MONEY_SUM).alias("total_cost"))
    t = trends.groupBy(*by).agg(F.sum("revenue_inr").cast(MONEY_SUM).alias("total_trend_revenue"))
    if not by:
        return p.unionByName(c, allowMissingColumns=True).unionByName(t, allowMissingColumns=True) \
            .agg(*[F.max(x).alias(x) for x in ["total_revenue", "total_cogs", "total_gross_margin", "total_opex",
                                               "total_operating_income", "total_cost", "total_trend_revenue"]])
    return _nsjoin(_nsjoin(p, c, by), t, by)


def margin_cube(pnl: DataFrame) -> DataFrame:
    """Totals and re-aggregated margins for every filter context of (period_month, segment).

    ``grouping_id`` tells a roll-up row (bit set) from the orphan (null) segment.
    """
    g = pnl.cube("period_month", "segment").agg(
        F.sum("revenue").cast(MONEY_SUM).alias("total_revenue"),
        F.sum("gross_margin").cast(MONEY_SUM).alias("total_gross_margin"),
        F.sum("operating_income").cast(MONEY_SUM).alias("total_operating_income"),
        F.grouping_id().cast("bigint").alias("grouping_id"))
    return g.select(
        "period_month", "segment", "grouping_id", "total_revenue", "total_gross_margin", "total_operating_income",
        (safe_div("total_gross_margin", "total_revenue") * F.lit(100.0)).alias("gross_margin_pct"),
        (safe_div("total_operating_income", "total_revenue") * F.lit(100.0)).alias("operating_margin_pct"))


def selected_value(x: str) -> F.Column:
    """The value when the context holds exactly one distinct value (null counts), else null."""
    c = F.col(x)
    n = F.count_distinct(c) + F.max(F.when(c.isNull(), 1).otherwise(0))
    return F.when(n == 1, F.max(c))


def native_grain_selector(variance: DataFrame, trends: DataFrame, cost: DataFrame,
                          by: list[str]) -> DataFrame:
    """Pre-computed % columns, shown only where the grain ``by`` is their native grain."""
    v = variance.groupBy(*by).agg(selected_value("oi_variance_pct").alias("oi_variance_pct"))
    r = trends.groupBy(*by).agg(selected_value("mom_change_pct").alias("revenue_mom_pct"))
    c = cost.groupBy(*by).agg(selected_value("mom_change_pct").alias("cost_mom_pct"))
    return _nsjoin(_nsjoin(v, r, by), c, by)


def prior_month_measure(pnl: DataFrame, by: list[str]) -> DataFrame:
    """Operating income against the same measure one calendar month earlier.

    Unlike the marts' lag (previous *existing* month), a missing month gives a
    null prior. Self-join of the aggregated grain on ``add_months(period, -1)``.
    """
    keys = ["period_month", *by]
    cur = pnl.groupBy(*keys).agg(F.sum("operating_income").cast(MONEY_SUM).alias("operating_income"))
    prev = cur.select(F.add_months("period_month", 1).alias("period_month"), *by,
                      F.col("operating_income").alias("prior_operating_income"))
    j = _nsjoin(cur, prev, keys)
    pct = safe_div(F.col("operating_income") - F.col("prior_operating_income"),
                   F.abs(F.col("prior_operating_income"))) * F.lit(100.0)
    return j.select(*keys, "operating_income", "prior_operating_income", pct.alias("oi_change_pct"))


def reconcile_pnl(mapped: DataFrame, pnl: DataFrame) -> DataFrame:
    """Source vs mart totals and counts in one aggregation over the union of both inputs."""
    src = mapped.select(F.col("amount_inr").cast(MONEY_SUM).alias("s_amt"), F.lit(1).alias("s_n"),
                        F.lit(None).cast(MONEY_SUM).alias("m_amt"), F.lit(None).cast("long").alias("m_n"))
    mrt = pnl.select(F.lit(None).cast(MONEY_SUM).alias("s_amt"), F.lit(None).cast("int").alias("s_n"),
                     (F.col("revenue") + F.col("cogs") + F.col("opex")).cast(MONEY_SUM).alias("m_amt"),
                     F.col("entry_count").cast("long").alias("m_n"))
    a = src.unionByName(mrt).agg(
        F.round(F.sum("s_amt"), 2).cast(MONEY_SUM).alias("source_total"),
        F.round(F.sum("m_amt"), 2).cast(MONEY_SUM).alias("mart_total"),
        F.count("s_n").alias("source_count"),
        F.sum("m_n").cast("long").alias("mart_count"))
    diff = F.abs(F.col("source_total") - F.col("mart_total")).cast(MONEY_SUM)
    return a.select("source_total", "mart_total", diff.alias("diff"), "source_count", "mart_count",
                    (diff < F.lit(0.01)).alias("total_ok"),
                    (F.col("source_count") == F.col("mart_count")).alias("count_ok"))


def scale_reconciliation(ledger) -> DataFrame:
    """Staged row counts and the source-vs-mart reconciliation of a (scaled) load."""
    from ledgerspark.operators.gates import _one_row
    parts = [
        ledger.stg_gl.agg(F.count(F.lit(1)).alias("gl_rows")),
        ledger.stg_payroll.agg(F.count(F.lit(1)).alias("payroll_rows")),
        ledger.int_mapped.agg(F.round(F.sum("amount_inr"), 2).cast(MONEY_SUM).alias("source_total")),
        ledger.pnl.agg(F.round(F.sum(F.col("revenue") + F.col("cogs") + F.col("opex")), 2)
                       .cast(MONEY_SUM).alias("mart_total")),
    ]
    diff = F.abs(F.col("source_total") - F.col("mart_total")).cast(MONEY_SUM)
    return _one_row(parts).select("gl_rows", "payroll_rows", "source_total", "mart_total", diff.alias("diff"),
                                  (diff < F.lit(0.01)).alias("passed"))


__all__ = ["scale_reconciliation", "pnl_crore", "pnl_crore_grounding", "variance_context", "revenue_by_segment", "cost_by_type",
           "base_measures", "margin_cube", "selected_value", "native_grain_selector", "prior_month_measure",
           "reconcile_pnl", "dbl"]


def headline_facts(pnl: DataFrame, variance: DataFrame, cost: DataFrame) -> DataFrame:
    """Deterministic facts a card headline is written from, one row per segment.

    Most volatile segment (largest |oi_variance_pct|, with its range), the
    segment's revenue peak month and its share of that month's revenue, and its
    dominant cost type with its share of the segment's cost. Only grouped
    aggregates and equi-joins on small aggregated frames.
    """
    from ledgerspark.functions.num import ratio_pct
    vol = variance.groupBy("segment").agg(
        F.max(F.abs("oi_variance_pct")).alias("volatility"),
        F.min("oi_variance_pct").alias("oi_var_min"), F.max("oi_variance_pct").alias("oi_var_max"))
    top = F.broadcast(vol.agg(F.max("volatility").alias("_top")).where(F.col("_top").isNotNull()))
    vol = vol.join(top, vol.volatility == top._top, "left") \
        .withColumn("is_most_volatile", F.col("_top").isNotNull()).drop("_top")
    peak = pnl.groupBy("segment").agg(F.max(F.struct("revenue", "period_month")).alias("p")) \
        .select("segment", F.col("p.period_month").alias("peak_month"), F.col("p.revenue").alias("peak_revenue"))
    month = pnl.groupBy("period_month").agg(F.sum("revenue").cast(MONEY_SUM).alias("month_revenue"))
    peak = peak.join(month, peak.peak_month == month.period_month, "left").select(
        "segment", "peak_month", crore("peak_revenue").alias("peak_revenue_cr"),
        ratio_pct("peak_revenue", "month_revenue").alias("peak_share_pct"))
    by_type = cost.groupBy("segment", "account_type").agg(F.sum("cost_inr").cast(MONEY_SUM).alias("c"))
    dom = by_type.groupBy("segment").agg(F.max(F.struct("c", "account_type")).alias("d"),
                                         F.sum("c").cast(MONEY_SUM).alias("total_cost")) \
        .select("segment", F.col("d.account_type").alias("dominant_cost_type"),
                ratio_pct(F.col("d.c"), F.col("total_cost")).alias("dominant_cost_share_pct"))
    return _nsjoin(_nsjoin(vol, peak, ["segment"]), dom, ["segment"]).select(
        "segment", "volatility", "oi_var_min", "oi_var_max", "is_most_volatile", "peak_month",
        "peak_revenue_cr", "peak_share_pct", "dominant_cost_type", "dominant_cost_share_pct")

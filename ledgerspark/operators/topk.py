"""Top-k reports over the marts (the variance agent's tools) and set differences.

Top-k uses ``orderBy(...).limit(k)``, which Spark plans as
TakeOrderedAndProject: each partition keeps its own k best rows, only those
are merged — no global sort. Nulls sort last, as in the reference database.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TOP_K = 25


def _filters(df: DataFrame, period_month: str | None, segment: str | None) -> DataFrame:
    if period_month:
        df = df.where(F.col("period_month") == F.lit(period_month).cast("date"))
    if segment:
        df = df.where(F.col("segment") == segment)
    return df


def _variance_order() -> list[F.Column]:
    return [F.col("is_material_variance").desc_nulls_last(), F.col("period_month").asc_nulls_last(), F.col("segment").asc_nulls_last()]


def _driver_order() -> list[F.Column]:
    return [F.abs(F.coalesce(F.col("mom_change_pct"), F.lit(0.0))).desc(),
            *[F.col(c).asc_nulls_last() for c in ["period_month", "segment", "cost_centre", "account_code"]]]


VARIANCE_COLUMNS = ["period_month", "segment", "revenue", "prev_revenue", "revenue_variance_pct", "gross_margin",
                    "gm_variance_pct", "operating_income", "oi_variance_pct", "is_material_variance"]
DRIVER_COLUMNS = ["period_month", "segment", "cost_centre_name", "account_type", "account_name", "cost_inr", "mom_change_pct"]


def variance_breakdown(variance: DataFrame, period_month: str | None = None, segment: str | None = None,
                       k: int = TOP_K) -> DataFrame:
    """Material variances first, then by month and segment; optional filters."""
    return _filters(variance, period_month, segment).select(*VARIANCE_COLUMNS).orderBy(*_variance_order()).limit(k)


def cost_drivers(cost: DataFrame, period_month: str | None = None, segment: str | None = None,
                 k: int = TOP_K) -> DataFrame:
    """Largest absolute month-over-month cost change first; grain columns break ties."""
    return _filters(cost, period_month, segment).orderBy(*_driver_order()).limit(k).select(*DRIVER_COLUMNS)


def _json_value(name: str, dtype: str) -> F.Column:
    """A column's value as JSON text: ISO dates, plain decimal numbers (ten places at most), escaped strings, null."""
    c = F.col(name)
    if dtype == "date":
        text = F.concat(F.lit('"'), F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit('"'))
    elif dtype == "boolean" or dtype in ("tinyint", "smallint", "int", "bigint"):
        text = c.cast("string")
    elif dtype in ("float", "double") or dtype.startswith("decimal"):
        # 12.5000000000 -> 12.5, 7.0000000000 -> 7.0, as a float is written
        text = F.regexp_replace(c.cast("double").cast("decimal(38,10)").cast("string"), r"(\.\d+?)0*$", "$1")
    else:
        text = F.regexp_extract(F.to_json(F.array(c.cast("string"))), r"(?s)\A\[(.*)\]\z", 1)
        text = F.when(c.isNotNull(), text)
    return F.concat(F.lit(f'"{name}":'), F.coalesce(text, F.lit("null")))


def records_json(df: DataFrame, order: list[F.Column], columns: list[str], k: int = TOP_K) -> DataFrame:
    """The first ``k`` rows by ``order`` as one JSON array of row objects, in that order.

    The limit is part of the operator: only ``k`` rows ever meet in one task, whatever ``df`` holds.
    """
    first = df.orderBy(*order).limit(k).withColumn("_pos", F.row_number().over(Window.orderBy(*order)))
    kinds = dict(df.dtypes)
    row = F.concat(F.lit("{"), F.concat_ws(",", *[_json_value(c, kinds[c]) for c in columns]), F.lit("}"))
    rows = first.select(F.struct("_pos", row.alias("json")).alias("r")).agg(F.array_sort(F.collect_list("r")).alias("rows"))
    return rows.select(F.concat(F.lit("["), F.concat_ws(",", F.transform("rows", lambda r: r["json"])), F.lit("]")).alias("records_json"))


def variance_json(variance: DataFrame, period_month: str | None = None, segment: str | None = None, k: int = TOP_K) -> DataFrame:
    """``variance_breakdown`` as one JSON array."""
    return records_json(_filters(variance, period_month, segment), _variance_order(), VARIANCE_COLUMNS, k)


def cost_drivers_json(cost: DataFrame, period_month: str | None = None, segment: str | None = None, k: int = TOP_K) -> DataFrame:
    """``cost_drivers`` as one JSON array."""
    return records_json(_filters(cost, period_month, segment), _driver_order(), DRIVER_COLUMNS, k)


def set_difference(left: DataFrame, right: DataFrame, cols: list[str], left_name: str = "left",
                   right_name: str = "right") -> DataFrame:
    """Two-way distinct difference (null-safe): which values are only on one side."""
    a, b = left.select(*cols).distinct(), right.select(*cols).distinct()
    return (a.subtract(b).withColumn("only_in", F.lit(left_name))
            .unionByName(b.subtract(a).withColumn("only_in", F.lit(right_name))))


def foreign_pairs(gl: DataFrame, base: str = "INR") -> DataFrame:
    """Distinct (entry_date, currency) of non-base postings (a null currency counts as foreign).

    A partial aggregation over two columns: its size is days x currencies, not postings.
    """
    return (gl.where(~F.col("currency").eqNullSafe(F.lit(base)))
            .select("entry_date", "currency").distinct())


def fx_coverage_gaps(gl: DataFrame | None, fx: DataFrame, base: str = "INR",
                     pairs: DataFrame | None = None) -> DataFrame:
    """Distinct (date, currency) of non-base postings that have no FX rate.

    A null currency counts as foreign (it is not the base), and a null date or
    currency never matches a rate. ``pairs`` replaces ``gl`` when precomputed.
    """
    pairs = foreign_pairs(gl, base) if pairs is None else pairs
    rates = fx.select(F.col("rate_date").alias("entry_date"), F.col("from_currency").alias("currency")).distinct()
    return pairs.join(rates, ["entry_date", "currency"], "left_anti")

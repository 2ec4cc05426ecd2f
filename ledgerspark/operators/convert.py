"""Currency conversion and governed-dimension enrichment.

No posting is ever dropped: both joins are left joins, a missing FX rate gives
a null converted amount, an unknown project / cost centre gives an orphan flag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators.joins import sized_broadcast

REPORTING_CURRENCY = "INR"
FX_BROADCAST_ROWS = 2_000_000
DIM_BROADCAST_ROWS = 2_000_000


def _rates_with_base(fx: DataFrame, base: str) -> DataFrame:
    """FX rates keyed by (rate_date, from_currency) plus the base-currency rate 1.

    Entries in the base currency always convert at 1. The base rate is not
    padded for every ledger date (that would need a pass over the ledger);
    instead a posting with no matching row converts at 1 below, and only where
    the bronze rates themselves carry base-currency rows is an extra rate-1 row
    added, so such a date fans out exactly as a padded rate table would.
    """
    r = fx.select("rate_date", "from_currency", "rate")
    extra = (r.where(F.col("from_currency") == base).select("rate_date").distinct()
             .select("rate_date", F.lit(base).alias("from_currency"),
                     F.lit(1).cast("decimal(12,6)").alias("rate")))
    return r.unionByName(extra)


def fx_convert(gl: DataFrame, fx: DataFrame, base: str = REPORTING_CURRENCY,
               broadcast_rows: int = FX_BROADCAST_ROWS, broadcast: bool | None = None) -> DataFrame:
    """Every staged posting converted to the reporting currency.

    amount_inr = cast(amount * rate as decimal(18,2)) (half away from zero).
    The rate table is one row per day and currency; it is broadcast after a
    bounded size check, otherwise joined by shuffle. ``broadcast`` passes a
    decision already made by the caller (a stream decides once, not per batch).
    """
    r = _rates_with_base(fx, base)
    rates = sized_broadcast(r, broadcast_rows) if broadcast is None else (F.broadcast(r) if broadcast else r)
    j = gl.join(rates, (gl.entry_date == rates.rate_date) & (gl.currency == rates.from_currency), "left")
    rate = F.when((F.col("currency") == base) & F.col("rate").isNull() & F.col("entry_date").isNotNull(),
                  F.lit(1).cast("decimal(12,6)")).otherwise(F.col("rate"))
    return j.select(
        "entry_id", "entry_date", "project_code", "project_name", "segment", "cost_centre",
        "account_code", "account_name", "account_type",
        F.col("currency").alias("source_currency"),
        F.col("amount").alias("source_amount"),
        rate.alias("fx_rate"),
        (F.col("amount") * rate).cast("decimal(18,2)").alias("amount_inr"),
        F.lit(base).alias("reporting_currency"),
        "description",
    )


def map_dimensions(entries: DataFrame, projects: DataFrame, cost_centres: DataFrame,
                   broadcast_rows: int = DIM_BROADCAST_ROWS,
                   broadcast: tuple[bool, bool] | None = None) -> DataFrame:
    """Enrich converted postings with governed project and cost-centre attributes.

    ``broadcast`` = (projects, cost centres) decisions already made by the caller;
    by default each side is broadcast after a bounded size check."""
    p = projects.select(
        F.col("project_code").alias("_p_code"),
        F.col("project_name").alias("project_name_governed"),
        F.col("segment").alias("segment_governed"),
        "client_name", "billing_currency")
    cc = cost_centres.select(
        F.col("cost_centre").alias("_cc_code"),
        "cost_centre_name",
        F.col("location").alias("cost_centre_location"),
        F.col("country").alias("cost_centre_country"))
    if broadcast is None:
        p, cc = sized_broadcast(p, broadcast_rows), sized_broadcast(cc, broadcast_rows)
    else:
        p, cc = (F.broadcast(p) if broadcast[0] else p), (F.broadcast(cc) if broadcast[1] else cc)
    j = (entries
         .join(p, entries.project_code == F.col("_p_code"), "left")
         .join(cc, entries.cost_centre == F.col("_cc_code"), "left"))
    return j.select(
        "entry_id", "entry_date",
        "project_code", "project_name_governed", "segment_governed", "client_name", "billing_currency",
        "cost_centre", "cost_centre_name", "cost_centre_location", "cost_centre_country",
        "account_code", "account_name", "account_type",
        "source_currency", "source_amount", "fx_rate", "amount_inr", "reporting_currency",
        F.col("_p_code").isNull().alias("is_orphan_project"),
        F.col("_cc_code").isNull().alias("is_orphan_cost_centre"),
        "description",
    )

"""Adapter: the driver's TPC-H-like tables -> the ledger's bronze tables.

Each line item becomes one general-ledger posting, each order one payroll
allocation, every ship date gets one FX rate per foreign currency, nations
(with their region as segment) are the governed projects and suppliers the
governed cost centres. Everything is a lazy DataFrame; joins between the large
tables are shuffle joins planned by Catalyst, the fixed-size TPC-H reference
tables (nation, region) are broadcast after a size check.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.operators.joins import sized_broadcast

# Fixed values of the adapter (both engines must agree on them).
# Currency of a posting by the customer's region key.
REGION_CURRENCY = {0: "USD", 1: "INR", 2: "EUR", 3: "GBP", 4: "AED"}
# Base INR rate, multiplier for the daily drift, per foreign currency.
FX_BASE = [("USD", "83.20", 37), ("EUR", "90.40", 53), ("GBP", "105.10", 71), ("AED", "22.65", 13)]
FX_EPOCH = "1990-01-01"
# Nations / suppliers left out of the governed dimensions, so orphan handling is exercised.
UNMAPPED_NATIONS = (24,)
UNMAPPED_SUPPLIERS = (7,)


# Tables whose rows are worked on before any shuffle: spread over the cluster when the files give fewer scan tasks
# than cores. (lineitem and orders meet in a join first, whose shuffle spreads them.)
FACT_TABLES = {"documents", "events", "pages", "conversations"}


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan that yields fewer partitions than the cluster has cores.

    A single large file with one row group is read by one task; without this,
    every projection and map-side stage after it would run in that one task.
    On a real table (many files / row groups) the scan already has enough
    partitions and this is a no-op.
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return spread(df) if name in FACT_TABLES else df


def _currency(regionkey: F.Column) -> F.Column:
    expr = None
    for k, ccy in REGION_CURRENCY.items():
        expr = F.when(regionkey == k, ccy) if expr is None else expr.when(regionkey == k, ccy)
    return expr


def _nation_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return nation.join(sized_broadcast(region, 1000), nation.n_regionkey == region.r_regionkey, "left")


def gl_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """General-ledger postings (bronze shape, 12 columns)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        "l_returnflag", "l_linestatus", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nr = sized_broadcast(_nation_region(spark, sf_dir), 10_000)

    order_nation = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner") \
        .select("o_orderkey", "c_nationkey")
    j = (li.join(order_nation, li.l_orderkey == order_nation.o_orderkey, "inner")
         .join(nr, F.col("c_nationkey") == nr.n_nationkey, "inner"))

    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    account_type = F.when(flag == "N", "Revenue").when(flag == "R", "COGS").otherwise("OpEx")
    account_name = F.concat(
        F.when(flag == "N", "Sales").when(flag == "R", "Returns handling").otherwise("Fulfilment"),
        F.when(status == "F", F.lit(" - closed")).otherwise(F.lit(" - open")))
    price = F.col("l_extendedprice")
    amount = (F.when(flag == "N", price.cast("decimal(18,2)"))
              .when(flag == "R", (price * F.lit(-0.4)).cast("decimal(18,2)"))
              .otherwise((price * F.lit(-0.2)).cast("decimal(18,2)")))
    project_code = F.concat(F.lit("P-"), F.col("c_nationkey").cast("string"))
    return j.select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                    F.date_format("l_shipdate", "yyyyMMdd")).alias("entry_id"),
        F.col("l_shipdate").cast("date").alias("entry_date"),
        project_code.alias("project_code"),
        F.col("n_name").alias("project_name"),
        F.col("r_name").alias("segment"),
        F.concat(F.lit("CC-"), F.col("l_suppkey").cast("string")).alias("cost_centre"),
        F.concat(flag, status).alias("account_code"),
        account_name.alias("account_name"),
        account_type.alias("account_type"),
        _currency(F.col("n_regionkey")).alias("currency"),
        amount.alias("amount"),
        F.concat(account_name, F.lit(" for "), project_code).alias("description"),
    )


def fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rate per ship date and foreign currency, integer-derived so that it is exact.

    The distinct dates come from a partial aggregation over one column of
    lineitem; the four currencies are produced by ``explode`` (no join).
    """
    dates = (read_table(spark, sf_dir, "lineitem")
             .select(F.col("l_shipdate").cast("date").alias("rate_date")).distinct())
    base = F.array(*[F.struct(F.lit(c).alias("ccy"), F.lit(b).cast("decimal(9,3)").alias("base"),
                              F.lit(k).alias("k")) for c, b, k in FX_BASE])
    n = F.datediff(F.col("rate_date"), F.lit(FX_EPOCH).cast("date"))
    e = dates.select("rate_date", F.explode(base).alias("b"))
    drift = ((n * F.col("b.k")) % 1001 - 500).cast("decimal(9,0)") * F.lit("0.001").cast("decimal(4,3)")
    return e.select(
        "rate_date",
        F.col("b.ccy").alias("from_currency"),
        F.lit("INR").alias("to_currency"),
        (F.col("b.base") + drift).cast("decimal(12,6)").alias("rate"),
    )


def missing_rate(day: str = "rate_date", currency: str = "from_currency") -> F.Column:
    """Which rates a partial delivery lacks (fixed values of the adapter): dirhams every 7th day, dollars every 41st."""
    n = F.datediff(F.col(day), F.lit(FX_EPOCH).cast("date"))
    return ((F.col(currency) == "AED") & (n % 7 == 3)) | ((F.col(currency) == "USD") & (n % 41 == 5))


def payroll_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payroll allocation per order (hours 20..160 by 0.1, rate 800..3500)."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
    hours = ((F.lit(200) + F.col("o_orderkey") % 1401).cast("decimal(8,2)")
             * F.lit("0.1").cast("decimal(2,1)")).cast("decimal(8,2)")
    rate = ((F.lit(80000) + (F.col("o_orderkey") * 7 + F.col("o_custkey")) % 270001).cast("decimal(10,2)")
            * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(10,2)")
    return j.select(
        F.concat(F.lit("PAY-"), F.col("o_orderkey").cast("string")).alias("allocation_id"),
        F.col("o_orderdate").cast("date").alias("allocation_date"),
        F.concat(F.lit("EMP-"), F.lpad((F.col("o_custkey") % 30 + 1).cast("string"), 4, "0")).alias("employee_id"),
        F.concat(F.lit("P-"), F.col("c_nationkey").cast("string")).alias("project_code"),
        F.concat(F.lit("CC-"), (F.col("o_orderkey") % 97 + 1).cast("string")).alias("cost_centre"),
        hours.alias("hours_logged"),
        rate.alias("rate_per_hour"),
        (hours * rate).cast("decimal(18,2)").alias("cost_inr"),
    )


def dim_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Governed projects: one per nation, segment = region name."""
    nr = _nation_region(spark, sf_dir).where(~F.col("n_nationkey").isin(*UNMAPPED_NATIONS))
    return nr.select(
        F.concat(F.lit("P-"), F.col("n_nationkey").cast("string")).alias("project_code"),
        F.concat(F.lit("Project "), F.col("n_name")).alias("project_name"),
        F.col("r_name").alias("segment"),
        _currency(F.col("n_regionkey")).alias("billing_currency"),
        F.concat(F.lit("Client "), F.col("n_name")).alias("client_name"),
    )


def dim_cost_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Governed cost centres: one per supplier; grows with the data, so it is
    joined with a size-checked broadcast or a shuffle join."""
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey") \
        .where(~F.col("s_suppkey").isin(*UNMAPPED_SUPPLIERS))
    nr = sized_broadcast(_nation_region(spark, sf_dir), 10_000)
    j = sup.join(nr, sup.s_nationkey == nr.n_nationkey, "left")
    return j.select(
        F.concat(F.lit("CC-"), F.col("s_suppkey").cast("string")).alias("cost_centre"),
        F.concat(F.col("s_name"), F.lit(" Centre")).alias("cost_centre_name"),
        F.col("n_name").alias("location"),
        F.col("r_name").alias("country"),
    )

"""The ledger model over one data directory: sources -> staging -> conversion ->
mapping -> marts, as DataFrames built once per (session, directory)."""

from __future__ import annotations

import os
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ledgerspark.operators import convert, marts, staging
from ledgerspark.session import checkpoint_dir
from ledgerspark.sources import bronze_files, narratives, testdata

_CACHE: dict[tuple[str, str, bool], "Ledger"] = {}


class Ledger:
    """Tables of the daily build for one directory of driver tables.

    With ``persist=True`` (``materialize``) every table read by several
    consumers — staged inputs, mapped postings, marts and the derived
    narrative / review tables — is written once as parquet under the session's
    shared ``spark.checkpoint.dir`` and read back. Later queries then start
    from a short plan over a columnar table (column pruning and filter
    pushdown still apply), the lineage is cut, and a lost executor never forces
    a recomputation from the raw sources. Without it, everything stays lazy.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, persist: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir
        self.persist = persist
        self._root = os.path.join(checkpoint_dir(spark), f"ledger-{uuid.uuid4().hex[:12]}")

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str, persist: bool = False) -> "Ledger":
        key = (spark.sparkContext.applicationId, sf_dir, persist)
        if key not in _CACHE:
            _CACHE[key] = cls(spark, sf_dir, persist)
        return _CACHE[key]

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        if not self.persist:
            return df
        path = os.path.join(self._root, name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def derived(self, name: str, build, keep: bool = False) -> DataFrame:
        """A derived table built once per ledger; ``keep`` writes it as a table (many readers)."""
        memo = self.__dict__.setdefault("_derived", {})
        if name not in memo:
            df = build()
            memo[name] = self._keep(df, name) if keep else df
        return memo[name]

    def table(self, name: str) -> DataFrame:
        return testdata.read_table(self.spark, self.sf_dir, name)

    # bronze
    @cached_property
    def bronze_gl(self) -> DataFrame:
        return testdata.gl_entries(self.spark, self.sf_dir)

    @cached_property
    def bronze_fx(self) -> DataFrame:
        return testdata.fx_rates(self.spark, self.sf_dir)

    @cached_property
    def bronze_payroll(self) -> DataFrame:
        return testdata.payroll_entries(self.spark, self.sf_dir)

    @cached_property
    def dim_projects(self) -> DataFrame:
        return self._keep(testdata.dim_projects(self.spark, self.sf_dir), "dim_projects")

    @cached_property
    def dim_cost_centres(self) -> DataFrame:
        return self._keep(testdata.dim_cost_centres(self.spark, self.sf_dir), "dim_cost_centres")

    # staging
    @cached_property
    def stg_gl(self) -> DataFrame:
        return self._keep(staging.stage_gl(self.bronze_gl), "stg_erp_gl_entries")

    @cached_property
    def stg_fx(self) -> DataFrame:
        return self._keep(staging.stage_fx(self.bronze_fx), "stg_fx_rates")

    @cached_property
    def stg_fx_gappy(self) -> DataFrame:
        """The staged rates with some (date, currency) pairs missing, as a late or partial rate delivery leaves them."""
        return self._keep(self.stg_fx.where(~testdata.missing_rate()), "stg_fx_rates_gappy")

    @cached_property
    def int_mapped_gappy(self) -> DataFrame:
        m = convert.map_dimensions(convert.fx_convert(self.stg_gl, self.stg_fx_gappy), self.dim_projects, self.dim_cost_centres)
        return self._keep(m, "int_entries_cost_centre_mapped_gappy")

    @cached_property
    def pnl_gappy(self) -> DataFrame:
        return self._keep(marts.pnl_summary(self.int_mapped_gappy), "mart_pnl_summary_gappy")

    @cached_property
    def stg_payroll(self) -> DataFrame:
        return self._keep(staging.stage_payroll(self.bronze_payroll), "stg_payroll_entries")

    # intermediate
    @cached_property
    def int_fx(self) -> DataFrame:
        return convert.fx_convert(self.stg_gl, self.stg_fx)

    @cached_property
    def int_mapped(self) -> DataFrame:
        return self._keep(self.mapped, "int_entries_cost_centre_mapped")

    @cached_property
    def mapped(self) -> DataFrame:
        """The mapped postings as marts read them: from the staged table, the columns they need, nothing wide written."""
        return convert.map_dimensions(self.int_fx, self.dim_projects, self.dim_cost_centres)

    # marts
    @cached_property
    def pnl(self) -> DataFrame:
        return self._keep(marts.pnl_summary(self.mapped), "mart_pnl_summary")

    @cached_property
    def revenue_trends(self) -> DataFrame:
        return self._keep(marts.revenue_trends(self.mapped), "mart_revenue_trends")

    @cached_property
    def cost_analysis(self) -> DataFrame:
        return self._keep(marts.cost_analysis(self.mapped), "mart_cost_analysis")

    @cached_property
    def variance(self) -> DataFrame:
        return self._keep(marts.variance_analysis(self.pnl), "mart_variance_analysis")

    @cached_property
    def dictionary(self) -> DataFrame:
        return marts.metric_dictionary(self.spark)

    @cached_property
    def narratives(self) -> DataFrame:
        return self._keep(narratives.narratives(self.pnl), "narratives")

    def path(self, name: str) -> str:
        """A folder of this ledger's own in the shared checkpoint folder."""
        return os.path.join(self._root, name)

    @cached_property
    def bronze_path(self) -> str:
        """The bronze tables as CSV files, written once: columns in various orders, some cells and lines bad."""
        path = self.path("bronze")
        bronze_files.write_bronze(self.bronze_gl, self.bronze_fx, self.bronze_payroll, path)
        return path

    @cached_property
    def corpus_path(self) -> str:
        """The documents as a folder of model files with sidecars, written once."""
        path = self.path("corpus")
        bronze_files.write_corpus(self.table("documents"), path)
        return path

    def models(self) -> dict[str, DataFrame]:
        """Every model of the build under its reference name (for column tests)."""
        return {
            "stg_erp_gl_entries": self.stg_gl, "stg_fx_rates": self.stg_fx,
            "stg_payroll_entries": self.stg_payroll, "int_entries_fx_converted": self.int_fx,
            "int_entries_cost_centre_mapped": self.int_mapped, "dim_cost_centres": self.dim_cost_centres,
            "dim_projects": self.dim_projects, "mart_pnl_summary": self.pnl,
            "mart_revenue_trends": self.revenue_trends, "mart_cost_analysis": self.cost_analysis,
            "mart_variance_analysis": self.variance, "mart_metric_dictionary": self.dictionary,
        }

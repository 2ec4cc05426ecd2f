"""The daily run as one Spark application.

source tests on the bronze text -> pre-build gates (G1-G3) -> staging -> FX conversion -> dimension mapping ->
marts written as tables -> post-build gates (G4-G6) on the written tables ->
CSV export. The run stops at the first failing gate; later work is never
launched.

Every materialized table goes to a directory the caller names (on a cluster
a shared filesystem, by default under the session's ``spark.checkpoint.dir``),
so later steps read written data instead of a long lineage, and a lost
executor only re-runs the tasks of the step in flight.

usage: python -m ledgerspark.plans.pipeline --sf-dir /root/testdata/sf0.01 --out /tmp/run
"""

from __future__ import annotations

import argparse
import os
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from ledgerspark.operators import checks, convert, gates, marts, publish, staging
from ledgerspark.session import write_back

MART_NAMES = ["mart_pnl_summary", "mart_revenue_trends", "mart_cost_analysis", "mart_variance_analysis",
              "mart_metric_dictionary"]


@dataclass
class Bronze:
    gl: DataFrame
    fx: DataFrame
    payroll: DataFrame
    dim_projects: DataFrame
    dim_cost_centres: DataFrame


@dataclass
class RunResult:
    passed: bool
    report: DataFrame
    tables: dict[str, str]
    source_tests: DataFrame | None = None


def build_and_write(spark: SparkSession, b: Bronze, out: str, lenient: bool = True) -> dict[str, str]:
    """Stage, convert, map, aggregate; write the mapped postings and every mart. Returns table paths."""
    gl = staging.stage_gl(b.gl, lenient=lenient)
    fx = staging.stage_fx(b.fx, lenient=lenient)
    mapped = convert.map_dimensions(convert.fx_convert(gl, fx), b.dim_projects, b.dim_cost_centres)
    paths = {"int_entries_cost_centre_mapped": os.path.join(out, "int_entries_cost_centre_mapped")}
    publish.write_mart(mapped, paths["int_entries_cost_centre_mapped"])
    m = spark.read.parquet(paths["int_entries_cost_centre_mapped"])
    pnl_path = os.path.join(out, "mart_pnl_summary")
    publish.write_mart(marts.pnl_summary(m), pnl_path)
    pnl = spark.read.parquet(pnl_path)
    built = {
        "mart_pnl_summary": None,
        "mart_revenue_trends": marts.revenue_trends(m),
        "mart_cost_analysis": marts.cost_analysis(m),
        "mart_variance_analysis": marts.variance_analysis(pnl),
        "mart_metric_dictionary": marts.metric_dictionary(spark),
    }
    paths["mart_pnl_summary"] = pnl_path
    for name, df in built.items():
        if df is not None:
            paths[name] = os.path.join(out, name)
            publish.write_mart(df, paths[name])
    return paths


def run_daily(spark: SparkSession, b: Bronze, out: str, min_rows: int = gates.ROW_COUNT_MIN,
              max_rows: int | None = None, export_csv: bool = True, block_on_sources: bool = False) -> RunResult:
    """Source tests, gates, build, gates, export. ``max_rows``: a ceiling for the raw tables' row counts (none by
    default). The source tests are reported; they stop the run only with ``block_on_sources``, as the gates after
    them look at the staged tables."""
    sources = checks.run_source_tests({"erp_gl_entries": b.gl, "payroll_entries": b.payroll, "fx_rates": b.fx})
    found = sources.collect()      # one row per declared test
    sources = spark.createDataFrame([tuple(r) for r in found], sources.schema)
    if block_on_sources and not all(r.passed for r in found):
        return RunResult(False, sources, {}, sources)
    # Staged once as written tables: the gates read them, the bronze is not computed again for each.
    gl_s, fx_s, pay_s = (write_back(staging.stage_gl(b.gl, True), "raw-gl"), write_back(staging.stage_fx(b.fx, True), "raw-fx"),
                         write_back(staging.stage_payroll(b.payroll, True), "raw-payroll"))
    pre = [("g1", lambda: gates.gate_g1(gl_s, min_rows, max_rows, b.gl.columns)), ("g2", lambda: gates.gate_g2(fx_s, gl_s)),
           ("g3", lambda: gates.gate_g3(pay_s, min_rows, max_rows, b.payroll.columns))]
    report = gates.run_gates(spark, pre)
    if not gates.gate_passed(report):
        return RunResult(False, report, {}, sources)
    paths = build_and_write(spark, replace(b, gl=gl_s, fx=fx_s, payroll=pay_s), out)
    t = {k: spark.read.parquet(v) for k, v in paths.items()}
    post = [("g4", lambda: gates.gate_g4(t["int_entries_cost_centre_mapped"], t["mart_pnl_summary"])),
            ("g5", lambda: gates.gate_g5(t["mart_pnl_summary"], t["mart_revenue_trends"], t["mart_cost_analysis"],
                                         t["mart_variance_analysis"], t["mart_metric_dictionary"])),
            ("g6", lambda: gates.gate_g6(t["mart_pnl_summary"], t["mart_metric_dictionary"]))]
    report = report.unionByName(gates.run_gates(spark, post))
    ok = gates.gate_passed(report)
    if ok and export_csv:
        for name in MART_NAMES:
            publish.export_csv(t[name], os.path.join(out, "csv", name))
    return RunResult(ok, report, paths, sources)


def bronze_from_testdata(spark: SparkSession, sf_dir: str) -> Bronze:
    from ledgerspark.sources import testdata as td
    return Bronze(td.gl_entries(spark, sf_dir), td.fx_rates(spark, sf_dir), td.payroll_entries(spark, sf_dir),
                  td.dim_projects(spark, sf_dir), td.dim_cost_centres(spark, sf_dir))


def bronze_from_csv(spark: SparkSession, root: str) -> Bronze:
    """The bronze tables from a folder of CSV files, as text."""
    from ledgerspark.sources.bronze import blank_to_null, read_csv_source
    read = lambda t: blank_to_null(read_csv_source(spark, root, t))
    return Bronze(read("erp_gl_entries"), read("fx_rates"), read("payroll_entries"), read("dim_projects"), read("dim_cost_centres"))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--out", default=None)
    ap.add_argument("--max-rows", type=int, default=None)
    a = ap.parse_args()
    from ledgerspark.session import get_spark, scratch_path
    spark = get_spark()
    out = a.out or scratch_path(spark, "daily_run")
    res = run_daily(spark, bronze_from_testdata(spark, a.sf_dir), out,
                    max_rows=a.max_rows)
    res.report.show(50, truncate=False)
    print("PASSED" if res.passed else "BLOCKED", out)


if __name__ == "__main__":
    main()

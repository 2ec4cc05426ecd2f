"""The ledger's tables on their way out: headline snippets, the published warehouse, run logs, CSV exports.

Each is made once per ledger, under its own folder, and read back from what was written.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.operators import narrative, publish
from ledgerspark.operators.warehouse import RunLog, Warehouse
from ledgerspark.plans.ledger import Ledger
from ledgerspark.sources import narratives

# Runs of the registered queries, the month before which the first publish knows nothing.
RUNS = [("opening", "2026-01-01 00:00:00"), ("closing", "2026-01-02 00:00:00")]
CUT = "1995-01-01"
SNIPPET_TYPE = "revenue_trends_headline"
SOURCE_MODEL = "ledger-narrative"


def headlines(lg: Ledger) -> DataFrame:
    """Card headlines from the one-line responses; an empty response gives none."""
    def build():
        return narrative.first_line_headlines(narratives.one_line_responses(lg.narratives), "narrative_id", "response")
    return lg.derived("card_headlines", build, keep=True)


def snippets(lg: Ledger) -> DataFrame:
    """The snippet table that cards read."""
    return headlines(lg).select(
        F.sha2(F.concat_ws(":", F.lit(SNIPPET_TYPE), "narrative_id"), 256).alias("snippet_id"),
        F.lit(RUNS[-1][1]).cast("timestamp").alias("generated_at"), F.lit(SNIPPET_TYPE).alias("snippet_type"),
        "snippet_text", "word_count", F.lit(SOURCE_MODEL).alias("source_model"))


def gold(lg: Ledger) -> dict[str, DataFrame]:
    """The six tables that are published."""
    return {"mart_pnl_summary": lg.pnl, "mart_revenue_trends": lg.revenue_trends, "mart_cost_analysis": lg.cost_analysis,
            "mart_variance_analysis": lg.variance, "mart_metric_dictionary": lg.dictionary, "ai_narrative_snippets": snippets(lg)}


def published(lg: Ledger) -> Warehouse:
    """A warehouse after two publishes: the marts of the first years, then everything. Repeating a run changes nothing."""
    w = Warehouse(lg.spark, lg.path("warehouse"))
    tables = gold(lg)
    early = {n: df.where(F.col("period_month") < F.lit(CUT).cast("date")) if "period_month" in df.columns else df for n, df in tables.items()}
    for (run, at), content in zip(RUNS, (early, tables)):
        w.publish(content, run, at)
    w.publish(tables, RUNS[0][0], RUNS[0][1])       # a retry of the first run
    return w


def snippet_log(lg: Ledger) -> DataFrame:
    """The snippets' run log: the early headlines in the first run, all in the second, each run tried twice."""
    log = RunLog(lg.spark, lg.path("snippet-log"))
    rows = headlines(lg).select("narrative_id", F.lit(SNIPPET_TYPE).alias("snippet_type"), "snippet_text", "word_count")
    early = rows.where(F.col("narrative_id") < CUT)
    for (run, at), content in zip(RUNS, (early, rows)):
        log.append(content, run, at, id_col="snippet_id", time_col="generated_at")
        log.append(content, run, at, id_col="snippet_id", time_col="generated_at")
    return log.read()


def profile(name: str, df: DataFrame, with_type: bool = True) -> DataFrame:
    """One row per column: its published type, its values that aren't null, and their total (hundredths of
    numbers, days of dates, seconds of times, characters of texts), from one aggregate."""
    def total(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.NumericType):
            return F.sum(F.round(c.cast("double") * 100, 0).cast("decimal(38,0)")).cast("long")
        if isinstance(f.dataType, T.BooleanType):
            return F.sum(c.cast("long"))
        if isinstance(f.dataType, T.DateType):
            return F.sum(F.datediff(c, F.lit("1970-01-01").cast("date"))).cast("long")
        if isinstance(f.dataType, T.TimestampType):
            return F.sum(F.unix_timestamp(c))
        return F.sum(F.length(c)).cast("long")
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = df.agg(F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.lit(kinds[f.name]).alias("column_type"), F.count(F.lit(1)).alias("n_rows"),
                                     F.count(F.col(f"`{f.name}`")).alias("n_values"), total(f).alias("total")) for f in df.schema.fields]).alias("r"))
    out = rows.select(F.lit(name).alias("table_name"), F.explode("r").alias("r")).select("table_name", "r.*")
    return out if with_type else out.drop("column_type")


def publish_round_trip(lg: Ledger) -> DataFrame:
    w = published(lg)
    return reduce(DataFrame.unionByName, [profile(name, w.read(name)) for name in gold(lg)])


def csv_round_trip(lg: Ledger) -> DataFrame:
    """The six tables exported as CSV and read back."""
    parts = []
    for name, df in gold(lg).items():
        path = lg.path(f"csv/{name}")
        publish.export_csv(df, path)
        parts.append(profile(name, publish.read_csv_export(lg.spark, path, df.schema), with_type=False))
    return reduce(DataFrame.unionByName, parts)

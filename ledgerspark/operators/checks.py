"""Declarative column tests, all decided by one aggregation.

Every row is turned into the (rule, key) pairs that matter to a rule: the key of a
uniqueness rule, an offending value, a key that must exist in another model, a mark
for a null. The pairs of all models, together with the parent keys of the rules
that name another model, are grouped once by (rule, key), rules being numbered
through all models, with map-side combine; a second aggregate over one row per rule counts the failing keys or rows.
A model is scanned once, whatever its rules are, and shuffled once; nothing is
broadcast, so parents may be of any size, and a key that fills a third of a
table meets as one row per task. A missing column gives a failing result row instead
of an analysis error.

Failure counts follow the usual data-test conventions: not_null counts rows,
unique and unique_combination count duplicated values (groups), accepted_values
counts distinct offending values (nulls are not offending), relationships count
child rows whose non-null key has no parent.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.sources.bronze import typed_cells

RESULT_COLUMNS = ["model", "test", "column_name", "failures", "passed"]


@dataclass(frozen=True)
class Rule:
    test: str                       # not_null | unique | accepted_values | relationships | unique_combination
    columns: tuple[str, ...]
    values: tuple[str, ...] = ()    # accepted_values given as literals
    ref: str | None = None          # relationships / accepted_values taken from another model
    ref_column: str | None = None


def not_null(c): return Rule("not_null", (c,))
def unique(c): return Rule("unique", (c,))
def accepted(c, *values): return Rule("accepted_values", (c,), tuple(values))
def accepted_from(c, ref, ref_column): return Rule("accepted_values", (c,), ref=ref, ref_column=ref_column)
def relationship(c, ref, ref_column): return Rule("relationships", (c,), ref=ref, ref_column=ref_column)
def unique_combination(*cs): return Rule("unique_combination", tuple(cs))


@dataclass
class ModelTests:
    model: str
    rules: list[Rule] = field(default_factory=list)


#: Rules whose failures are rows; those of the others are keys.
COUNTS_ROWS = ("not_null", "relationships")


def _key(*cols: F.Column) -> F.Column:
    """A key of any type as text; of several columns with their nulls, which are equal to each other."""
    return cols[0].cast("string") if len(cols) == 1 else F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def _pairs(base: int, df: DataFrame, rules: list[Rule], missing: set[int]) -> DataFrame | None:
    """(rule, key, parent) of every row and rule to which the row matters; a model's rules are numbered from ``base``."""
    pairs = []
    for i, r in enumerate(rules):
        if i in missing:
            continue
        cols = [F.col(f"`{c}`") for c in r.columns]
        c = cols[0]
        if r.test == "not_null":
            key = F.when(c.isNull(), F.lit(""))
        elif r.test == "accepted_values" and r.ref is None:
            key = F.when(~c.isin(*r.values), _key(c))
        elif r.test in ("unique", "accepted_values", "relationships"):
            key = _key(c)
        elif r.test == "unique_combination":
            key = F.coalesce(_key(*cols), F.lit(""))
        else:
            raise ValueError(f"unknown test {r.test}")
        pairs.append(F.struct(F.lit(base + i).alias("rule"), key.alias("key")))
    if not pairs:
        return None
    each = df.select(F.explode(F.filter(F.array(*pairs), lambda p: p["key"].isNotNull())).alias("p"))
    return each.select("p.*", F.lit(False).alias("parent"))


def _parents(base: int, rules: list[Rule], refs: dict[str, DataFrame], missing: set[int]) -> list[DataFrame]:
    """The keys that another model offers to the rules, marked as such."""
    out = []
    wanted: dict[tuple[str, str], list[int]] = {}
    for i, r in enumerate(rules):
        if r.ref is not None and i not in missing:
            wanted.setdefault((r.ref, r.ref_column), []).append(i)
    for (ref, column), numbers in wanted.items():
        c = F.col(f"`{column}`")
        out.append(refs[ref].where(c.isNotNull()).select(
            F.explode(F.array(*[F.lit(base + i) for i in numbers])).alias("rule"), _key(c).alias("key"),
            F.lit(True).alias("parent")))
    return out


def evaluate_models(models: dict[str, DataFrame], rules: dict[str, list[Rule]], refs: dict[str, DataFrame]) -> DataFrame:
    """Evaluate the rules of several models: one result row per rule, all from one grouping."""
    spark = next(iter(models.values())).sparkSession
    listed, frames = [], []
    for model, df in models.items():
        cols = set(df.columns)
        missing = {i for i, r in enumerate(rules[model]) if not set(r.columns) <= cols
                   or (r.ref is not None and r.ref_column not in refs[r.ref].columns)}
        base = len(listed)
        listed += [(model, i, base + i, r.test, ",".join(r.columns), i in missing, r.test in COUNTS_ROWS) for i, r in enumerate(rules[model])]
        own = _pairs(base, df, rules[model], missing)
        frames += ([own] if own is not None else []) + _parents(base, rules[model], refs, missing)
    listed_df = spark.createDataFrame(listed, "model string, rule_no long, rule int, test string, column_name string, missing boolean, by_row boolean")
    if frames:
        keys = reduce(DataFrame.unionByName, frames).groupBy("rule", "key").agg(
            F.count(F.when(~F.col("parent"), 1)).alias("n"), F.max("parent").alias("has_parent"))
        # What a key counts for depends on its rule's kind: the rules are a short list, known when the plan is made.
        kind = F.element_at(F.create_map(*[F.lit(x) for _, _, n, test, *_ in listed for x in (n, test)]), F.col("rule"))
        orphan = ~F.col("has_parent") & (F.col("n") > 0)
        failing = (F.when(F.col("kind").isin("unique", "unique_combination"), (F.col("n") > 1).cast("long"))
                   .when(F.col("kind") == "not_null", F.col("n")).when(F.col("kind") == "relationships", F.when(orphan, F.col("n")).otherwise(0))
                   .otherwise(orphan.cast("long")))
        found = keys.withColumn("kind", kind).groupBy("rule").agg(F.sum(failing).alias("failures"))
        listed_df = listed_df.join(found, "rule", "left")
    else:
        listed_df = listed_df.withColumn("failures", F.lit(None).cast("long"))
    failures = F.when(~F.col("missing"), F.coalesce("failures", F.lit(0))).cast("long")
    return listed_df.select("model", "rule_no", "test", "column_name", failures.alias("failures")).withColumn(
        "passed", F.coalesce(F.col("failures") == 0, F.lit(False)))


def run_model_tests(model: str, df: DataFrame, rules: list[Rule], refs: dict[str, DataFrame]) -> DataFrame:
    """Evaluate ``rules`` on one model; one result row per rule."""
    return evaluate_models({model: df}, {model: rules}, refs)


# The column tests declared on the reference's models (74).
CURRENCIES = ("INR", "USD", "EUR", "GBP", "AED")
MODEL_RULES: dict[str, list[Rule]] = {
    "stg_erp_gl_entries": [unique("entry_id"), not_null("entry_id"), not_null("entry_date"),
                           not_null("account_type"), accepted("account_type", "Revenue", "COGS", "OpEx"),
                           accepted("currency", *CURRENCIES), not_null("amount")],
    "stg_fx_rates": [not_null("rate_date"), not_null("from_currency"),
                     accepted("from_currency", "USD", "EUR", "GBP", "AED"), not_null("to_currency"),
                     accepted("to_currency", "INR"), not_null("rate"),
                     unique_combination("rate_date", "from_currency")],
    "stg_payroll_entries": [unique("allocation_id"), not_null("allocation_id"), not_null("allocation_date"),
                            not_null("employee_id"), not_null("project_code"), not_null("hours_logged"),
                            not_null("cost_inr")],
    "int_entries_fx_converted": [unique("entry_id"), not_null("entry_id"), not_null("entry_date"),
                                 not_null("source_currency"), accepted("source_currency", *CURRENCIES),
                                 not_null("source_amount"), not_null("fx_rate"), not_null("amount_inr"),
                                 accepted("reporting_currency", "INR")],
    "int_entries_cost_centre_mapped": [unique("entry_id"), not_null("entry_id"), not_null("entry_date"),
                                       not_null("project_code"),
                                       relationship("project_code", "dim_projects", "project_code"),
                                       not_null("cost_centre"),
                                       relationship("cost_centre", "dim_cost_centres", "cost_centre"),
                                       not_null("amount_inr"), not_null("is_orphan_project"),
                                       not_null("is_orphan_cost_centre")],
    "dim_cost_centres": [unique("cost_centre"), not_null("cost_centre")],
    "dim_projects": [unique("project_code"), not_null("project_code")],
    # segment values are the governed segments of the project dimension
    "mart_pnl_summary": [not_null("period_month"), not_null("segment"),
                         accepted_from("segment", "dim_projects", "segment"),
                         not_null("revenue"), not_null("cogs"), not_null("gross_margin"), not_null("opex"),
                         not_null("operating_income"), not_null("entry_count")],
    "mart_revenue_trends": [not_null("period_month"), not_null("segment"), not_null("project_code"),
                            not_null("revenue_inr"), not_null("entry_count")],
    "mart_cost_analysis": [not_null("period_month"), not_null("segment"), not_null("cost_centre"),
                           not_null("account_type"), accepted("account_type", "COGS", "OpEx"),
                           not_null("cost_inr"), not_null("entry_count")],
    "mart_variance_analysis": [not_null("period_month"), not_null("segment"), not_null("revenue"),
                               not_null("operating_income"), not_null("is_material_variance")],
    "mart_metric_dictionary": [unique("metric_key"), not_null("metric_key"), not_null("metric_name"),
                               not_null("calculation_logic")],
}


# The tests declared on the bronze sources (11); the reference excludes them from
# automated runs, so they are not part of ``run_all_model_tests`` by default.
SOURCE_RULES: dict[str, list[Rule]] = {
    "erp_gl_entries": [unique("entry_id"), not_null("entry_id"), not_null("entry_date"), not_null("amount")],
    "payroll_entries": [unique("allocation_id"), not_null("allocation_id"), not_null("allocation_date"),
                        not_null("employee_id")],
    "fx_rates": [not_null("rate_date"), not_null("from_currency"), not_null("rate")],
}


def run_all_model_tests(models: dict[str, DataFrame], rules: dict[str, list[Rule]] = MODEL_RULES) -> DataFrame:
    """All rules of all models at hand, in one job."""
    return evaluate_models({m: models[m] for m in rules if m in models}, rules, models)


def run_source_tests(sources: dict[str, DataFrame], rules: dict[str, list[Rule]] = SOURCE_RULES) -> DataFrame:
    """The bronze sources' tests over their text as it was read.

    A cell of a typed column that is blank or doesn't fit its type has no value, so it is a counted failing row
    of its column's not_null test before staging ever casts it.
    """
    return run_all_model_tests({name: typed_cells(df, name) for name, df in sources.items()}, rules).withColumnRenamed("model", "source")

"""Quality gates G1-G6 and the gate runner.

Each gate returns one row per check: (gate, check_no, check, severity, passed,
detail). All checks of a gate over one table are fused into one aggregation
(the uniqueness checks share one grouped pass with the row checks), and the
per-table results are combined with a tagged union plus one final aggregate —
no cross join, one Spark job per gate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.functions.num import MONEY_SUM
from ledgerspark.operators import windows
from ledgerspark.operators.checks import CURRENCIES

GATE_COLUMNS = ["gate", "check_no", "check", "severity", "passed", "detail"]

# Fixed values of the gates (must equal the reference's).
GL_REQUIRED_COLUMNS = ["entry_id", "entry_date", "project_code", "project_name", "segment", "cost_centre",
                       "account_code", "account_name", "account_type", "currency", "amount", "description"]
ACCOUNT_TYPES = ["Revenue", "COGS", "OpEx"]
PAYROLL_REQUIRED_COLUMNS = ["allocation_id", "allocation_date", "employee_id", "project_code", "cost_centre",
                            "hours_logged", "rate_per_hour", "cost_inr"]
MART_MODELS = ["mart_pnl_summary", "mart_revenue_trends", "mart_cost_analysis", "mart_variance_analysis"]
REQUIRED_METRIC_KEYS = ["revenue", "cogs", "gross_margin", "gross_margin_pct", "opex", "operating_income",
                        "operating_margin_pct", "revenue_mom_change", "cost_mom_change", "oi_variance_pct",
                        "is_material_variance"]
ROW_COUNT_MIN = 10
TOLERANCE = 0.01


def _s(c) -> F.Column:
    return F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"), F.lit("None"))


def _check(no: int, name: str, passed, detail, severity: str = "hard") -> F.Column:
    return F.struct(F.lit(no).cast("long").alias("check_no"), F.lit(name).alias("check"),
                    F.lit(severity).alias("severity"),
                    F.coalesce(passed if isinstance(passed, F.Column) else F.lit(passed), F.lit(False)).alias("passed"),
                    (detail if isinstance(detail, F.Column) else F.lit(detail)).alias("detail"))


def _emit(gate: str, row: DataFrame, checks: list[F.Column], keep: tuple[str, ...] = ()) -> DataFrame:
    return row.select(*keep, F.explode(F.array(*checks)).alias("c")).select(*keep, F.lit(gate).alias("gate"), "c.*")


def _one_row(frames: list[DataFrame]) -> DataFrame:
    """Combine 1-row frames with distinct columns into one row (tagged union + max)."""
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return u.agg(*[F.max(c).alias(c) for c in u.columns])


def _count_if(cond) -> F.Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def _g1_key_stats(gl: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Per-entry_id counts behind every G1 check (one grouped pass; partial aggregation)."""
    cols = set(gl.columns)
    key = F.col("entry_id") if "entry_id" in cols else F.lit(None).cast("string")
    return gl.groupBy(*by, key.alias("_id")).agg(
        F.count(F.lit(1)).alias("n"),
        *[_count_if(F.col(c).isNull()).alias(f"null_{c}") if c in cols else F.lit(None).cast("long").alias(f"null_{c}")
          for c in ("entry_date", "amount")],
        (_count_if(F.col("account_type").isNotNull() & ~F.col("account_type").isin(*ACCOUNT_TYPES))
         if "account_type" in cols else F.lit(None).cast("long")).alias("bad_type"),
        (_count_if(F.col("currency").isNotNull() & ~F.col("currency").isin(*CURRENCIES))
         if "currency" in cols else F.lit(None).cast("long")).alias("bad_ccy"))


def _g1_totals(per_key: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One row of G1 totals (per ``by`` group); every column is a sum over keys (additive)."""
    return per_key.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("_id").isNotNull() & (F.col("n") > 1), F.col("n"))), F.lit(0)).cast("long").alias("dups"),
        F.coalesce(F.sum(F.when(F.col("_id").isNull(), F.col("n"))), F.lit(0)).cast("long").alias("null_id"),
        F.coalesce(F.sum("null_entry_date"), F.lit(0)).cast("long").alias("null_date"),
        F.coalesce(F.sum("null_amount"), F.lit(0)).cast("long").alias("null_amount"),
        F.coalesce(F.sum("bad_type"), F.lit(0)).cast("long").alias("bad_type"),
        F.coalesce(F.sum("bad_ccy"), F.lit(0)).cast("long").alias("bad_ccy"))


def _in_range(rows: F.Column, min_rows: int, max_rows: int | None) -> F.Column:
    """At least ``min_rows``, and at most ``max_rows`` where a ceiling is given (none by default: tables grow)."""
    low = rows >= min_rows
    return low if max_rows is None else low & (rows <= max_rows)


def _g1_report(a: DataFrame, columns: list[str], min_rows: int, max_rows: int | None,
               keep: tuple[str, ...] = ()) -> DataFrame:
    cols = set(columns)
    missing = [c for c in GL_REQUIRED_COLUMNS if c not in cols]
    extra = sorted(cols - set(GL_REQUIRED_COLUMNS))
    cols_ok = not missing and not extra
    col_detail = f"columns={len(cols)}" if cols_ok else f"missing={missing} extra={extra}"

    def colcheck(no, name, c, value, prefix):
        if c not in cols:
            return _check(no, name, False, "column missing")
        return _check(no, name, F.col(value) == 0, F.concat(F.lit(prefix), _s(value)))

    rows = F.col("rows")
    return _emit("g1", a, [
        _check(1, "row count in range", _in_range(rows, min_rows, max_rows), F.concat(F.lit("rows="), _s("rows"))),
        _check(2, "columns match set", cols_ok, col_detail),
        colcheck(3, "entry_id unique", "entry_id", "dups", "duplicates="),
        colcheck(4, "entry_id not null", "entry_id", "null_id", "nulls="),
        colcheck(5, "entry_date not null", "entry_date", "null_date", "nulls="),
        colcheck(6, "amount not null", "amount", "null_amount", "nulls="),
        colcheck(7, "account_type in set", "account_type", "bad_type", "unexpected="),
        colcheck(8, "currency in set", "currency", "bad_ccy", "unexpected="),
    ], keep)


def gate_g1(gl: DataFrame, min_rows: int = ROW_COUNT_MIN, max_rows: int | None = None,
            columns: list[str] | None = None) -> DataFrame:
    """Raw GL completeness: 8 checks over the ledger, one grouped pass on entry_id.

    ``columns``: the raw table's columns where ``gl`` is its staged form (staging drops
    extra columns and fills absent ones).
    """
    return _g1_report(_g1_totals(_g1_key_stats(gl)), columns or gl.columns, min_rows, max_rows)


def g1_totals(gl: DataFrame) -> DataFrame:
    """G1's additive totals of a ledger (one row)."""
    return _g1_totals(_g1_key_stats(gl))


def gate_g2(fx: DataFrame, gl: DataFrame | None = None, base: str = "INR",
            pairs: DataFrame | None = None) -> DataFrame:
    """FX coverage: rates present, positive, not null, and a rate for every foreign posting date.

    ``pairs`` (the ledger's distinct foreign (entry_date, currency), from
    ``topk.foreign_pairs``) may be given instead of ``gl`` when several rate
    tables are checked against the same ledger.
    """
    from ledgerspark.operators.topk import fx_coverage_gaps
    f = fx.agg(F.count(F.lit(1)).alias("fx_rows"),
               _count_if(F.col("rate") <= 0).alias("non_positive"),
               _count_if(F.col("rate").isNull()).alias("null_rates"))
    gaps = fx_coverage_gaps(gl, fx, base, pairs=pairs).agg(F.count(F.lit(1)).alias("missing_pairs"))
    a = _one_row([f, gaps])
    return _emit("g2", a, [
        _check(1, "fx_rates row count > 0", F.col("fx_rows") > 0, F.concat(F.lit("rows="), _s("fx_rows"))),
        _check(2, "all rates positive", F.col("non_positive") == 0, F.concat(F.lit("non_positive="), _s("non_positive"))),
        _check(3, "no null rates", F.col("null_rates") == 0, F.concat(F.lit("nulls="), _s("null_rates"))),
        _check(4, "all GL dates have FX rates", F.col("missing_pairs") == 0,
               F.concat(F.lit("missing_pairs="), _s("missing_pairs"))),
    ])


def _g3_key_stats(payroll: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    cols = set(payroll.columns)
    key = F.col("allocation_id") if "allocation_id" in cols else F.lit(None).cast("string")

    def cnt(c, cond):
        return _count_if(cond(F.col(c))) if c in cols else F.lit(None).cast("long")

    return payroll.groupBy(*by, key.alias("_id")).agg(
        F.count(F.lit(1)).alias("n"),
        cnt("employee_id", lambda c: c.isNull()).alias("null_emp"),
        cnt("hours_logged", lambda c: c <= 0).alias("bad_hours"),
        cnt("cost_inr", lambda c: c <= 0).alias("bad_cost"))


def _g3_totals(per_key: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One row of G3 totals (per ``by`` group); every column is a sum over keys (additive)."""
    return per_key.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("dupes"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("null_emp", "bad_hours", "bad_cost")])


def _g3_report(a: DataFrame, columns: list[str], min_rows: int, max_rows: int | None,
               keep: tuple[str, ...] = ()) -> DataFrame:
    cols = set(columns)
    missing = [c for c in PAYROLL_REQUIRED_COLUMNS if c not in cols]

    def colcheck(no, name, c, value, prefix):
        if c not in cols:
            return _check(no, name, False, "column missing")
        return _check(no, name, F.col(value) == 0, F.concat(F.lit(prefix), _s(value)))

    rows = F.col("rows")
    return _emit("g3", a, [
        _check(1, "row count in range", _in_range(rows, min_rows, max_rows), F.concat(F.lit("rows="), _s("rows"))),
        _check(2, "all columns present", not missing, f"missing={missing}"),
        colcheck(3, "allocation_id unique", "allocation_id", "dupes", "dupes="),
        colcheck(4, "no null employee_id", "employee_id", "null_emp", "nulls="),
        colcheck(5, "hours_logged positive", "hours_logged", "bad_hours", "non_positive="),
        colcheck(6, "cost_inr positive", "cost_inr", "bad_cost", "non_positive="),
    ], keep)


def gate_g3(payroll: DataFrame, min_rows: int = ROW_COUNT_MIN, max_rows: int | None = None,
            columns: list[str] | None = None) -> DataFrame:
    """Payroll completeness: 6 checks, one grouped pass on allocation_id (nulls count as equal);
    ``columns`` as in ``gate_g1``."""
    return _g3_report(g3_totals(payroll), columns or payroll.columns, min_rows, max_rows)


def g3_totals(payroll: DataFrame) -> DataFrame:
    """G3's additive totals of a payroll table (one row)."""
    return _g3_totals(_g3_key_stats(payroll))


def _deltas(stats, totals, base_totals: DataFrame, changes: list[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    """Totals of several changed tables at once, one row per tag.

    All ``before`` / ``after`` row sets are stacked with a tag and a sign and
    grouped once (per tag, sign and key, then per tag, sign); the base totals
    are added to every tag by ``explode`` over the tag list. Every total is a
    sum, so ``sum(sign * total)`` per tag is the changed table's total.
    """
    cols = [c for c in changes[0][2].columns]
    parts = []
    for tag, before, after in changes:
        parts.append(before.select(F.lit(tag).alias("_tag"), F.lit(-1).alias("_sign"), *cols))
        parts.append(after.select(F.lit(tag).alias("_tag"), F.lit(1).alias("_sign"), *cols))
    stacked = reduce(DataFrame.unionByName, parts)
    t = totals(stats(stacked, ("_tag", "_sign")), ("_tag", "_sign"))
    names = base_totals.columns
    b = base_totals.select(F.explode(F.array(*[F.lit(tag) for tag, _, _ in changes])).alias("_tag"),
                           F.lit(1).alias("_sign"), *names)
    u = t.unionByName(b)
    return u.groupBy("_tag").agg(*[F.coalesce(F.sum(F.col(c) * F.col("_sign")), F.lit(0)).cast("long").alias(c)
                                   for c in names])


def gate_g1_deltas(base_totals: DataFrame, changes: list[tuple[str, DataFrame, DataFrame]],
                   min_rows: int = ROW_COUNT_MIN, max_rows: int | None = None) -> DataFrame:
    """G1 of several tables that differ from a base ledger only in the rows of a few entry_ids, in one grouped pass.

    Of each (tag, before, after) change, ``before`` holds every base row with those entry_ids, ``after`` every row
    with them in the changed ledger. All totals are sums over entry_id groups, so a changed table's are base -
    before + after. The report carries a ``_tag`` column.
    """
    a = _deltas(_g1_key_stats, _g1_totals, base_totals, changes)
    return _g1_report(a, changes[0][2].columns, min_rows, max_rows, keep=("_tag",))


def gate_g3_deltas(base_totals: DataFrame, changes: list[tuple[str, DataFrame, DataFrame]],
                   min_rows: int = ROW_COUNT_MIN, max_rows: int | None = None) -> DataFrame:
    """G3 likewise, by allocation_id."""
    a = _deltas(_g3_key_stats, _g3_totals, base_totals, changes)
    return _g3_report(a, changes[0][2].columns, min_rows, max_rows, keep=("_tag",))


def gate_g4(mapped: DataFrame, pnl: DataFrame) -> DataFrame:
    """P&L consistency: mart totals and counts reconcile with the mapped postings; identities hold."""
    src = mapped.agg(F.round(F.sum("amount_inr"), 2).cast(MONEY_SUM).alias("src_total"),
                     F.count(F.lit(1)).alias("src_count"))
    r, c, o = F.col("revenue"), F.col("cogs"), F.col("opex")
    mrt = pnl.agg(F.round(F.sum(r + c + o), 2).cast(MONEY_SUM).alias("mart_total"),
                  F.sum("entry_count").cast("long").alias("mart_count"),
                  _count_if(F.col("operating_income").isNull()).alias("null_oi"),
                  _count_if(F.abs(F.col("gross_margin") - (r + c)) > TOLERANCE).alias("gm_bad"),
                  _count_if(F.abs(F.col("operating_income") - (r + c + o)) > TOLERANCE).alias("oi_bad"))
    a = _one_row([src, mrt]).withColumn(
        "diff", F.abs(F.col("src_total") - F.col("mart_total")).cast(MONEY_SUM))
    return _emit("g4", a, [
        _check(1, "total INR reconciliation", F.col("diff") < TOLERANCE,
               F.concat(F.lit("source="), _s("src_total"), F.lit(" mart="), _s("mart_total"),
                        F.lit(" diff="), _s("diff"))),
        _check(2, "entry count reconciliation", F.col("src_count") == F.col("mart_count"),
               F.concat(F.lit("source="), _s("src_count"), F.lit(" mart="), _s("mart_count"))),
        _check(3, "no null operating_income", F.col("null_oi") == 0, F.concat(F.lit("nulls="), _s("null_oi"))),
        _check(4, "gross_margin = revenue + cogs", F.col("gm_bad") == 0, F.concat(F.lit("mismatches="), _s("gm_bad"))),
        _check(5, "operating_income = revenue + cogs + opex", F.col("oi_bad") == 0,
               F.concat(F.lit("mismatches="), _s("oi_bad"))),
    ])


def gate_g5(pnl: DataFrame, trends: DataFrame, cost: DataFrame, variance: DataFrame,
            dictionary: DataFrame) -> DataFrame:
    """Cross-mart consistency: revenue, cost, segment sets, dictionary coverage."""
    p = pnl.agg(F.round(F.sum("revenue"), 2).cast(MONEY_SUM).alias("pnl_rev"),
                F.round(F.sum(F.abs("cogs") + F.abs("opex")), 2).cast(MONEY_SUM).alias("pnl_cost"))
    t = trends.agg(F.round(F.sum("revenue_inr"), 2).cast(MONEY_SUM).alias("trend_rev"))
    c = cost.agg(F.round(F.sum("cost_inr"), 2).cast(MONEY_SUM).alias("cost_mart"))
    segs = (pnl.select("segment", F.lit(1).alias("in_p"), F.lit(0).alias("in_v"))
            .unionByName(variance.select("segment", F.lit(0).alias("in_p"), F.lit(1).alias("in_v")))
            .groupBy("segment").agg(F.max("in_p").alias("p"), F.max("in_v").alias("v"))
            .agg(_count_if(F.col("v") == 0).alias("pnl_only"), _count_if(F.col("p") == 0).alias("var_only")))
    spark = pnl.sparkSession
    expected = spark.createDataFrame([(m,) for m in MART_MODELS], "source_model string")
    dmiss = (expected.join(dictionary.select("source_model").distinct(), "source_model", "left_anti")
             .agg(F.count(F.lit(1)).alias("dict_missing")))
    a = _one_row([p, t, c, segs, dmiss]).select(
        "*", F.abs(F.col("pnl_rev") - F.col("trend_rev")).cast(MONEY_SUM).alias("d_rev"),
        F.abs(F.col("pnl_cost") - F.col("cost_mart")).cast(MONEY_SUM).alias("d_cost"))
    return _emit("g5", a, [
        _check(1, "revenue: pnl vs trends", F.col("d_rev") < TOLERANCE,
               F.concat(F.lit("pnl="), _s("pnl_rev"), F.lit(" trends="), _s("trend_rev"), F.lit(" diff="), _s("d_rev"))),
        _check(2, "costs: pnl vs cost_analysis", F.col("d_cost") < TOLERANCE,
               F.concat(F.lit("pnl="), _s("pnl_cost"), F.lit(" cost_mart="), _s("cost_mart"),
                        F.lit(" diff="), _s("d_cost"))),
        _check(3, "segments match across marts", (F.col("pnl_only") == 0) & (F.col("var_only") == 0),
               F.concat(F.lit("pnl_only="), _s("pnl_only"), F.lit(" var_only="), _s("var_only"))),
        _check(4, "metric dict covers all marts", F.col("dict_missing") == 0,
               F.concat(F.lit("missing="), _s("dict_missing"))),
    ])


def gate_g6(pnl: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Hard metric checks plus the (warning-only) operating-margin drift."""
    gm, om = F.col("gross_margin_pct"), F.col("operating_margin_pct")
    p = pnl.agg(_count_if(~gm.between(-100, 100) | ~om.between(-100, 100)).alias("out_of_range"),
                _count_if(F.col("revenue") < 0).alias("negative"))
    spark = pnl.sparkSession
    req = spark.createDataFrame([(k,) for k in REQUIRED_METRIC_KEYS], "metric_key string")
    kmiss = (req.join(dictionary.select("metric_key").distinct(), "metric_key", "left_anti")
             .agg(F.count(F.lit(1)).alias("keys_missing")))
    drift = windows.margin_drift(pnl).agg(_count_if(F.col("is_drift_warning")).alias("warnings"))
    a = _one_row([p, kmiss, drift])
    return _emit("g6", a, [
        _check(1, "percentage metrics within [-100, 100]", F.col("out_of_range") == 0,
               F.concat(F.lit("out_of_range="), _s("out_of_range"))),
        _check(2, "revenue never negative", F.col("negative") == 0, F.concat(F.lit("negative="), _s("negative"))),
        _check(3, "all governed metrics still defined", F.col("keys_missing") == 0,
               F.concat(F.lit("missing="), _s("keys_missing"))),
        _check(4, "operating margin drift", F.lit(True), F.concat(F.lit("warnings="), _s("warnings")), "warning"),
    ])


def gate_passed(report: DataFrame) -> bool:
    """Action: a gate passes when all its hard checks pass."""
    row = report.agg(F.sum(F.when((F.col("severity") == "hard") & ~F.col("passed"), 1).otherwise(0)).alias("f")).first()
    return (row["f"] or 0) == 0


def run_gates(spark: SparkSession, gates: list[tuple[str, callable]]) -> DataFrame:
    """Run gates in order and stop at the first failing one; later gates are never launched.

    Each gate's report is a handful of rows, so collecting it to decide whether
    to go on is cheap; the returned report is built from those rows.
    """
    rows = []
    for _, build in gates:
        rep = build()
        got = rep.collect()
        rows.extend(got)
        if any(r["severity"] == "hard" and not r["passed"] for r in got):
            break
    schema = "gate string, check_no long, check string, severity string, passed boolean, detail string"
    return spark.createDataFrame([tuple(r) for r in rows], schema)

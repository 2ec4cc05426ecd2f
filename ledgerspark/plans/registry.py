"""Registered queries: key -> (spark, sf_dir) -> DataFrame, and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.plans import oracle as O
from ledgerspark.plans.ledger import Ledger

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, oracle_sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if oracle_sql is not None:
            ORACLE[key] = oracle_sql
        return fn
    return deco


def L(spark: SparkSession, sf_dir: str) -> Ledger:
    """The session's ledger for ``sf_dir``; tables with many readers (staged inputs, mapped
    postings, marts, derived narrative/review tables) are written once under the shared
    checkpoint folder and read back, which cuts their lineage."""
    return Ledger.of(spark, sf_dir, persist=True)


# ---------------------------------------------------------------- staging and build
@register("stg_gl", O.sql("SELECT * FROM stg_gl", "stg_gl"))
def q_stg_gl(spark, sf_dir):
    return L(spark, sf_dir).stg_gl


@register("stg_fx", O.sql("SELECT * FROM stg_fx", "stg_fx"))
def q_stg_fx(spark, sf_dir):
    return L(spark, sf_dir).stg_fx


@register("stg_payroll", O.sql("SELECT * FROM stg_payroll", "stg_payroll"))
def q_stg_payroll(spark, sf_dir):
    return L(spark, sf_dir).stg_payroll


@register("int_fx_converted", O.sql("SELECT * FROM int_fx", "int_fx"))
def q_int_fx(spark, sf_dir):
    return L(spark, sf_dir).int_fx


@register("int_mapped", O.sql("SELECT * FROM int_mapped", "int_mapped"))
def q_int_mapped(spark, sf_dir):
    return L(spark, sf_dir).int_mapped


@register("mart_pnl_summary", O.sql("SELECT * FROM pnl", "pnl"))
def q_pnl(spark, sf_dir):
    return L(spark, sf_dir).pnl


@register("mart_revenue_trends", O.sql("SELECT * FROM revenue_trends", "revenue_trends"))
def q_revenue_trends(spark, sf_dir):
    return L(spark, sf_dir).revenue_trends


@register("mart_cost_analysis", O.sql("SELECT * FROM cost_analysis", "cost_analysis"))
def q_cost_analysis(spark, sf_dir):
    return L(spark, sf_dir).cost_analysis


@register("mart_variance_analysis", O.sql("SELECT * FROM variance", "variance"))
def q_variance(spark, sf_dir):
    return L(spark, sf_dir).variance


# ---------------------------------------------------------------- measures and projections
from ledgerspark.operators import measures as M  # noqa: E402
from ledgerspark.operators import topk as T  # noqa: E402
from ledgerspark.operators import windows as W  # noqa: E402


@register("pnl_crore", O.sql("""SELECT period_month, segment, round(revenue / 10000000, 2) AS revenue_cr,
  round(cogs / 10000000, 2) AS cogs_cr, round(gross_margin / 10000000, 2) AS gross_margin_cr, gross_margin_pct,
  round(opex / 10000000, 2) AS opex_cr, round(operating_income / 10000000, 2) AS operating_income_cr,
  operating_margin_pct, entry_count FROM pnl""", "pnl"))
def q_pnl_crore(spark, sf_dir):
    return M.pnl_crore(L(spark, sf_dir).pnl)


@register("variance_context", O.sql("""SELECT period_month, segment, revenue_variance_pct, gm_variance_pct,
  oi_variance_pct, is_material_variance FROM variance""", "variance"))
def q_variance_context(spark, sf_dir):
    return M.variance_context(L(spark, sf_dir).variance)


@register("revenue_by_segment", O.sql("""SELECT period_month, segment, round(sum(revenue_inr) / 10000000, 2) AS revenue_cr
FROM revenue_trends GROUP BY period_month, segment""", "revenue_trends"))
def q_revenue_by_segment(spark, sf_dir):
    return M.revenue_by_segment(L(spark, sf_dir).revenue_trends)


@register("cost_by_type", O.sql("""SELECT period_month, segment, account_type, round(sum(cost_inr) / 10000000, 2) AS cost_cr
FROM cost_analysis GROUP BY period_month, segment, account_type""", "cost_analysis"))
def q_cost_by_type(spark, sf_dir):
    return M.cost_by_type(L(spark, sf_dir).cost_analysis)


@register("measures_any_grain", O.sql("""SELECT p.segment, p.total_revenue, p.total_cogs, p.total_gross_margin, p.total_opex,
  p.total_operating_income, c.total_cost, t.total_trend_revenue
FROM (SELECT segment, CAST(sum(revenue) AS DECIMAL(38,2)) AS total_revenue, CAST(sum(cogs) AS DECIMAL(38,2)) AS total_cogs,
        CAST(sum(gross_margin) AS DECIMAL(38,2)) AS total_gross_margin, CAST(sum(opex) AS DECIMAL(38,2)) AS total_opex,
        CAST(sum(operating_income) AS DECIMAL(38,2)) AS total_operating_income FROM pnl GROUP BY segment) p
LEFT JOIN (SELECT segment, CAST(sum(cost_inr) AS DECIMAL(38,2)) AS total_cost FROM cost_analysis GROUP BY segment) c
  ON p.segment IS NOT DISTINCT FROM c.segment
LEFT JOIN (SELECT segment, CAST(sum(revenue_inr) AS DECIMAL(38,2)) AS total_trend_revenue FROM revenue_trends GROUP BY segment) t
  ON p.segment IS NOT DISTINCT FROM t.segment""", "pnl", "cost_analysis", "revenue_trends"))
def q_measures_any_grain(spark, sf_dir):
    lg = L(spark, sf_dir)
    return M.base_measures(lg.pnl, lg.revenue_trends, lg.cost_analysis, ["segment"])


@register("margin_cube", O.sql("""SELECT period_month, segment, CAST(GROUPING(period_month, segment) AS BIGINT) AS grouping_id,
  CAST(sum(revenue) AS DECIMAL(38,2)) AS total_revenue, CAST(sum(gross_margin) AS DECIMAL(38,2)) AS total_gross_margin,
  CAST(sum(operating_income) AS DECIMAL(38,2)) AS total_operating_income,
  CASE WHEN sum(revenue) = 0 THEN NULL ELSE CAST(sum(gross_margin) AS DOUBLE) / CAST(sum(revenue) AS DOUBLE) END * 100 AS gross_margin_pct,
  CASE WHEN sum(revenue) = 0 THEN NULL ELSE CAST(sum(operating_income) AS DOUBLE) / CAST(sum(revenue) AS DOUBLE) END * 100 AS operating_margin_pct
FROM pnl GROUP BY CUBE (period_month, segment)""", "pnl"))
def q_margin_cube(spark, sf_dir):
    return M.margin_cube(L(spark, sf_dir).pnl)


def _sel(col: str, alias: str) -> str:
    return (f"CASE WHEN count(DISTINCT {col}) + max(CASE WHEN {col} IS NULL THEN 1 ELSE 0 END) = 1 "
            f"THEN max({col}) END AS {alias}")


@register("native_grain_selector", O.sql(f"""SELECT v.period_month, v.segment, v.oi_variance_pct, r.revenue_mom_pct, c.cost_mom_pct
FROM (SELECT period_month, segment, {_sel('oi_variance_pct', 'oi_variance_pct')} FROM variance GROUP BY 1, 2) v
LEFT JOIN (SELECT period_month, segment, {_sel('mom_change_pct', 'revenue_mom_pct')} FROM revenue_trends GROUP BY 1, 2) r
  ON v.period_month IS NOT DISTINCT FROM r.period_month AND v.segment IS NOT DISTINCT FROM r.segment
LEFT JOIN (SELECT period_month, segment, {_sel('mom_change_pct', 'cost_mom_pct')} FROM cost_analysis GROUP BY 1, 2) c
  ON v.period_month IS NOT DISTINCT FROM c.period_month AND v.segment IS NOT DISTINCT FROM c.segment""",
                                         "variance", "revenue_trends", "cost_analysis"))
def q_native_grain_selector(spark, sf_dir):
    lg = L(spark, sf_dir)
    return M.native_grain_selector(lg.variance, lg.revenue_trends, lg.cost_analysis, ["period_month", "segment"])


@register("prior_month_measure", O.sql("""SELECT c.period_month, c.segment, c.operating_income, p.operating_income AS prior_operating_income,
  CASE WHEN p.operating_income IS NULL OR p.operating_income = 0 THEN NULL
       ELSE CAST(c.operating_income - p.operating_income AS DOUBLE) / CAST(abs(p.operating_income) AS DOUBLE) END * 100 AS oi_change_pct
FROM (SELECT period_month, segment, CAST(sum(operating_income) AS DECIMAL(38,2)) AS operating_income FROM pnl GROUP BY 1, 2) c
LEFT JOIN (SELECT period_month, segment, CAST(sum(operating_income) AS DECIMAL(38,2)) AS operating_income FROM pnl GROUP BY 1, 2) p
  ON p.period_month = CAST(c.period_month - INTERVAL 1 MONTH AS DATE) AND c.segment IS NOT DISTINCT FROM p.segment""", "pnl"))
def q_prior_month_measure(spark, sf_dir):
    return M.prior_month_measure(L(spark, sf_dir).pnl, ["segment"])


@register("recon_pnl", O.sql("""SELECT s.source_total, m.mart_total, CAST(abs(s.source_total - m.mart_total) AS DECIMAL(38,2)) AS diff,
  s.source_count, m.mart_count, abs(s.source_total - m.mart_total) < 0.01 AS total_ok, s.source_count = m.mart_count AS count_ok
FROM (SELECT CAST(round(sum(amount_inr), 2) AS DECIMAL(38,2)) AS source_total, count(*) AS source_count FROM int_mapped) s,
     (SELECT CAST(round(sum(revenue + cogs + opex), 2) AS DECIMAL(38,2)) AS mart_total,
             CAST(sum(entry_count) AS BIGINT) AS mart_count FROM pnl) m""", "int_mapped", "pnl"))
def q_recon_pnl(spark, sf_dir):
    lg = L(spark, sf_dir)
    return M.reconcile_pnl(lg.int_mapped, lg.pnl)


# ---------------------------------------------------------------- windows
@register("margin_drift", O.sql("SELECT * FROM drift", "drift"))
def q_margin_drift(spark, sf_dir):
    return W.margin_drift(L(spark, sf_dir).pnl)


@register("latest_per_key", """SELECT e.* FROM events e
JOIN (SELECT event_type, max(ts) AS ts FROM events GROUP BY event_type) l ON e.event_type = l.event_type AND e.ts = l.ts""")
def q_latest_per_key(spark, sf_dir):
    return W.latest_per_key(L(spark, sf_dir).table("events"), "event_type", "ts")


@register("is_latest_flag", """SELECT e.*, e.ts = l.mts AS is_latest FROM events e
LEFT JOIN (SELECT user_id, max(ts) AS mts FROM events GROUP BY user_id) l ON e.user_id IS NOT DISTINCT FROM l.user_id""")
def q_is_latest_flag(spark, sf_dir):
    return W.is_latest_flag(L(spark, sf_dir).table("events"), "user_id", "ts")


# ---------------------------------------------------------------- top-k and sets
@register("variance_breakdown", O.sql("""SELECT period_month, segment, revenue, prev_revenue, revenue_variance_pct,
  gross_margin, gm_variance_pct, operating_income, oi_variance_pct, is_material_variance
FROM variance ORDER BY is_material_variance DESC NULLS LAST, period_month ASC NULLS LAST, segment ASC NULLS LAST LIMIT 25""",
                                      "variance"))
def q_variance_breakdown(spark, sf_dir):
    return T.variance_breakdown(L(spark, sf_dir).variance)


@register("cost_drivers", O.sql("""SELECT period_month, segment, cost_centre_name, account_type, account_name, cost_inr, mom_change_pct
FROM cost_analysis ORDER BY abs(coalesce(mom_change_pct, 0)) DESC, period_month ASC NULLS LAST, segment ASC NULLS LAST,
  cost_centre ASC NULLS LAST, account_code ASC NULLS LAST LIMIT 25""", "cost_analysis"))
def q_cost_drivers(spark, sf_dir):
    return T.cost_drivers(L(spark, sf_dir).cost_analysis)


@register("variance_json", O.sql(O.records_json_sql("variance", O.VARIANCE_ORDER, O.VARIANCE_RECORD), "variance"))
def q_variance_json(spark, sf_dir):
    return T.variance_json(L(spark, sf_dir).variance)


@register("variance_json_filtered", O.sql(O.records_json_sql(
    "(SELECT * FROM variance WHERE segment = 'EUROPE')", O.VARIANCE_ORDER, O.VARIANCE_RECORD, 10), "variance"))
def q_variance_json_filtered(spark, sf_dir):
    return T.variance_json(L(spark, sf_dir).variance, segment="EUROPE", k=10)


@register("cost_drivers_json", O.sql(O.records_json_sql(
    "(SELECT * FROM cost_analysis WHERE period_month = DATE '1996-03-01')", O.DRIVER_ORDER, O.DRIVER_RECORD), "cost_analysis"))
def q_cost_drivers_json(spark, sf_dir):
    return T.cost_drivers_json(L(spark, sf_dir).cost_analysis, period_month="1996-03-01")


@register("variance_breakdown_filtered", O.sql("""SELECT period_month, segment, revenue, prev_revenue, revenue_variance_pct,
  gross_margin, gm_variance_pct, operating_income, oi_variance_pct, is_material_variance
FROM variance WHERE period_month = DATE '1996-03-01'
ORDER BY is_material_variance DESC NULLS LAST, segment ASC NULLS LAST LIMIT 3""", "variance"))
def q_variance_breakdown_filtered(spark, sf_dir):
    return T.variance_breakdown(L(spark, sf_dir).variance, period_month="1996-03-01", k=3)


@register("cost_drivers_filtered", O.sql("""SELECT period_month, segment, cost_centre_name, account_type, account_name, cost_inr, mom_change_pct
FROM cost_analysis WHERE period_month = DATE '1996-03-01' AND segment = 'ASIA' ORDER BY abs(coalesce(mom_change_pct, 0)) DESC,
  cost_centre ASC NULLS LAST, account_code ASC NULLS LAST LIMIT 25""", "cost_analysis"))
def q_cost_drivers_filtered(spark, sf_dir):
    return T.cost_drivers(L(spark, sf_dir).cost_analysis, period_month="1996-03-01", segment="ASIA")


@register("segment_set_diff", O.sql("""SELECT segment, 'mart_pnl_summary' AS only_in FROM
  (SELECT DISTINCT segment FROM pnl EXCEPT SELECT DISTINCT segment FROM a_dim_projects) a
UNION ALL
SELECT segment, 'dim_projects' AS only_in FROM
  (SELECT DISTINCT segment FROM a_dim_projects EXCEPT SELECT DISTINCT segment FROM pnl) b""", "pnl", "a_dim_projects"))
def q_segment_set_diff(spark, sf_dir):
    lg = L(spark, sf_dir)
    return T.set_difference(lg.pnl, lg.dim_projects, ["segment"], "mart_pnl_summary", "dim_projects")


# ---------------------------------------------------------------- missing rates
@register("fx_coverage_gaps", O.sql("""SELECT DISTINCT entry_date, currency FROM stg_gl g
WHERE currency IS DISTINCT FROM 'INR'
  AND NOT EXISTS (SELECT 1 FROM gap_stg_fx f WHERE f.rate_date = g.entry_date AND f.from_currency = g.currency)""",
                                    "stg_gl", "gap_stg_fx"))
def q_fx_coverage_gaps(spark, sf_dir):
    lg = L(spark, sf_dir)
    return T.fx_coverage_gaps(lg.stg_gl, lg.stg_fx_gappy)


@register("missing_rate_entries", O.sql("""SELECT CAST(date_trunc('month', entry_date) AS DATE) AS period_month, source_currency,
  count(*) AS entries, count(fx_rate) AS with_rate, count(amount_inr) AS converted,
  CAST(sum(CASE WHEN fx_rate IS NULL THEN source_amount END) AS DECIMAL(38,2)) AS unconverted_amount
FROM gap_int_mapped GROUP BY 1, 2""", "gap_int_mapped"))
def q_missing_rate_entries(spark, sf_dir):
    """No posting is dropped for want of a rate: how many there are, and what is left unconverted."""
    return L(spark, sf_dir).int_mapped_gappy.groupBy(F.trunc("entry_date", "month").alias("period_month"), "source_currency").agg(
        F.count(F.lit(1)).alias("entries"), F.count("fx_rate").alias("with_rate"), F.count("amount_inr").alias("converted"),
        F.sum(F.when(F.col("fx_rate").isNull(), F.col("source_amount"))).cast("decimal(38,2)").alias("unconverted_amount"))


@register("mart_pnl_missing_rates", O.sql("SELECT * FROM gap_pnl", "gap_pnl"))
def q_pnl_missing_rates(spark, sf_dir):
    return L(spark, sf_dir).pnl_gappy


@register("gates_missing_rates", O.sql("SELECT * FROM gap_g2 UNION ALL SELECT * FROM gap_g4", "gap_g2", "gap_g4"))
def q_gates_missing_rates(spark, sf_dir):
    """The coverage gate fails on the missing pairs; the marts still reconcile with what was converted."""
    lg = L(spark, sf_dir)
    return G.gate_g2(lg.stg_fx_gappy, lg.stg_gl).unionByName(G.gate_g4(lg.int_mapped_gappy, lg.pnl_gappy))


# ---------------------------------------------------------------- column tests, gates, runner
from ledgerspark.operators import checks as C  # noqa: E402
from ledgerspark.operators import gates as G  # noqa: E402


LP = L


@register("model_tests", O.model_tests_sql())
def q_model_tests(spark, sf_dir):
    return C.run_all_model_tests(LP(spark, sf_dir).models())


def _gate_builders(lg: Ledger):
    return [
        ("g1", lambda: G.gate_g1(lg.stg_gl)),
        ("g2", lambda: G.gate_g2(lg.stg_fx, lg.stg_gl)),
        ("g3", lambda: G.gate_g3(lg.stg_payroll)),
        ("g4", lambda: G.gate_g4(lg.int_mapped, lg.pnl)),
        ("g5", lambda: G.gate_g5(lg.pnl, lg.revenue_trends, lg.cost_analysis, lg.variance, lg.dictionary)),
        ("g6", lambda: G.gate_g6(lg.pnl, lg.dictionary)),
    ]


def _gate_query(name):
    def q(spark, sf_dir):
        return dict(_gate_builders(LP(spark, sf_dir)))[name]()
    q.__name__ = f"q_gate_{name}"
    return q


for _g in ["g1", "g2", "g3", "g4", "g5", "g6"]:
    register(f"gate_{_g}", O.sql(f"SELECT * FROM {_g}", _g))(_gate_query(_g))


@register("gate_report", O.sql("""SELECT gate, check_no, "check", severity, passed, detail FROM gate_all
WHERE gate_no <= coalesce((SELECT min(gate_no) FROM gate_all WHERE severity = 'hard' AND NOT passed), 99)""",
                               "gate_all"))
def q_gate_report(spark, sf_dir):
    return G.run_gates(spark, _gate_builders(LP(spark, sf_dir)))


@register("scale_recon", O.sql("""SELECT gl_rows, payroll_rows, source_total, mart_total,
  CAST(abs(source_total - mart_total) AS DECIMAL(38,2)) AS diff, abs(source_total - mart_total) < 0.01 AS passed
FROM (SELECT count(*) AS gl_rows FROM stg_gl) a, (SELECT count(*) AS payroll_rows FROM stg_payroll) b,
     (SELECT CAST(round(sum(amount_inr), 2) AS DECIMAL(38,2)) AS source_total FROM int_mapped) c,
     (SELECT CAST(round(sum(revenue + cogs + opex), 2) AS DECIMAL(38,2)) AS mart_total FROM pnl) d""",
                               "stg_gl", "stg_payroll", "int_mapped", "pnl"))
def q_scale_recon(spark, sf_dir):
    return M.scale_reconciliation(LP(spark, sf_dir))


# ---------------------------------------------------------------- anomaly injection
from ledgerspark.operators import anomalies as A  # noqa: E402

RUN_AT = O.RUN_AT


def _mutation_query(t):
    def q(spark, sf_dir):
        lg = LP(spark, sf_dir)
        m, _ = A.mutate(t, lg.stg_gl, lg.stg_fx, lg.stg_payroll)
        return m.data
    q.__name__ = f"q_mutation_{t}"
    return q


for _t, *_ in A.ANOMALIES:
    register(f"mutation_{_t}", O.sql(f"SELECT * FROM mut_{_t}", f"mut_{_t}"))(_mutation_query(_t))


def _scorecard(spark, sf_dir):
    lg = LP(spark, sf_dir)
    return lg.derived("scorecard", lambda: A.scorecard(lg.stg_gl, lg.stg_fx, lg.stg_payroll), keep=True)


@register("anomaly_scorecard", O.sql("SELECT * FROM scorecard", "scorecard"))
def q_anomaly_scorecard(spark, sf_dir):
    return _scorecard(spark, sf_dir)


@register("anomaly_summary", O.sql("""SELECT CAST(sum(CASE WHEN was_caught THEN 1 ELSE 0 END) AS BIGINT) AS caught,
  CAST(sum(CASE WHEN NOT was_caught THEN 1 ELSE 0 END) AS BIGINT) AS escaped,
  CAST(sum(CASE WHEN NOT matches_expectation THEN 1 ELSE 0 END) AS BIGINT) AS unexpected, count(*) AS total
FROM scorecard""", "scorecard"))
def q_anomaly_summary(spark, sf_dir):
    return A.anomaly_summary(_scorecard(spark, sf_dir))


@register("anomaly_escapes", O.sql("SELECT * FROM escapes", "escapes"))
def q_anomaly_escapes(spark, sf_dir):
    return A.escapes_to_review(_scorecard(spark, sf_dir), RUN_AT)


# ---------------------------------------------------------------- narratives, claims, scoring
from ledgerspark.operators import narrative as NV  # noqa: E402
from ledgerspark.sources import narratives as SN  # noqa: E402


def _narr(spark, sf_dir):
    return L(spark, sf_dir).narratives


def _narr_claims(spark, sf_dir):
    lg = L(spark, sf_dir)

    def build():
        n = _narr(spark, sf_dir)
        return NV.extract_claims(n, "narrative_id", "text").join(n.select("narrative_id", "h"), "narrative_id")
    return lg.derived("narrative_claims", build, keep=True)


def _grounded(spark, sf_dir):
    lg = L(spark, sf_dir)
    return lg.derived("grounded", lambda: NV.ground_claims(
        _narr_claims(spark, sf_dir).drop("h"), ["narrative_id", "claim_no"], NV.mart_values(lg.pnl)), keep=True)


def _scored(spark, sf_dir):
    lg = L(spark, sf_dir)

    def build():
        responses = SN.judge_responses(_narr_claims(spark, sf_dir))
        return NV.score_claims(_grounded(spark, sf_dir), responses, ["narrative_id", "claim_no"], RUN_AT)
    return lg.derived("scored", build, keep=True)


@register("claims", O.sql("SELECT * FROM doc_claims", "doc_claims"))
def q_claims(spark, sf_dir):
    return NV.extract_claims(L(spark, sf_dir).table("documents"), "doc_id", "text")


@register("claim_grounding", O.sql("SELECT * FROM grounded", "grounded"))
def q_claim_grounding(spark, sf_dir):
    return _grounded(spark, sf_dir)


@register("judge_parse", O.sql("SELECT * FROM judged", "judged"))
def q_judge_parse(spark, sf_dir):
    r = NV.judge_scores(SN.judge_responses(_narr_claims(spark, sf_dir)))
    return r.select("narrative_id", "claim_no", "self_supported", "self_confidence", "self_parse_ok",
                    "judge_supported", "judge_confidence", "judge_parse_ok", "self_score", "judge_score")


@register("claim_routing", O.sql("SELECT * FROM scored", "scored"))
def q_claim_routing(spark, sf_dir):
    return _scored(spark, sf_dir)


@register("narrative_gate", O.sql("""SELECT narrative_id, count(*) AS n_claims,
  CAST(sum(CASE WHEN routing_band = 'rejected' THEN 1 ELSE 0 END) AS BIGINT) AS n_rejected,
  sum(CASE WHEN routing_band = 'rejected' THEN 1 ELSE 0 END) = 0 AS passed
FROM scored GROUP BY narrative_id""", "scored"))
def q_narrative_gate(spark, sf_dir):
    return NV.narrative_gate(_scored(spark, sf_dir), "narrative_id")


@register("band_counts", O.sql("SELECT routing_band, count(*) AS claims FROM scored GROUP BY routing_band", "scored"))
def q_band_counts(spark, sf_dir):
    return NV.band_counts(_scored(spark, sf_dir))


@register("verdict", O.sql("SELECT * FROM verdicts", "verdicts"))
def q_verdict(spark, sf_dir):
    raw = SN.verdict_responses(_grounded(spark, sf_dir), _narr(spark, sf_dir))
    return NV.parse_verdict(raw, "verdict_response").drop("verdict_response")


@register("headline_split", O.sql("SELECT * FROM headlines", "headlines"))
def q_headline_split(spark, sf_dir):
    return NV.split_headline(SN.headline_responses(_narr(spark, sf_dir)), "response").drop("response")


@register("bounded_snippets", O.sql("SELECT * FROM snippets", "snippets"))
def q_bounded_snippets(spark, sf_dir):
    return NV.bounded_snippets(L(spark, sf_dir).table("documents"), "doc_id", "text")


@register("headline_facts", O.sql("SELECT * FROM facts", "facts"))
def q_headline_facts(spark, sf_dir):
    lg = L(spark, sf_dir)
    return M.headline_facts(lg.pnl, lg.variance, lg.cost_analysis)


# ---------------------------------------------------------------- review queue
from ledgerspark.operators import review as RV  # noqa: E402

REVIEWED_AT = O.REVIEWED_AT


def _applied_queue(spark, sf_dir):
    def build():
        queue = _scored(spark, sf_dir).select(*RV.QUEUE_COLUMNS)
        return RV.apply_decisions(queue, RV.decisions_from_queue(queue, REVIEWED_AT))
    return L(spark, sf_dir).derived("applied_queue", build, keep=True)


@register("apply_decisions", O.sql("SELECT * FROM applied", "applied"))
def q_apply_decisions(spark, sf_dir):
    return _applied_queue(spark, sf_dir)


@register("queue_status", O.sql("""SELECT routing_band, CAST(sum(CASE WHEN reviewer_verdict IS NULL THEN 1 ELSE 0 END) AS BIGINT)
  AS pending, count(*) AS total FROM applied GROUP BY routing_band""", "applied"))
def q_queue_status(spark, sf_dir):
    return RV.queue_status(_applied_queue(spark, sf_dir))


@register("band_accuracy", O.sql("""SELECT routing_band, count(*) AS total_reviewed,
  CAST(sum(CASE WHEN reviewer_verdict = 'approved' THEN 1 ELSE 0 END) AS BIGINT) AS approved,
  CAST(sum(CASE WHEN reviewer_verdict = 'edited' THEN 1 ELSE 0 END) AS BIGINT) AS edited,
  CAST(sum(CASE WHEN reviewer_verdict = 'rejected' THEN 1 ELSE 0 END) AS BIGINT) AS rejected,
  round(100.0 * CAST(sum(CASE WHEN reviewer_verdict = 'approved' THEN 1 ELSE 0 END) AS DOUBLE) / CAST(count(*) AS DOUBLE), 1)
    AS approval_rate_pct
FROM applied WHERE reviewer_verdict IS NOT NULL GROUP BY routing_band""", "applied"))
def q_band_accuracy(spark, sf_dir):
    return RV.band_accuracy(_applied_queue(spark, sf_dir))


@register("next_pending", O.sql("""SELECT review_id, claim_text, self_reported_score, second_judge_score,
  retrieval_grounding_score, confidence_score, run_at FROM applied
WHERE routing_band = 'human_review' AND reviewer_verdict IS NULL ORDER BY run_at, review_id LIMIT 1""", "applied"))
def q_next_pending(spark, sf_dir):
    return RV.next_pending(_applied_queue(spark, sf_dir))


# ---------------------------------------------------------------- documentation drift, publish
from ledgerspark.operators import drift as DR  # noqa: E402
from ledgerspark.operators import publish as PB  # noqa: E402


def _doc_drift(spark, sf_dir):
    return L(spark, sf_dir).derived("doc_drift", lambda: _build_doc_drift(spark, sf_dir), keep=True)


def _build_doc_drift(spark, sf_dir):
    lg = L(spark, sf_dir)
    docs = lg.table("documents").select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("name"),
                                        F.col("source").alias("layer"), "text")
    current = DR.fingerprints(docs, "name", "layer", "text")
    h = F.sha2(F.col("text"), 256)
    documented = docs.where(~h.startswith("f")).select(
        F.col("name").alias("model_name"), "layer",
        F.when(h.startswith("0") | h.startswith("1"), F.sha2(F.concat(F.col("text"), F.lit(" ")), 256))
         .otherwise(h).alias("sha256"))
    bench = lg.table("benchmark").select(F.concat(F.lit("bench-"), F.col("item_id").cast("string")).alias("model_name"),
                                         F.lit(None).cast("string").alias("layer"),
                                         F.sha2(F.col("text"), 256).alias("sha256"))
    return DR.compare_fingerprints(current, documented.unionByName(bench))


@register("doc_drift", O.sql("SELECT * FROM doc_drift", "doc_drift"))
def q_doc_drift(spark, sf_dir):
    return _doc_drift(spark, sf_dir)


@register("drift_summary", O.sql("""SELECT count(*) AS models,
  CAST(sum(CASE WHEN NOT is_drifted THEN 1 ELSE 0 END) AS BIGINT) AS in_sync,
  CAST(sum(CASE WHEN is_drifted THEN 1 ELSE 0 END) AS BIGINT) AS drifted,
  CAST(sum(CASE WHEN drift_reason = 'sql_changed_since_docs' THEN 1 ELSE 0 END) AS BIGINT) AS sql_changed_since_docs,
  CAST(sum(CASE WHEN drift_reason = 'never_documented' THEN 1 ELSE 0 END) AS BIGINT) AS never_documented,
  CAST(sum(CASE WHEN drift_reason = 'doc_entry_orphaned' THEN 1 ELSE 0 END) AS BIGINT) AS doc_entry_orphaned
FROM doc_drift""", "doc_drift"))
def q_drift_summary(spark, sf_dir):
    return DR.drift_summary(_doc_drift(spark, sf_dir))


@register("publish_types", O.sql("""SELECT period_month, segment, cost_centre, cost_centre_name, cost_centre_location,
  cost_centre_country, account_type, account_code, account_name,
  CASE WHEN isnan(CAST(cost_inr AS DOUBLE)) THEN NULL ELSE CAST(cost_inr AS DOUBLE) END AS cost_inr,
  CAST(entry_count AS BIGINT) AS entry_count,
  CASE WHEN isnan(CAST(prev_month_cost AS DOUBLE)) THEN NULL ELSE CAST(prev_month_cost AS DOUBLE) END AS prev_month_cost,
  CASE WHEN isnan(mom_change_pct) THEN NULL ELSE mom_change_pct END AS mom_change_pct
FROM cost_analysis""", "cost_analysis"))
def q_publish_types(spark, sf_dir):
    return PB.normalize_types(L(spark, sf_dir).cost_analysis)


# ---------------------------------------------------------------- bronze files, source tests, corpus
from ledgerspark.sources import bronze as BR  # noqa: E402
from ledgerspark.sources import corpus as CO  # noqa: E402


def _sources(spark, sf_dir, corrupt: bool = False):
    root = L(spark, sf_dir).bronze_path
    return {t: BR.read_csv_source(spark, root, t, corrupt=corrupt) for t in ("erp_gl_entries", "payroll_entries", "fx_rates")}


@register("bronze_by_header", O.sql("SELECT * FROM cell_gl", "cell_gl"))
def q_bronze_by_header(spark, sf_dir):
    """The ledger's text cells from files whose columns stand in different orders."""
    return BR.blank_to_null(_sources(spark, sf_dir)["erp_gl_entries"])


@register("bronze_audit", O.sql("SELECT * FROM cell_audit", "cell_audit"))
def q_bronze_audit(spark, sf_dir):
    return reduce(DataFrame.unionByName, [BR.audit_cells(df, t) for t, df in _sources(spark, sf_dir, corrupt=True).items()])


@register("source_tests", O.source_tests_sql())
def q_source_tests(spark, sf_dir):
    return C.run_source_tests(_sources(spark, sf_dir))


@register("sql_corpus", O.sql("SELECT * FROM corpus", "corpus"))
def q_sql_corpus(spark, sf_dir):
    c = CO.read_sql_corpus(spark, L(spark, sf_dir).corpus_path)
    return c.select("model_name", "layer", F.sha2("text", 256).alias("sql_sha256"), F.length("text").cast("long").alias("n_chars"), "yml_content")


@register("corpus_columns", O.sql("SELECT * FROM corpus_cols", "corpus_cols"))
def q_corpus_columns(spark, sf_dir):
    c = CO.read_sql_corpus(spark, L(spark, sf_dir).corpus_path)
    return CO.yaml_columns(c).select(CO.layer_of().alias("layer"), "model", "column_name", F.array_join("tests", ",").alias("tests"))


# ---------------------------------------------------------------- publishing and logs
from ledgerspark.operators import warehouse as WH  # noqa: E402
from ledgerspark.plans import publishing as PG  # noqa: E402


@register("card_headlines", O.sql("SELECT * FROM card_headlines", "card_headlines"))
def q_card_headlines(spark, sf_dir):
    return PG.headlines(L(spark, sf_dir))


@register("publish_round_trip", O.profile_sql(True))
def q_publish_round_trip(spark, sf_dir):
    """The six tables as a reader of the last committed publish sees them, column by column."""
    return PG.publish_round_trip(L(spark, sf_dir))


@register("csv_round_trip", O.profile_sql(False))
def q_csv_round_trip(spark, sf_dir):
    return PG.csv_round_trip(L(spark, sf_dir))


@register("sync_log", O.sql("SELECT sync_run_id, synced_at, total_rows_synced FROM syncs", "syncs"))
def q_sync_log(spark, sf_dir):
    return PG.published(L(spark, sf_dir)).sync_log()


@register("rows_synced_latest", O.sql("""SELECT total_rows_synced AS rows_synced_latest, synced_at AS last_refreshed FROM syncs
ORDER BY synced_at DESC LIMIT 1""", "syncs"))
def q_rows_synced_latest(spark, sf_dir):
    return WH.rows_synced_latest(PG.published(L(spark, sf_dir)).sync_log())


@register("snippet_log", O.sql("SELECT * FROM snippet_log", "snippet_log"))
def q_snippet_log(spark, sf_dir):
    return PG.snippet_log(L(spark, sf_dir)).drop("snippet_id")


@register("latest_snippets", O.sql("""SELECT * FROM snippet_log
QUALIFY generated_at = max(generated_at) OVER (PARTITION BY narrative_id)""", "snippet_log"))
def q_latest_snippets(spark, sf_dir):
    return WH.latest_per(PG.snippet_log(L(spark, sf_dir)).drop("snippet_id"), "narrative_id", "generated_at")

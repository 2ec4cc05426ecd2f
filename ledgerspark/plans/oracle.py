"""DuckDB twins of the registered queries (the correctness oracle).

Written independently of the Spark code, as plain SQL over the driver's views
(lineitem, orders, customer, nation, region, supplier, documents, events).
Each named block below is a CTE; ``sql(final, *needs)`` prefixes a final
SELECT with the blocks it needs, in dependency order.
"""

from __future__ import annotations

import re

from ledgerspark.functions.text import ASCII_DIGITS, OTHER_DIGITS

# name -> (dependencies, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, body: str, deps: tuple[str, ...] = ()) -> None:
    CTES[name] = (deps, body)


def sql(final: str, *needs: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return final
    parts = [f"{n} AS (\n{CTES[n][1]}\n)" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + final


# ---------------------------------------------------------------- adapter
ACCOUNT_NAME = ("(CASE l_returnflag WHEN 'N' THEN 'Sales' WHEN 'R' THEN 'Returns handling' ELSE 'Fulfilment' END"
                " || CASE WHEN l_linestatus = 'F' THEN ' - closed' ELSE ' - open' END)")
CURRENCY = ("CASE n_regionkey WHEN 0 THEN 'USD' WHEN 1 THEN 'INR' WHEN 2 THEN 'EUR' "
            "WHEN 3 THEN 'GBP' WHEN 4 THEN 'AED' END")

cte("a_nr", """SELECT n_nationkey, n_name, n_regionkey, r_name
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""")

cte("a_gl", f"""SELECT
  concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, strftime(l_shipdate, '%Y%m%d')) AS entry_id,
  CAST(l_shipdate AS DATE) AS entry_date,
  'P-' || CAST(c_nationkey AS VARCHAR) AS project_code,
  n_name AS project_name,
  r_name AS segment,
  'CC-' || CAST(l_suppkey AS VARCHAR) AS cost_centre,
  l_returnflag || l_linestatus AS account_code,
  {ACCOUNT_NAME} AS account_name,
  CASE WHEN l_returnflag = 'N' THEN 'Revenue' WHEN l_returnflag = 'R' THEN 'COGS' ELSE 'OpEx' END AS account_type,
  {CURRENCY} AS currency,
  CASE WHEN l_returnflag = 'N' THEN CAST(l_extendedprice AS DECIMAL(18,2))
       WHEN l_returnflag = 'R' THEN CAST(l_extendedprice * CAST(-0.4 AS DOUBLE) AS DECIMAL(18,2))
       ELSE CAST(l_extendedprice * CAST(-0.2 AS DOUBLE) AS DECIMAL(18,2)) END AS amount,
  {ACCOUNT_NAME} || ' for ' || 'P-' || CAST(c_nationkey AS VARCHAR) AS description
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN a_nr ON c_nationkey = n_nationkey""", ("a_nr",))

cte("a_fx", """SELECT d.rate_date, b.from_currency, 'INR' AS to_currency,
  CAST(b.base + CAST(((d.n * b.k) % 1001) - 500 AS DECIMAL(9,0)) * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(12,6)) AS rate
FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS rate_date,
             date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) AS n FROM lineitem) d,
     (VALUES ('USD', CAST(83.20 AS DECIMAL(9,3)), 37), ('EUR', CAST(90.40 AS DECIMAL(9,3)), 53),
             ('GBP', CAST(105.10 AS DECIMAL(9,3)), 71), ('AED', CAST(22.65 AS DECIMAL(9,3)), 13)) b(from_currency, base, k)""")

cte("a_payroll", """SELECT
  'PAY-' || CAST(o_orderkey AS VARCHAR) AS allocation_id,
  CAST(o_orderdate AS DATE) AS allocation_date,
  'EMP-' || lpad(CAST(o_custkey % 30 + 1 AS VARCHAR), 4, '0') AS employee_id,
  'P-' || CAST(c_nationkey AS VARCHAR) AS project_code,
  'CC-' || CAST(o_orderkey % 97 + 1 AS VARCHAR) AS cost_centre,
  CAST(CAST(200 + o_orderkey % 1401 AS DECIMAL(8,2)) * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(8,2)) AS hours_logged,
  CAST(CAST(80000 + (o_orderkey * 7 + o_custkey) % 270001 AS DECIMAL(10,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS rate_per_hour
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")

cte("a_dim_projects", f"""SELECT 'P-' || CAST(n_nationkey AS VARCHAR) AS project_code,
  'Project ' || n_name AS project_name, r_name AS segment,
  {CURRENCY} AS billing_currency, 'Client ' || n_name AS client_name
FROM a_nr WHERE n_nationkey NOT IN (24)""", ("a_nr",))

cte("a_dim_cost_centres", """SELECT 'CC-' || CAST(s_suppkey AS VARCHAR) AS cost_centre,
  s_name || ' Centre' AS cost_centre_name, n_name AS location, r_name AS country
FROM supplier LEFT JOIN a_nr ON s_nationkey = n_nationkey WHERE s_suppkey NOT IN (7)""", ("a_nr",))

# ---------------------------------------------------------------- staging
cte("stg_gl", """SELECT CAST(entry_id AS VARCHAR) AS entry_id, CAST(entry_date AS DATE) AS entry_date,
  project_code, project_name, segment, cost_centre, account_code, account_name, account_type, currency,
  CAST(amount AS DECIMAL(18,2)) AS amount, description
FROM a_gl""", ("a_gl",))
cte("stg_fx", """SELECT CAST(rate_date AS DATE) AS rate_date, from_currency, to_currency,
  CAST(rate AS DECIMAL(12,6)) AS rate FROM a_fx""", ("a_fx",))
cte("stg_payroll", """SELECT allocation_id, allocation_date, employee_id, project_code, cost_centre,
  hours_logged, rate_per_hour, CAST(hours_logged * rate_per_hour AS DECIMAL(18,2)) AS cost_inr
FROM a_payroll""", ("a_payroll",))

# ---------------------------------------------------------------- intermediate
cte("int_fx", """SELECT g.entry_id, g.entry_date, g.project_code, g.project_name, g.segment, g.cost_centre,
  g.account_code, g.account_name, g.account_type,
  g.currency AS source_currency, g.amount AS source_amount, r.rate AS fx_rate,
  CAST(g.amount * r.rate AS DECIMAL(18,2)) AS amount_inr, 'INR' AS reporting_currency, g.description
FROM stg_gl g
LEFT JOIN (
  SELECT rate_date, from_currency, rate FROM stg_fx
  UNION ALL
  SELECT DISTINCT entry_date, 'INR', CAST(1 AS DECIMAL(12,6)) FROM stg_gl
) r ON g.entry_date = r.rate_date AND g.currency = r.from_currency""", ("stg_gl", "stg_fx"))

cte("int_mapped", """SELECT e.entry_id, e.entry_date,
  e.project_code, p.project_name AS project_name_governed, p.segment AS segment_governed,
  p.client_name, p.billing_currency,
  e.cost_centre, c.cost_centre_name, c.location AS cost_centre_location, c.country AS cost_centre_country,
  e.account_code, e.account_name, e.account_type,
  e.source_currency, e.source_amount, e.fx_rate, e.amount_inr, e.reporting_currency,
  p.project_code IS NULL AS is_orphan_project,
  c.cost_centre IS NULL AS is_orphan_cost_centre,
  e.description
FROM int_fx e
LEFT JOIN a_dim_projects p ON e.project_code = p.project_code
LEFT JOIN a_dim_cost_centres c ON e.cost_centre = c.cost_centre""", ("int_fx", "a_dim_projects", "a_dim_cost_centres"))

# ---------------------------------------------------------------- marts
cte("pnl", """SELECT period_month, segment, revenue, cogs,
  CAST(revenue + cogs AS DECIMAL(38,2)) AS gross_margin, opex,
  CAST(revenue + cogs + opex AS DECIMAL(38,2)) AS operating_income,
  CASE WHEN revenue = 0 THEN NULL ELSE round((revenue + cogs) / revenue * 100, 2) END AS gross_margin_pct,
  CASE WHEN revenue = 0 THEN NULL ELSE round((revenue + cogs + opex) / revenue * 100, 2) END AS operating_margin_pct,
  entry_count
FROM (
  SELECT CAST(date_trunc('month', entry_date) AS DATE) AS period_month, segment_governed AS segment,
    CAST(sum(CASE WHEN account_type = 'Revenue' THEN amount_inr ELSE 0 END) AS DECIMAL(38,2)) AS revenue,
    CAST(sum(CASE WHEN account_type = 'COGS' THEN amount_inr ELSE 0 END) AS DECIMAL(38,2)) AS cogs,
    CAST(sum(CASE WHEN account_type = 'OpEx' THEN amount_inr ELSE 0 END) AS DECIMAL(38,2)) AS opex,
    count(*) AS entry_count
  FROM int_mapped GROUP BY 1, 2
) t""", ("int_mapped",))

cte("revenue_trends", """SELECT m.*,
  lag(revenue_inr) OVER w AS prev_month_revenue,
  CASE WHEN lag(revenue_inr) OVER w IS NULL OR lag(revenue_inr) OVER w = 0 THEN NULL
       ELSE round((revenue_inr - lag(revenue_inr) OVER w) / abs(lag(revenue_inr) OVER w) * 100, 2) END AS mom_change_pct
FROM (
  SELECT CAST(date_trunc('month', entry_date) AS DATE) AS period_month, segment_governed AS segment, project_code,
    project_name_governed AS project_name, client_name,
    CAST(sum(amount_inr) AS DECIMAL(38,2)) AS revenue_inr, count(*) AS entry_count
  FROM int_mapped WHERE account_type = 'Revenue' GROUP BY 1, 2, 3, 4, 5
) m
WINDOW w AS (PARTITION BY segment, project_code ORDER BY period_month)""", ("int_mapped",))

cte("cost_analysis", """SELECT m.*,
  lag(cost_inr) OVER w AS prev_month_cost,
  CASE WHEN lag(cost_inr) OVER w IS NULL OR lag(cost_inr) OVER w = 0 THEN NULL
       ELSE round((cost_inr - lag(cost_inr) OVER w) / lag(cost_inr) OVER w * 100, 2) END AS mom_change_pct
FROM (
  SELECT CAST(date_trunc('month', entry_date) AS DATE) AS period_month, segment_governed AS segment, cost_centre,
    cost_centre_name, cost_centre_location, cost_centre_country, account_type, account_code, account_name,
    CAST(sum(abs(amount_inr)) AS DECIMAL(38,2)) AS cost_inr, count(*) AS entry_count
  FROM int_mapped WHERE account_type IN ('COGS', 'OpEx') GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9
) m
WINDOW w AS (PARTITION BY segment, cost_centre, account_code ORDER BY period_month)""", ("int_mapped",))

cte("variance", """SELECT period_month, segment,
  revenue, prev_revenue, CAST(revenue - coalesce(prev_revenue, 0) AS DECIMAL(38,2)) AS revenue_variance,
  CASE WHEN prev_revenue IS NULL OR prev_revenue = 0 THEN NULL
       ELSE round((revenue - prev_revenue) / abs(prev_revenue) * 100, 2) END AS revenue_variance_pct,
  gross_margin, prev_gross_margin, CAST(gross_margin - coalesce(prev_gross_margin, 0) AS DECIMAL(38,2)) AS gm_variance,
  CASE WHEN prev_gross_margin IS NULL OR prev_gross_margin = 0 THEN NULL
       ELSE round((gross_margin - prev_gross_margin) / abs(prev_gross_margin) * 100, 2) END AS gm_variance_pct,
  operating_income, prev_operating_income,
  CAST(operating_income - coalesce(prev_operating_income, 0) AS DECIMAL(38,2)) AS oi_variance,
  CASE WHEN prev_operating_income IS NULL OR prev_operating_income = 0 THEN NULL
       ELSE round((operating_income - prev_operating_income) / abs(prev_operating_income) * 100, 2) END AS oi_variance_pct,
  CASE WHEN prev_operating_income IS NOT NULL AND prev_operating_income <> 0
        AND abs((operating_income - prev_operating_income) / abs(prev_operating_income)) > 0.10
       THEN true ELSE false END AS is_material_variance
FROM (
  SELECT period_month, segment, revenue, gross_margin, operating_income,
    lag(revenue) OVER w AS prev_revenue, lag(gross_margin) OVER w AS prev_gross_margin,
    lag(operating_income) OVER w AS prev_operating_income
  FROM pnl WINDOW w AS (PARTITION BY segment ORDER BY period_month)
) t""", ("pnl",))

# ---------------------------------------------------------------- dictionary, drift
def _dictionary_values() -> str:
    from ledgerspark.operators.marts import METRIC_DICTIONARY

    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"
    rows = ",\n  ".join("(" + ", ".join(q(v) for v in r) + ")" for r in METRIC_DICTIONARY)
    return (f"SELECT * FROM (VALUES\n  {rows}\n) t(metric_key, metric_name, calculation_logic, unit, "
            "source_model, used_in_views)")


cte("dict", _dictionary_values())

cte("drift", """SELECT segment, latest_period, v AS latest_value, CAST(n - 1 AS BIGINT) AS prior_periods,
  round(mean, 6) AS prior_mean, round(sd, 6) AS prior_stdev,
  round(CASE WHEN n >= 4 AND n_null = 0 AND sd <> 0 THEN (v - mean) / sd END, 6) AS z_score,
  coalesce(abs(CASE WHEN n >= 4 AND n_null = 0 AND sd <> 0 THEN (v - mean) / sd END) > 3.0, false) AS is_drift_warning
FROM (
  SELECT segment, period_month, v,
    count(*) OVER (PARTITION BY segment) AS n,
    max(period_month) OVER (PARTITION BY segment) AS latest_period,
    sum(CASE WHEN v IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY segment) AS n_null,
    avg(v) OVER (PARTITION BY segment ORDER BY period_month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mean,
    stddev_pop(v) OVER (PARTITION BY segment ORDER BY period_month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS sd
  FROM (SELECT segment, period_month, operating_margin_pct AS v FROM pnl WHERE segment IS NOT NULL) d
) x WHERE period_month = latest_period""", ("pnl",))


# ---------------------------------------------------------------- gates
def S(x: str) -> str:
    return f"coalesce(CAST({x} AS VARCHAR), 'None')"


def gate_rows(gate: str, src: str, checks: list[tuple]) -> str:
    """checks: (no, name, passed_sql, detail_sql[, severity])"""
    parts = []
    for c in checks:
        no, name, passed, detail = c[:4]
        sev = c[4] if len(c) > 4 else "hard"
        parts.append(f"SELECT '{gate}' AS gate, CAST({no} AS BIGINT) AS check_no, '{name}' AS \"check\", "
                     f"'{sev}' AS severity, coalesce({passed}, false) AS passed, {detail} AS detail FROM {src}")
    return "\nUNION ALL\n".join(parts)


def g1_ctes(prefix: str, gl: str) -> None:
    cte(f"{prefix}_a", f"""SELECT coalesce(sum(n), 0) AS rows_,
  coalesce(sum(CASE WHEN _id IS NOT NULL AND n > 1 THEN n END), 0) AS dups,
  coalesce(sum(CASE WHEN _id IS NULL THEN n END), 0) AS null_id,
  coalesce(sum(nd), 0) AS null_date, coalesce(sum(na), 0) AS null_amount,
  coalesce(sum(bt), 0) AS bad_type, coalesce(sum(bc), 0) AS bad_ccy
FROM (SELECT entry_id AS _id, count(*) AS n,
        sum(CASE WHEN entry_date IS NULL THEN 1 ELSE 0 END) AS nd,
        sum(CASE WHEN amount IS NULL THEN 1 ELSE 0 END) AS na,
        sum(CASE WHEN account_type IS NOT NULL AND account_type NOT IN ('Revenue', 'COGS', 'OpEx') THEN 1 ELSE 0 END) AS bt,
        sum(CASE WHEN currency IS NOT NULL AND currency NOT IN ('INR', 'USD', 'EUR', 'GBP', 'AED') THEN 1 ELSE 0 END) AS bc
      FROM {gl} GROUP BY entry_id) k""", (gl,))
    cte(prefix, gate_rows("g1", f"{prefix}_a", [
        (1, "row count in range", "rows_ >= 10", f"'rows=' || {S('rows_')}"),
        (2, "columns match set", "true", "'columns=12'"),
        (3, "entry_id unique", "dups = 0", f"'duplicates=' || {S('dups')}"),
        (4, "entry_id not null", "null_id = 0", f"'nulls=' || {S('null_id')}"),
        (5, "entry_date not null", "null_date = 0", f"'nulls=' || {S('null_date')}"),
        (6, "amount not null", "null_amount = 0", f"'nulls=' || {S('null_amount')}"),
        (7, "account_type in set", "bad_type = 0", f"'unexpected=' || {S('bad_type')}"),
        (8, "currency in set", "bad_ccy = 0", f"'unexpected=' || {S('bad_ccy')}"),
    ]), (f"{prefix}_a",))


g1_ctes("g1", "stg_gl")

def g2_ctes(prefix: str, fx: str, gl: str) -> None:
    cte(f"{prefix}_gaps", f"""SELECT DISTINCT entry_date, currency FROM {gl} g
WHERE currency IS DISTINCT FROM 'INR'
  AND NOT EXISTS (SELECT 1 FROM {fx} f WHERE f.rate_date = g.entry_date AND f.from_currency = g.currency)""", (gl, fx))
    cte(f"{prefix}_a", f"""SELECT * FROM
  (SELECT count(*) AS fx_rows, sum(CASE WHEN rate <= 0 THEN 1 ELSE 0 END) AS non_positive,
          sum(CASE WHEN rate IS NULL THEN 1 ELSE 0 END) AS null_rates FROM {fx}) f,
  (SELECT count(*) AS missing_pairs FROM {prefix}_gaps) g""", (fx, f"{prefix}_gaps"))
    cte(prefix, gate_rows("g2", f"{prefix}_a", [
        (1, "fx_rates row count > 0", "fx_rows > 0", f"'rows=' || {S('fx_rows')}"),
        (2, "all rates positive", "non_positive = 0", f"'non_positive=' || {S('non_positive')}"),
        (3, "no null rates", "null_rates = 0", f"'nulls=' || {S('null_rates')}"),
        (4, "all GL dates have FX rates", "missing_pairs = 0", f"'missing_pairs=' || {S('missing_pairs')}"),
    ]), (f"{prefix}_a",))


def g3_ctes(prefix: str, payroll: str) -> None:
    cte(f"{prefix}_a", f"""SELECT coalesce(sum(n), 0) AS rows_, coalesce(sum(n - 1), 0) AS dupes,
  coalesce(sum(ne), 0) AS null_emp, coalesce(sum(bh), 0) AS bad_hours, coalesce(sum(bc), 0) AS bad_cost
FROM (SELECT allocation_id, count(*) AS n,
        sum(CASE WHEN employee_id IS NULL THEN 1 ELSE 0 END) AS ne,
        sum(CASE WHEN hours_logged <= 0 THEN 1 ELSE 0 END) AS bh,
        sum(CASE WHEN cost_inr <= 0 THEN 1 ELSE 0 END) AS bc
      FROM {payroll} GROUP BY allocation_id) k""", (payroll,))
    cte(prefix, gate_rows("g3", f"{prefix}_a", [
        (1, "row count in range", "rows_ >= 10", f"'rows=' || {S('rows_')}"),
        (2, "all columns present", "true", "'missing=[]'"),
        (3, "allocation_id unique", "dupes = 0", f"'dupes=' || {S('dupes')}"),
        (4, "no null employee_id", "null_emp = 0", f"'nulls=' || {S('null_emp')}"),
        (5, "hours_logged positive", "bad_hours = 0", f"'non_positive=' || {S('bad_hours')}"),
        (6, "cost_inr positive", "bad_cost = 0", f"'non_positive=' || {S('bad_cost')}"),
    ]), (f"{prefix}_a",))


g2_ctes("g2", "stg_fx", "stg_gl")
g3_ctes("g3", "stg_payroll")

cte("g4_a", """SELECT *, CAST(abs(src_total - mart_total) AS DECIMAL(38,2)) AS diff FROM
  (SELECT CAST(round(sum(amount_inr), 2) AS DECIMAL(38,2)) AS src_total, count(*) AS src_count FROM int_mapped) s,
  (SELECT CAST(round(sum(revenue + cogs + opex), 2) AS DECIMAL(38,2)) AS mart_total,
          CAST(sum(entry_count) AS BIGINT) AS mart_count,
          sum(CASE WHEN operating_income IS NULL THEN 1 ELSE 0 END) AS null_oi,
          sum(CASE WHEN abs(gross_margin - (revenue + cogs)) > 0.01 THEN 1 ELSE 0 END) AS gm_bad,
          sum(CASE WHEN abs(operating_income - (revenue + cogs + opex)) > 0.01 THEN 1 ELSE 0 END) AS oi_bad
   FROM pnl) m""", ("int_mapped", "pnl"))
cte("g4", gate_rows("g4", "g4_a", [
    (1, "total INR reconciliation", "diff < 0.01",
     f"'source=' || {S('src_total')} || ' mart=' || {S('mart_total')} || ' diff=' || {S('diff')}"),
    (2, "entry count reconciliation", "src_count = mart_count",
     f"'source=' || {S('src_count')} || ' mart=' || {S('mart_count')}"),
    (3, "no null operating_income", "null_oi = 0", f"'nulls=' || {S('null_oi')}"),
    (4, "gross_margin = revenue + cogs", "gm_bad = 0", f"'mismatches=' || {S('gm_bad')}"),
    (5, "operating_income = revenue + cogs + opex", "oi_bad = 0", f"'mismatches=' || {S('oi_bad')}"),
]), ("g4_a",))

cte("g5_a", """SELECT *, CAST(abs(pnl_rev - trend_rev) AS DECIMAL(38,2)) AS d_rev,
  CAST(abs(pnl_cost - cost_mart) AS DECIMAL(38,2)) AS d_cost FROM
  (SELECT CAST(round(sum(revenue), 2) AS DECIMAL(38,2)) AS pnl_rev,
          CAST(round(sum(abs(cogs) + abs(opex)), 2) AS DECIMAL(38,2)) AS pnl_cost FROM pnl) p,
  (SELECT CAST(round(sum(revenue_inr), 2) AS DECIMAL(38,2)) AS trend_rev FROM revenue_trends) t,
  (SELECT CAST(round(sum(cost_inr), 2) AS DECIMAL(38,2)) AS cost_mart FROM cost_analysis) c,
  (SELECT (SELECT count(*) FROM (SELECT DISTINCT segment FROM pnl EXCEPT SELECT DISTINCT segment FROM variance) x) AS pnl_only,
          (SELECT count(*) FROM (SELECT DISTINCT segment FROM variance EXCEPT SELECT DISTINCT segment FROM pnl) y) AS var_only) s,
  (SELECT count(*) AS dict_missing FROM (VALUES ('mart_pnl_summary'), ('mart_revenue_trends'), ('mart_cost_analysis'),
     ('mart_variance_analysis')) e(m) WHERE m NOT IN (SELECT source_model FROM dict)) d""",
    ("pnl", "revenue_trends", "cost_analysis", "variance", "dict"))
cte("g5", gate_rows("g5", "g5_a", [
    (1, "revenue: pnl vs trends", "d_rev < 0.01",
     f"'pnl=' || {S('pnl_rev')} || ' trends=' || {S('trend_rev')} || ' diff=' || {S('d_rev')}"),
    (2, "costs: pnl vs cost_analysis", "d_cost < 0.01",
     f"'pnl=' || {S('pnl_cost')} || ' cost_mart=' || {S('cost_mart')} || ' diff=' || {S('d_cost')}"),
    (3, "segments match across marts", "pnl_only = 0 AND var_only = 0",
     f"'pnl_only=' || {S('pnl_only')} || ' var_only=' || {S('var_only')}"),
    (4, "metric dict covers all marts", "dict_missing = 0", f"'missing=' || {S('dict_missing')}"),
]), ("g5_a",))

cte("g6_a", """SELECT * FROM
  (SELECT sum(CASE WHEN gross_margin_pct NOT BETWEEN -100 AND 100 OR operating_margin_pct NOT BETWEEN -100 AND 100
                   THEN 1 ELSE 0 END) AS out_of_range,
          sum(CASE WHEN revenue < 0 THEN 1 ELSE 0 END) AS negative FROM pnl) p,
  (SELECT count(*) AS keys_missing FROM (VALUES ('revenue'), ('cogs'), ('gross_margin'), ('gross_margin_pct'), ('opex'),
     ('operating_income'), ('operating_margin_pct'), ('revenue_mom_change'), ('cost_mom_change'), ('oi_variance_pct'),
     ('is_material_variance')) r(k) WHERE k NOT IN (SELECT metric_key FROM dict)) k,
  (SELECT sum(CASE WHEN is_drift_warning THEN 1 ELSE 0 END) AS warnings FROM drift) w""", ("pnl", "dict", "drift"))
cte("g6", gate_rows("g6", "g6_a", [
    (1, "percentage metrics within [-100, 100]", "out_of_range = 0", f"'out_of_range=' || {S('out_of_range')}"),
    (2, "revenue never negative", "negative = 0", f"'negative=' || {S('negative')}"),
    (3, "all governed metrics still defined", "keys_missing = 0", f"'missing=' || {S('keys_missing')}"),
    (4, "operating margin drift", "true", f"'warnings=' || {S('warnings')}", "warning"),
]), ("g6_a",))

cte("gate_all", """SELECT 1 AS gate_no, * FROM g1 UNION ALL SELECT 2, * FROM g2 UNION ALL SELECT 3, * FROM g3
UNION ALL SELECT 4, * FROM g4 UNION ALL SELECT 5, * FROM g5 UNION ALL SELECT 6, * FROM g6""",
    ("g1", "g2", "g3", "g4", "g5", "g6"))


# ---------------------------------------------------------------- model tests
MODEL_CTE = {
    "stg_erp_gl_entries": "stg_gl", "stg_fx_rates": "stg_fx", "stg_payroll_entries": "stg_payroll",
    "int_entries_fx_converted": "int_fx", "int_entries_cost_centre_mapped": "int_mapped",
    "dim_cost_centres": "a_dim_cost_centres", "dim_projects": "a_dim_projects", "mart_pnl_summary": "pnl",
    "mart_revenue_trends": "revenue_trends", "mart_cost_analysis": "cost_analysis", "mart_variance_analysis": "variance",
    "mart_metric_dictionary": "dict",
}


def model_tests_sql() -> str:
    from ledgerspark.operators.checks import MODEL_RULES
    parts = []
    for model, rules in MODEL_RULES.items():
        t = MODEL_CTE[model]
        for i, r in enumerate(rules):
            c = r.columns[0]
            if r.test == "not_null":
                f = f"(SELECT count(*) FROM {t} WHERE {c} IS NULL)"
            elif r.test == "accepted_values" and r.ref is None:
                vals = ", ".join(f"'{v}'" for v in r.values)
                f = f"(SELECT count(DISTINCT {c}) FROM {t} WHERE {c} NOT IN ({vals}))"
            elif r.test == "accepted_values":
                rt = MODEL_CTE[r.ref]
                f = (f"(SELECT count(*) FROM (SELECT DISTINCT {c} AS v FROM {t} WHERE {c} IS NOT NULL) x "
                     f"WHERE NOT EXISTS (SELECT 1 FROM {rt} p WHERE p.{r.ref_column} = x.v))")
            elif r.test == "unique":
                f = f"(SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1) x)"
            elif r.test == "unique_combination":
                cs = ", ".join(r.columns)
                f = f"(SELECT count(*) FROM (SELECT {cs} FROM {t} GROUP BY {cs} HAVING count(*) > 1) x)"
            else:  # relationships
                rt = MODEL_CTE[r.ref]
                f = (f"(SELECT count(*) FROM {t} x WHERE x.{c} IS NOT NULL "
                     f"AND NOT EXISTS (SELECT 1 FROM {rt} p WHERE p.{r.ref_column} = x.{c}))")
            parts.append(f"SELECT '{model}' AS model, CAST({i} AS BIGINT) AS rule_no, '{r.test}' AS test, "
                         f"'{','.join(r.columns)}' AS column_name, CAST({f} AS BIGINT) AS failures")
    body = "\nUNION ALL\n".join(parts)
    return sql(f"SELECT *, coalesce(failures = 0, false) AS passed FROM (\n{body}\n) t", *MODEL_CTE.values())


# ---------------------------------------------------------------- anomaly injection
RUN_AT = "2026-01-01 00:00:00"

cte("m_gl_first", "SELECT min(entry_id) AS id FROM stg_gl", ("stg_gl",))
cte("m_rev_first", "SELECT min(entry_id) AS id FROM stg_gl WHERE account_type = 'Revenue'", ("stg_gl",))
cte("m_pay_first", "SELECT min(allocation_id) AS id FROM stg_payroll", ("stg_payroll",))
cte("m_fx_target", """SELECT entry_id, entry_date, currency FROM stg_gl
WHERE currency IS DISTINCT FROM 'INR' AND entry_id IS NOT NULL
ORDER BY entry_id, entry_date NULLS FIRST, currency NULLS FIRST LIMIT 1""", ("stg_gl",))
cte("m_fx_first", """SELECT rate_date, from_currency FROM stg_fx WHERE rate_date IS NOT NULL
ORDER BY rate_date, CASE from_currency WHEN 'USD' THEN 1 WHEN 'EUR' THEN 2 WHEN 'GBP' THEN 3 WHEN 'AED' THEN 4 ELSE 99 END,
  from_currency LIMIT 1""", ("stg_fx",))

cte("mut_duplicate_entry_id", """SELECT * FROM stg_gl UNION ALL
SELECT * FROM stg_gl WHERE entry_id = (SELECT id FROM m_gl_first)""", ("stg_gl", "m_gl_first"))
cte("mut_null_entry_date", """SELECT * REPLACE (CASE WHEN entry_id = (SELECT id FROM m_gl_first) THEN NULL
  ELSE entry_date END AS entry_date) FROM stg_gl""", ("stg_gl", "m_gl_first"))
cte("mut_invalid_account_type", """SELECT * REPLACE (CASE WHEN entry_id = (SELECT id FROM m_gl_first) THEN 'Miscellaneous'
  ELSE account_type END AS account_type) FROM stg_gl""", ("stg_gl", "m_gl_first"))
cte("mut_invalid_currency", """SELECT * REPLACE (CASE WHEN entry_id = (SELECT id FROM m_gl_first) THEN 'JPY'
  ELSE currency END AS currency) FROM stg_gl""", ("stg_gl", "m_gl_first"))
cte("mut_negative_revenue_amount", """SELECT * REPLACE (CASE WHEN entry_id = (SELECT id FROM m_rev_first) THEN -abs(amount)
  ELSE amount END AS amount) FROM stg_gl""", ("stg_gl", "m_rev_first"))
cte("mut_missing_fx_rate_for_used_date", """SELECT * FROM stg_fx f
WHERE NOT EXISTS (SELECT 1 FROM m_fx_target t WHERE f.rate_date = t.entry_date AND f.from_currency = t.currency)""",
    ("stg_fx", "m_fx_target"))
cte("mut_zero_fx_rate", """SELECT rate_date, from_currency, to_currency, CASE WHEN pos = 1 THEN CAST(0 AS DECIMAL(12,6)) ELSE rate END AS rate
FROM (SELECT *, row_number() OVER (ORDER BY rate_date NULLS LAST,
        CASE from_currency WHEN 'USD' THEN 1 WHEN 'EUR' THEN 2 WHEN 'GBP' THEN 3 WHEN 'AED' THEN 4 ELSE 99 END, from_currency) AS pos
      FROM stg_fx) q""", ("stg_fx",))
cte("mut_duplicate_payroll_allocation_id", """SELECT * FROM stg_payroll UNION ALL
SELECT * FROM stg_payroll WHERE allocation_id = (SELECT id FROM m_pay_first)""", ("stg_payroll", "m_pay_first"))
cte("mut_negative_hours_logged", """SELECT * REPLACE (CASE WHEN allocation_id = (SELECT id FROM m_pay_first)
  THEN CAST(-10.0 AS DECIMAL(8,2)) ELSE hours_logged END AS hours_logged) FROM stg_payroll""",
    ("stg_payroll", "m_pay_first"))

# (type, file, gate, expected, detail SQL)
ANOMALY_SQL = [
    ("duplicate_entry_id", "erp_gl_entries.csv", "g1", True,
     "'duplicated row with entry_id=' || (SELECT id FROM m_gl_first)"),
    ("null_entry_date", "erp_gl_entries.csv", "g1", True,
     "'set entry_date to null on entry_id=' || (SELECT id FROM m_gl_first)"),
    ("invalid_account_type", "erp_gl_entries.csv", "g1", True,
     "'set account_type=''Miscellaneous'' (not in Revenue/COGS/OpEx) on entry_id=' || (SELECT id FROM m_gl_first)"),
    ("invalid_currency", "erp_gl_entries.csv", "g1", True,
     "'set currency=''JPY'' (not in INR/USD/EUR/GBP/AED) on entry_id=' || (SELECT id FROM m_gl_first)"),
    ("negative_revenue_amount", "erp_gl_entries.csv", "g1", False,
     "(SELECT max('flipped Revenue entry_id=' || entry_id || ' amount ' || CAST(amount AS VARCHAR) || ' -> ' "
     "|| CAST(-abs(amount) AS VARCHAR) || ' (G1-G3 don''t check amount sign per account_type — only G6 post-dbt does)') "
     "FROM stg_gl WHERE entry_id = (SELECT id FROM m_rev_first))"),
    ("missing_fx_rate_for_used_date", "fx_rates.csv", "g2", True,
     "(SELECT max('removed fx_rates row(s) for (' || CAST(entry_date AS VARCHAR) || ', ' || currency "
     "|| '), still used by entry_id=' || entry_id) FROM m_fx_target)"),
    ("zero_fx_rate", "fx_rates.csv", "g2", True,
     "(SELECT 'set fx rate to 0 for ' || CAST(rate_date AS VARCHAR) || '/' || from_currency FROM m_fx_first)"),
    ("duplicate_payroll_allocation_id", "payroll_entries.csv", "g3", True,
     "'duplicated row with allocation_id=' || (SELECT id FROM m_pay_first)"),
    ("negative_hours_logged", "payroll_entries.csv", "g3", True,
     "'set hours_logged=-10.0 on allocation_id=' || (SELECT id FROM m_pay_first)"),
]

_sc_parts, _sc_deps = [], ["stg_gl", "m_gl_first", "m_rev_first", "m_pay_first", "m_fx_target", "m_fx_first"]
for _t, _f, _g, _e, _d in ANOMALY_SQL:
    _m = f"mut_{_t}"
    _p = f"mg_{_t}"
    if _g == "g1":
        g1_ctes(_p, _m)
    elif _g == "g2":
        g2_ctes(_p, _m if _f == "fx_rates.csv" else "stg_fx", "stg_gl")
    else:
        g3_ctes(_p, _m)
    _sc_deps.append(_p)
    _sc_parts.append(f"SELECT '{_t}' AS anomaly_type, '{_f}' AS target_file, '{_g}' AS gate_checked, {_d} AS mutation_detail, "
                     f"{str(_e).lower()} AS expected_to_be_caught, "
                     f"(SELECT count(*) FROM {_p} WHERE severity = 'hard' AND NOT passed) > 0 AS was_caught")
cte("scorecard", "SELECT *, was_caught = expected_to_be_caught AS matches_expectation FROM (\n"
    + "\nUNION ALL\n".join(_sc_parts) + "\n) s", tuple(_sc_deps))

cte("escapes", f"""SELECT sha256('ai5:' || anomaly_type || ':' || '{RUN_AT}') AS review_id,
  CAST('{RUN_AT}' AS TIMESTAMP) AS run_at, 'ai5_synthetic_anomaly' AS source_chain,
  '[AI-5 SYNTHETIC ANOMALY ESCAPED DETECTION] anomaly=''' || anomaly_type || ''' file=' || target_file
    || ' gate_checked=' || gate_checked || ' expected_to_be_caught='
    || CASE WHEN expected_to_be_caught THEN 'True' ELSE 'False' END || ' — ' || mutation_detail AS claim_text,
  CAST(NULL AS DOUBLE) AS self_reported_score, CAST(NULL AS DOUBLE) AS second_judge_score,
  CAST(NULL AS DOUBLE) AS retrieval_grounding_score, CAST(0.0 AS DOUBLE) AS confidence_score,
  'human_review' AS routing_band, CAST(NULL AS VARCHAR) AS reviewer_verdict, CAST(NULL AS VARCHAR) AS reviewer_reason_code,
  CAST(NULL AS VARCHAR) AS reviewer_edited_text, CAST(NULL AS TIMESTAMP) AS reviewed_at, CAST(NULL AS VARCHAR) AS reviewed_by
FROM scorecard WHERE NOT was_caught""", ("scorecard",))


# ---------------------------------------------------------------- narratives
def _ws() -> str:
    from ledgerspark.functions.text import ws_class
    return ws_class()


WSR = _ws()


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '\\A{WSR}+|{WSR}+\\z', '', 'g')"


def claims_list_sql(text: str) -> str:
    flat = strip_sql(f"replace({text}, chr(10), ' ')")
    marked = f"regexp_replace({flat}, '([.!?]){WSR}+([A-Z])', '\\1' || chr(1) || '\\2', 'g')"
    return (f"list_filter(list_transform(string_split({marked}, chr(1)), lambda s: {strip_sql('s')}), "
            f"lambda s: length(s) > 0 AND regexp_matches(s, '\\p{{Nd}}'))")


FIGURE_RE2 = rf"(?i)(\p{{Nd}}{{1,4}}(?:,\p{{Nd}}{{3}})*(?:\.\p{{Nd}}+)?){WSR}*(?:Cr\b|%|percent\b)"


def fmt2(x: str) -> str:
    return f"coalesce(CAST(CAST({x} AS DECIMAL(18,2)) AS VARCHAR), 'n/a')"


cte("doc_claims", f"""SELECT doc_id, CAST(generate_subscripts(l, 1) AS BIGINT) AS claim_no, unnest(l) AS claim_text
FROM (SELECT doc_id, {claims_list_sql('text')} AS l FROM documents) d""")

cte("pnl_g", """SELECT period_month, segment, round(revenue / 10000000, 2) AS revenue_cr,
  round(gross_margin / 10000000, 2) AS gross_margin_cr, gross_margin_pct,
  round(operating_income / 10000000, 2) AS operating_income_cr, operating_margin_pct FROM pnl""", ("pnl",))

cte("narr", f"""SELECT strftime(period_month, '%Y-%m') || '|' || coalesce(segment, 'Unmapped') AS narrative_id,
  period_month, segment, h,
  coalesce(segment, 'Unmapped') || ' revenue reached '
    || {fmt2("revenue_cr + CASE WHEN h % 4 = 0 THEN CAST(0.37 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END")}
    || ' Cr in ' || strftime(period_month, '%b %Y') || '. Gross margin was '
    || {fmt2("gross_margin_pct + CASE WHEN h % 7 = 0 THEN CAST(1.3 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END")}
    || '% of revenue. Operating income stood at ' || {fmt2("operating_income_cr")} || ' Cr, a margin of '
    || {fmt2("operating_margin_pct")} || ' percent. Trading was in line with plan.' AS text,
  coalesce(segment, 'Unmapped') || ' revenue at ' || {fmt2("revenue_cr")} || ' Cr in '
    || strftime(period_month, '%b %Y') || '.' AS card
FROM (SELECT *, ((year(period_month) * 100 + month(period_month)) * 31
                 + (coalesce(ascii(segment), 0) * 7 + coalesce(length(segment), 0)) * 131) % 1009 AS h
      FROM pnl_g) t""", ("pnl_g",))

cte("narr_claims", f"""SELECT narrative_id, h, CAST(generate_subscripts(l, 1) AS BIGINT) AS claim_no, unnest(l) AS claim_text
FROM (SELECT narrative_id, h, {claims_list_sql('text')} AS l FROM narr) d""", ("narr",))

cte("mart_vals", """SELECT v AS value FROM (
  SELECT unnest([revenue_cr, gross_margin_cr, gross_margin_pct, operating_income_cr, operating_margin_pct]) AS v FROM pnl_g
) x WHERE v IS NOT NULL""", ("pnl_g",))

cte("grounded", f"""SELECT c.narrative_id, c.claim_no, c.claim_text,
  coalesce(f.n_figures, 0) AS n_figures, coalesce(f.n_matched, 0) AS n_matched,
  CASE WHEN coalesce(f.n_figures, 0) = 0 THEN 0.5
       ELSE CAST(f.n_matched AS DOUBLE) / CAST(f.n_figures AS DOUBLE) END AS grounding_score
FROM narr_claims c LEFT JOIN (
  SELECT narrative_id, claim_no, count(*) AS n_figures,
    CAST(sum(CASE WHEN EXISTS (SELECT 1 FROM mart_vals m WHERE abs(fig - m.value) <= 0.05) THEN 1 ELSE 0 END) AS BIGINT) AS n_matched
  FROM (SELECT narrative_id, claim_no,
          unnest(list_transform(regexp_extract_all(claim_text, '{FIGURE_RE2}', 1), lambda x: CAST(translate(replace(x, ',', ''), '{OTHER_DIGITS}', '{ASCII_DIGITS}') AS DOUBLE))) AS fig
        FROM narr_claims) q
  GROUP BY narrative_id, claim_no
) f ON c.narrative_id = f.narrative_id AND c.claim_no = f.claim_no""", ("narr_claims", "mart_vals"))


def response_sql(v: str, sup: str, conf: str) -> str:
    return (f"CASE WHEN {v} = 0 THEN '{{\"supported\": ' || {sup} || ', \"confidence\": ' || {conf} || '}}' "
            f"WHEN {v} = 1 THEN '```json' || chr(10) || '{{\"supported\": ' || {sup} || ', \"confidence\": ' || {conf} "
            f"|| '}}' || chr(10) || '```' "
            f"WHEN {v} = 2 THEN '{{\"supported\": \"' || {sup} || '\", \"confidence\": \"' || {conf} || '\"}}' "
            f"WHEN {v} = 3 THEN 'Supported: ' || {sup} || ' (confidence ' || {conf} || ')' "
            f"WHEN {v} = 4 THEN '{{}}' "
            f"WHEN {v} = 6 THEN '{{''supported'': ' || {sup} || ', ''confidence'': ' || {conf} || '}}' "
            f"WHEN {v} = 7 THEN '{{\"supported\": ' || {sup} || ', \"confidence\": ' || {conf} || '}} {{\"x\": 1}}' "
            f"WHEN {v} = 8 THEN '{{\"supported\": [], \"confidence\": ' || {conf} || '}}' "
            f"WHEN {v} = 9 THEN '{{\"supported\": ' || {sup} || ', \"confidence\": \"' || {conf} || 'd\"}}' "
            f"WHEN {v} = 10 THEN '{{\"note\": {{\"supported\": \"x\"}}, \"supported\": ' || {sup} || ', \"confidence\": ' || {conf} || '}}' "
            f"ELSE '```' || chr(10) || '{{\"confidence\": ' || {conf} || ', \"supported\": ' || {sup} || '}}' "
            f"|| chr(10) || '```' END")


cte("responses", f"""SELECT narrative_id, claim_no,
  {response_sql('hc % 11', "CASE WHEN hc % 5 = 0 THEN 'false' ELSE 'true' END",
                "'0.' || lpad(CAST(50 + hc % 50 AS VARCHAR), 2, '0')")} AS self_response,
  {response_sql('(hc * 5 + 3) % 11', "CASE WHEN hc % 3 = 0 THEN 'false' ELSE 'true' END",
                "'0.' || lpad(CAST(40 + (hc * 3) % 60 AS VARCHAR), 2, '0')")} AS judge_response
FROM (SELECT narrative_id, claim_no, (h * 7 + claim_no * 101) % 1013 AS hc FROM narr_claims) t""", ("narr_claims",))


def parse_sql(raw: str, p: str) -> str:
    """Columns {p}_supported, {p}_confidence, {p}_parse_ok from a response column."""
    clean = strip_sql(f"replace(replace({raw}, '```json', ''), '```', '')")
    return f"""(SELECT CASE WHEN ok THEN sup ELSE false END AS supported,
        CASE WHEN ok THEN conf ELSE 0.0 END AS confidence, coalesce(ok, false) AS parse_ok FROM (
      SELECT *, is_obj AND conf IS NOT NULL AS ok FROM (
        SELECT is_obj,
          CASE WHEN NOT is_obj THEN false
               WHEN json_type(c, '$.supported') IS NULL OR json_type(c, '$.supported') = 'NULL' THEN false
               WHEN json_type(c, '$.supported') = 'VARCHAR' THEN length(json_extract_string(c, '$.supported')) > 0
               WHEN json_type(c, '$.supported') = 'BOOLEAN' THEN json_extract_string(c, '$.supported') = 'true'
               WHEN json_type(c, '$.supported') IN ('ARRAY', 'OBJECT') THEN CAST(json_extract(c, '$.supported') AS VARCHAR) NOT IN ('[]', '{{}}')
               ELSE TRY_CAST(json_extract_string(c, '$.supported') AS DOUBLE) <> 0 END AS sup,
          CASE WHEN NOT is_obj THEN NULL
               WHEN json_type(c, '$.confidence') IS NULL THEN 0.0
               WHEN json_type(c, '$.confidence') = 'NULL' THEN NULL
               WHEN json_type(c, '$.confidence') = 'BOOLEAN' THEN
                    CASE WHEN json_extract_string(c, '$.confidence') = 'true' THEN 1.0 ELSE 0.0 END
               ELSE TRY_CAST({strip_sql("json_extract_string(c, '$.confidence')")} AS DOUBLE) END AS conf
        FROM (SELECT c, coalesce(starts_with(c, '{{') AND ends_with(c, '}}') AND json_valid(c), false) AS is_obj
              FROM (SELECT {clean} AS c) a) b) x) y)"""


cte("judged", f"""SELECT r.narrative_id, r.claim_no,
  s.supported AS self_supported, s.confidence AS self_confidence, s.parse_ok AS self_parse_ok,
  j.supported AS judge_supported, j.confidence AS judge_confidence, j.parse_ok AS judge_parse_ok,
  CASE WHEN s.supported THEN s.confidence ELSE 1.0 - s.confidence END AS self_score,
  CASE WHEN j.supported THEN j.confidence ELSE 1.0 - j.confidence END AS judge_score
FROM responses r, LATERAL {parse_sql('r.self_response', 's')} s, LATERAL {parse_sql('r.judge_response', 'j')} j""",
    ("responses",))

cte("scored", f"""SELECT g.narrative_id, g.claim_no,
  sha256(g.narrative_id || '|' || CAST(g.claim_no AS VARCHAR)) AS review_id,
  CAST('{RUN_AT}' AS TIMESTAMP) AS run_at, 'ai1_pnl_narrative' AS source_chain, g.claim_text,
  round(j.self_score, 3) AS self_reported_score, round(j.judge_score, 3) AS second_judge_score,
  round(g.grounding_score, 3) AS retrieval_grounding_score, round(comp, 3) AS confidence_score,
  CASE WHEN comp >= 0.85 THEN 'auto_accept' WHEN comp >= 0.55 THEN 'human_review' ELSE 'rejected' END AS routing_band,
  CAST(NULL AS VARCHAR) AS reviewer_verdict, CAST(NULL AS VARCHAR) AS reviewer_reason_code,
  CAST(NULL AS VARCHAR) AS reviewer_edited_text, CAST(NULL AS TIMESTAMP) AS reviewed_at, CAST(NULL AS VARCHAR) AS reviewed_by,
  j.self_parse_ok, j.judge_parse_ok
FROM (SELECT g.*, j.self_score, j.judge_score,
        CAST(0.2 AS DOUBLE) * j.self_score + CAST(0.35 AS DOUBLE) * j.judge_score
        + CAST(0.45 AS DOUBLE) * g.grounding_score AS comp
      FROM grounded g LEFT JOIN judged j ON g.narrative_id = j.narrative_id AND g.claim_no = j.claim_no) g
LEFT JOIN judged j ON g.narrative_id = j.narrative_id AND g.claim_no = j.claim_no""", ("grounded", "judged"))


# ---------------------------------------------------------------- verdicts, headlines, snippets, facts
def _clean(x: str) -> str:
    return strip_sql(f"replace(replace({x}, '```json', ''), '```', '')")


cte("vresp", """SELECT narrative_id, h, CASE WHEN h % 5 = 0 THEN '```json' || chr(10) || js || chr(10) || '```'
                              WHEN h % 5 = 1 THEN js || ' and that is all, {' ELSE js END AS verdict_response
FROM (
  SELECT a.narrative_id, n.h, CAST(json_object(
      'verdict', CASE WHEN a.inconsistent = 0 OR n.h % 5 = 2 THEN 'PASS' ELSE 'FAIL' END,
      'total_claims', a.total_claims, 'consistent', a.consistent, 'inconsistent', a.inconsistent,
      'unverifiable', a.unverifiable, 'issues', a.issues) AS VARCHAR) AS js
  FROM (SELECT narrative_id, count(*) AS total_claims,
          sum(CASE WHEN status IS NULL THEN 1 ELSE 0 END) AS consistent,
          sum(CASE WHEN status = 'INCONSISTENT' THEN 1 ELSE 0 END) AS inconsistent,
          sum(CASE WHEN status = 'UNVERIFIABLE' THEN 1 ELSE 0 END) AS unverifiable,
          list(json_object('claim', claim_text, 'expected', 'value in mart_pnl_summary', 'status', status))
            FILTER (WHERE status IS NOT NULL) AS issues
        FROM (SELECT *, CASE WHEN n_figures = 0 THEN 'UNVERIFIABLE' WHEN grounding_score < 1.0 THEN 'INCONSISTENT' END
                AS status FROM grounded) g
        GROUP BY narrative_id) a
  JOIN narr n ON a.narrative_id = n.narrative_id
) t""", ("grounded", "narr"))

cte("verdicts", f"""SELECT narrative_id, ok AS parse_ok,
  CASE WHEN ok THEN coalesce(json_extract_string(c, '$.verdict'), 'UNKNOWN') END AS verdict,
  CASE WHEN ok THEN coalesce(CAST(json_extract(c, '$.total_claims') AS BIGINT), 0) END AS total_claims,
  CASE WHEN ok THEN coalesce(CAST(json_extract(c, '$.consistent') AS BIGINT), 0) END AS consistent,
  CASE WHEN ok THEN coalesce(CAST(json_extract(c, '$.inconsistent') AS BIGINT), 0) END AS inconsistent,
  CASE WHEN ok THEN coalesce(CAST(json_extract(c, '$.unverifiable') AS BIGINT), 0) END AS unverifiable,
  CASE WHEN ok THEN CAST(coalesce(json_array_length(c, '$.issues'), 0) AS BIGINT) END AS n_issues,
  CASE WHEN ok THEN CASE WHEN coalesce(len(list_filter(json_extract_string(c, '$.issues[*].status'),
                                                       lambda s: s = 'INCONSISTENT')), 0) > 0
                         THEN 'FAIL' ELSE 'PASS' END END AS rule_verdict,
  ok AND coalesce(json_extract_string(c, '$.verdict') = 'PASS', false) AS passed
FROM (SELECT narrative_id, ok, CASE WHEN ok THEN c0 ELSE '{{}}' END AS c FROM (
        SELECT narrative_id, c0, coalesce(starts_with(c0, '{{') AND ends_with(c0, '}}') AND json_valid(c0), false) AS ok
        FROM (SELECT narrative_id, {_clean('verdict_response')} AS c0 FROM vresp) a) b) bb""", ("vresp",))

cte("hresp", """SELECT narrative_id, CASE WHEN h % 3 = 0 THEN text || chr(10) || '===CARD_HEADLINE===' || chr(10) || card
                             WHEN h % 3 = 1 THEN text || chr(10) || '===CARD_HEADLINE===' || '   '
                             ELSE text END AS response FROM narr""", ("narr",))

cte("headlines", f"""SELECT narrative_id,
  CASE WHEN use THEN {strip_sql('before')} ELSE whole END AS narrative,
  CASE WHEN use THEN head ELSE regexp_replace({strip_sql("split_part(whole, '. ', 1)")}, '\\.+\\z', '', 'g') || '.' END
    AS headline,
  NOT use AS used_fallback
FROM (SELECT *, coalesce(pos > 0 AND length(head) > 0, false) AS use FROM (
  SELECT narrative_id, pos, CASE WHEN pos > 0 THEN substring(response, 1, pos - 1) END AS before,
    CASE WHEN pos > 0 THEN {strip_sql("substring(response, pos + 19)")} END AS head,
    {strip_sql('response')} AS whole
  FROM (SELECT narrative_id, response, position('===CARD_HEADLINE===' IN response) AS pos FROM hresp) a) b) c""",
    ("hresp",))


def words_sql(x: str) -> str:
    return f"CASE WHEN {strip_sql(x)} = '' THEN CAST([] AS VARCHAR[]) ELSE regexp_split_to_array({strip_sql(x)}, '{WSR}+') END"


cte("snippets", f"""SELECT doc_id, snippet_text, CAST(len({words_sql('snippet_text')}) AS BIGINT) AS word_count,
  CAST(len(w) AS BIGINT) AS source_words, len(w) > 25 AS truncated
FROM (SELECT doc_id, w, CASE WHEN len(w) <= 25 THEN text
                             ELSE regexp_replace(array_to_string(w[1:25], ' '), '[.,;:]+\\z', '', 'g') || '…' END AS snippet_text
      FROM (SELECT doc_id, text, {words_sql('text')} AS w FROM documents WHERE length({strip_sql('text')}) > 0) a) b""")

cte("facts", """SELECT v.segment, v.volatility, v.oi_var_min, v.oi_var_max, v.volatility = t.top AS is_most_volatile,
  p.peak_month, p.peak_revenue_cr, p.peak_share_pct, d.dominant_cost_type, d.dominant_cost_share_pct
FROM (SELECT segment, max(abs(oi_variance_pct)) AS volatility, min(oi_variance_pct) AS oi_var_min,
             max(oi_variance_pct) AS oi_var_max FROM variance GROUP BY segment) v
CROSS JOIN (SELECT max(abs(oi_variance_pct)) AS top FROM variance) t
LEFT JOIN (
  SELECT s.segment, s.peak_month, round(s.peak_revenue / 10000000, 2) AS peak_revenue_cr,
    CASE WHEN m.month_revenue = 0 THEN NULL
         ELSE round(CAST(s.peak_revenue AS DOUBLE) / CAST(m.month_revenue AS DOUBLE) * 100, 2) END AS peak_share_pct
  FROM (SELECT segment, max({'r': revenue, 'p': period_month}).p AS peak_month,
               max({'r': revenue, 'p': period_month}).r AS peak_revenue FROM pnl GROUP BY segment) s
  LEFT JOIN (SELECT period_month, CAST(sum(revenue) AS DECIMAL(38,2)) AS month_revenue FROM pnl GROUP BY period_month) m
    ON s.peak_month = m.period_month
) p ON v.segment IS NOT DISTINCT FROM p.segment
LEFT JOIN (
  SELECT segment, max({'c': c, 't': account_type}).t AS dominant_cost_type,
    CASE WHEN sum(c) = 0 THEN NULL
         ELSE round(CAST(max({'c': c, 't': account_type}).c AS DOUBLE) / CAST(CAST(sum(c) AS DECIMAL(38,2)) AS DOUBLE) * 100, 2)
    END AS dominant_cost_share_pct
  FROM (SELECT segment, account_type, CAST(sum(cost_inr) AS DECIMAL(38,2)) AS c FROM cost_analysis
        GROUP BY segment, account_type) x GROUP BY segment
) d ON v.segment IS NOT DISTINCT FROM d.segment""", ("variance", "pnl", "cost_analysis"))

# ---------------------------------------------------------------- review queue
REVIEWED_AT = "2026-01-02 09:30:00"

cte("decisions", f"""SELECT review_id,
  CASE k % 4 WHEN 0 THEN 'approved' WHEN 1 THEN 'edited' WHEN 2 THEN 'rejected' END AS decision,
  CASE WHEN k % 4 = 2 THEN ['matches_mart_data', 'stale_snapshot', 'rounding_discrepancy', 'wrong_segment_attribution',
                            'unsupported_by_retrieval', 'hallucinated_metric', 'other'][k % 7 + 1] END AS reason_code,
  CASE WHEN k % 4 = 1 THEN claim_text || ' [edited]' END AS edited_text,
  CAST('{REVIEWED_AT}' AS TIMESTAMP) AS reviewed_at, 'reviewer' AS reviewed_by
FROM (SELECT *, CAST(('0x' || substr(review_id, 1, 2)) AS INTEGER) AS k FROM scored) q""", ("scored",))

cte("applied", """SELECT q.review_id, q.run_at, q.source_chain, q.claim_text, q.self_reported_score, q.second_judge_score,
  q.retrieval_grounding_score, q.confidence_score, q.routing_band,
  CASE WHEN d.decision IN ('approved', 'edited', 'rejected') THEN d.decision ELSE q.reviewer_verdict END AS reviewer_verdict,
  CASE WHEN d.decision = 'approved' THEN 'matches_mart_data' WHEN d.decision = 'rejected' THEN d.reason_code
       ELSE q.reviewer_reason_code END AS reviewer_reason_code,
  CASE WHEN d.decision = 'edited' THEN d.edited_text ELSE q.reviewer_edited_text END AS reviewer_edited_text,
  CASE WHEN d.decision IN ('approved', 'edited', 'rejected') THEN d.reviewed_at ELSE q.reviewed_at END AS reviewed_at,
  CASE WHEN d.decision IN ('approved', 'edited', 'rejected') THEN d.reviewed_by ELSE q.reviewed_by END AS reviewed_by
FROM scored q LEFT JOIN decisions d ON q.review_id = d.review_id""", ("scored", "decisions"))

# ---------------------------------------------------------------- documentation drift
cte("doc_drift", """WITH docs AS (SELECT 'doc-' || CAST(doc_id AS VARCHAR) AS name, source AS layer, text, sha256(text) AS h
                   FROM documents),
cur AS (SELECT name AS model_name, layer, h AS sha256 FROM docs),
doc AS (SELECT name AS model_name, layer,
          CASE WHEN starts_with(h, '0') OR starts_with(h, '1') THEN sha256(text || ' ') ELSE h END AS sha256
        FROM docs WHERE NOT starts_with(h, 'f')
        UNION ALL
        SELECT 'bench-' || CAST(item_id AS VARCHAR), CAST(NULL AS VARCHAR), sha256(text) FROM benchmark)
SELECT coalesce(c.model_name, d.model_name) AS model_name,
  CASE WHEN c.model_name IS NOT NULL THEN c.layer ELSE coalesce(d.layer, 'unknown') END AS layer,
  c.sha256 AS current_sql_hash, d.sha256 AS documented_sql_hash,
  NOT (c.model_name IS NOT NULL AND d.model_name IS NOT NULL AND c.sha256 = d.sha256) AS is_drifted,
  CASE WHEN c.model_name IS NOT NULL AND d.model_name IS NULL THEN 'never_documented'
       WHEN c.model_name IS NOT NULL AND c.sha256 <> d.sha256 THEN 'sql_changed_since_docs'
       WHEN c.model_name IS NOT NULL THEN 'in_sync' ELSE 'doc_entry_orphaned' END AS drift_reason
FROM cur c FULL OUTER JOIN doc d ON c.model_name = d.model_name""")


# ---------------------------------------------------------------- rates with gaps
def variant(prefix: str, *names: str) -> None:
    """Copies of CTEs under a prefix that read each other's copies (and ``<prefix>stg_fx``) instead of the originals."""
    both = {*names, "stg_fx"}
    for n in names:
        deps, body = CTES[n]
        pattern = r"(?<!')\b(" + "|".join(sorted(both, key=len, reverse=True)) + r")\b"
        cte(prefix + n, re.sub(pattern, prefix + r"\1", body), tuple(prefix + d if d in both else d for d in deps))


GAPS = """(from_currency = 'AED' AND date_diff('day', DATE '1990-01-01', rate_date) % 7 = 3)
  OR (from_currency = 'USD' AND date_diff('day', DATE '1990-01-01', rate_date) % 41 = 5)"""
cte("gap_stg_fx", f"SELECT * FROM stg_fx WHERE NOT ({GAPS})", ("stg_fx",))
variant("gap_", "int_fx", "int_mapped", "pnl", "g4_a", "g4")
g2_ctes("gap_g2", "gap_stg_fx", "stg_gl")


# ---------------------------------------------------------------- JSON records
def _record(columns: list[tuple[str, str]]) -> str:
    parts = []
    for name, kind in columns:
        if kind == "date":
            v = f"'\"' || strftime({name}, '%Y-%m-%dT00:00:00.000') || '\"'"
        elif kind == "boolean":
            v = f"CASE WHEN {name} THEN 'true' WHEN NOT {name} THEN 'false' END"
        elif kind == "number":
            v = f"regexp_replace(CAST({name} AS VARCHAR), '(\\.\\d+?)0*$', '\\1')"
        else:
            v = f"CAST(to_json({name}) AS VARCHAR)"
        parts.append(f"'\"{name}\":' || coalesce({v}, 'null')")
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


VARIANCE_ORDER = "is_material_variance DESC NULLS LAST, period_month ASC NULLS LAST, segment ASC NULLS LAST"
DRIVER_ORDER = ("abs(coalesce(mom_change_pct, 0)) DESC, period_month ASC NULLS LAST, segment ASC NULLS LAST, "
                "cost_centre ASC NULLS LAST, account_code ASC NULLS LAST")
VARIANCE_RECORD = [("period_month", "date"), ("segment", "text"), ("revenue", "number"), ("prev_revenue", "number"),
                   ("revenue_variance_pct", "number"), ("gross_margin", "number"), ("gm_variance_pct", "number"),
                   ("operating_income", "number"), ("oi_variance_pct", "number"), ("is_material_variance", "boolean")]
DRIVER_RECORD = [("period_month", "date"), ("segment", "text"), ("cost_centre_name", "text"), ("account_type", "text"),
                 ("account_name", "text"), ("cost_inr", "number"), ("mom_change_pct", "number")]


def records_json_sql(source: str, order: str, columns: list[tuple[str, str]], k: int = 25) -> str:
    return (f"SELECT '[' || coalesce(string_agg(j, ',' ORDER BY pos), '') || ']' AS records_json FROM (SELECT {_record(columns)} AS j, "
            f"row_number() OVER (ORDER BY {order}) AS pos FROM {source} q QUALIFY pos <= {k}) r")


# ---------------------------------------------------------------- bronze files
ORDER_NO = "CAST(regexp_extract({}, '([0-9]+)', 1) AS BIGINT)"
cte("num_gl", f"SELECT *, {ORDER_NO.format('entry_id')} AS n FROM a_gl", ("a_gl",))
cte("num_pay", f"SELECT *, {ORDER_NO.format('allocation_id')} AS n FROM a_payroll", ("a_payroll",))
cte("cell_gl", """SELECT entry_id, CASE WHEN n % 211 = 3 THEN NULL WHEN n % 223 = 5 THEN '31/12/1996' WHEN n % 227 = 7 THEN '1996-02-31'
    ELSE CAST(entry_date AS VARCHAR) END AS entry_date, project_code, project_name, segment, cost_centre, account_code, account_name,
  account_type, currency, CASE WHEN n % 229 = 9 THEN 'n/a' WHEN n % 233 = 11 THEN NULL WHEN n % 239 = 13 THEN CAST(amount AS VARCHAR) || ' INR'
    ELSE CAST(amount AS VARCHAR) END AS amount, description FROM num_gl
UNION ALL
SELECT 'X' || entry_id, CAST(entry_date AS VARCHAR), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  CASE WHEN n % 509 = 5 THEN CAST(amount AS VARCHAR) END, CASE WHEN n % 509 = 5 THEN 'one' END
FROM num_gl WHERE n % 509 IN (4, 5)""", ("num_gl",))
cte("cell_fx", """SELECT rate_date, from_currency, CASE WHEN day(rate_date) = 31 AND from_currency = 'GBP' THEN NULL ELSE rate END AS rate
FROM a_fx""", ("a_fx",))
cte("cell_pay", """SELECT n, CASE WHEN n % 107 = 0 THEN 'PAY-' || CAST(n - 1 AS VARCHAR) ELSE allocation_id END AS allocation_id,
  CASE WHEN n % 103 <> 2 THEN allocation_date END AS allocation_date, CASE WHEN n % 101 <> 1 THEN employee_id END AS employee_id,
  hours_logged, rate_per_hour FROM num_pay""", ("num_pay",))
cte("typed_gl", """SELECT entry_id, CASE WHEN entry_date NOT IN ('31/12/1996', '1996-02-31') THEN entry_date END AS entry_date,
  TRY_CAST(amount AS DECIMAL(18,2)) AS amount FROM cell_gl""", ("cell_gl",))
cte("cell_audit", """SELECT 'erp_gl_entries' AS source, 'entry_date' AS column_name, 'blank' AS problem, count(*) AS failures FROM cell_gl WHERE entry_date IS NULL
UNION ALL SELECT 'erp_gl_entries', 'entry_date', 'bad_cell', count(*) FROM cell_gl WHERE entry_date IN ('31/12/1996', '1996-02-31')
UNION ALL SELECT 'erp_gl_entries', 'amount', 'blank', count(*) FROM cell_gl WHERE amount IS NULL
UNION ALL SELECT 'erp_gl_entries', 'amount', 'bad_cell', count(*) FROM cell_gl WHERE amount = 'n/a' OR amount LIKE '% INR'
UNION ALL SELECT 'erp_gl_entries', '', 'bad_line', count(*) FROM num_gl WHERE n % 509 IN (4, 5)
UNION ALL SELECT 'fx_rates', 'rate_date', 'blank', 0 UNION ALL SELECT 'fx_rates', 'rate_date', 'bad_cell', 0
UNION ALL SELECT 'fx_rates', 'rate', 'blank', 0
UNION ALL SELECT 'fx_rates', 'rate', 'bad_cell', count(*) FROM cell_fx WHERE rate IS NULL
UNION ALL SELECT 'fx_rates', '', 'bad_line', 0
UNION ALL SELECT 'payroll_entries', 'allocation_date', 'blank', 0
UNION ALL SELECT 'payroll_entries', 'allocation_date', 'bad_cell', count(*) FROM cell_pay WHERE allocation_date IS NULL
UNION ALL SELECT 'payroll_entries', 'hours_logged', 'blank', 0 UNION ALL SELECT 'payroll_entries', 'hours_logged', 'bad_cell', 0
UNION ALL SELECT 'payroll_entries', 'rate_per_hour', 'blank', 0 UNION ALL SELECT 'payroll_entries', 'rate_per_hour', 'bad_cell', 0
UNION ALL SELECT 'payroll_entries', '', 'bad_line', 0""", ("cell_gl", "cell_fx", "cell_pay", "num_gl"))


def source_tests_sql() -> str:
    from ledgerspark.operators.checks import SOURCE_RULES
    tables = {"erp_gl_entries": "typed_gl", "payroll_entries": "cell_pay", "fx_rates": "cell_fx"}
    parts = []
    for source, rules in SOURCE_RULES.items():
        for i, r in enumerate(rules):
            c, t = r.columns[0], tables[source]
            f = (f"(SELECT count(*) FROM {t} WHERE {c} IS NULL)" if r.test == "not_null" else
                 f"(SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1) x)")
            parts.append(f"SELECT '{source}' AS source, CAST({i} AS BIGINT) AS rule_no, '{r.test}' AS test, '{c}' AS column_name, {f} AS failures")
    return sql("SELECT *, failures = 0 AS passed FROM (\n" + "\nUNION ALL\n".join(parts) + "\n) t", *tables.values())


# ---------------------------------------------------------------- corpus of files
cte("corpus_rows", """SELECT coalesce(nullif(source, ''), 'none') AS layer, doc_id // 500 AS part, doc_id, coalesce(text, '') AS text,
  coalesce(lang, 'und') AS lang FROM documents""")
cte("corpus_langs", "SELECT layer, part, lang, count(*) AS n FROM corpus_rows WHERE (part + ascii(right(layer, 1))) % 3 <> 2 GROUP BY ALL", ("corpus_rows",))
cte("corpus_yml", """SELECT layer, part, 'version: 2' || chr(10) || chr(10) || 'models:' || chr(10) || '  - name: part_' || CAST(part AS VARCHAR)
    || chr(10) || '    # by language' || chr(10) || '    columns:' || chr(10)
    || string_agg('      - name: ' || lang || chr(10) || '        tests:' || chr(10) || CASE WHEN n % 2 = 0 THEN '          - not_null' || chr(10)
         ELSE '          - unique' || chr(10) || '          - accepted_values:' || chr(10) || '              values: [''a'', ''b'']' || chr(10) END,
       '' ORDER BY lang) || chr(10) AS yml
FROM corpus_langs GROUP BY layer, part""", ("corpus_langs",))
cte("corpus", """SELECT 'part_' || CAST(r.part AS VARCHAR) AS model_name, r.layer, sha256(r.body) AS sql_sha256,
  CAST(length(r.body) AS BIGINT) AS n_chars, coalesce(y.yml, 'No YAML file found.') AS yml_content
FROM (SELECT layer, part, string_agg(text || chr(10), '' ORDER BY doc_id) AS body FROM corpus_rows GROUP BY layer, part) r
LEFT JOIN corpus_yml y ON y.layer = r.layer AND y.part = r.part""", ("corpus_rows", "corpus_yml"))
cte("corpus_cols", """SELECT layer, 'part_' || CAST(part AS VARCHAR) AS model, lang AS column_name,
  CASE WHEN n % 2 = 0 THEN 'not_null' ELSE 'unique,accepted_values' END AS tests FROM corpus_langs""", ("corpus_langs",))


# ---------------------------------------------------------------- published tables, logs
cte("one_line", """SELECT narrative_id, CASE h % 5 WHEN 0 THEN card WHEN 1 THEN chr(10) || '  ' || card || ' ' || chr(10) || 'A second line.'
  WHEN 2 THEN '  ' || chr(10) || chr(9) || ' ' WHEN 3 THEN text ELSE '' END AS response FROM narr""", ("narr",))
cte("card_headlines", f"""SELECT narrative_id, snippet_text, CAST(len({words_sql('snippet_text')}) AS BIGINT) AS word_count,
  CAST(len(w) AS BIGINT) AS source_words, len(w) > 25 AS truncated
FROM (SELECT narrative_id, w, CASE WHEN len(w) <= 25 THEN line
        ELSE regexp_replace(array_to_string(w[1:25], ' '), '[.,;:]+\\z', '', 'g') || '…' END AS snippet_text
      FROM (SELECT narrative_id, line, {words_sql('line')} AS w
            FROM (SELECT narrative_id, {strip_sql(f"split_part({strip_sql('response')}, chr(10), 1)")} AS line FROM one_line) a
            WHERE line <> '') b) c""", ("one_line",))
cte("snip_table", """SELECT sha256('revenue_trends_headline:' || narrative_id) AS snippet_id, TIMESTAMP '2026-01-02 00:00:00' AS generated_at,
  'revenue_trends_headline' AS snippet_type, snippet_text, word_count, 'ledger-narrative' AS source_model FROM card_headlines""", ("card_headlines",))
cte("snippet_log", """SELECT 'opening' AS run_id, TIMESTAMP '2026-01-01 00:00:00' AS generated_at, narrative_id,
  'revenue_trends_headline' AS snippet_type, snippet_text, word_count FROM card_headlines WHERE narrative_id < '1995-01-01'
UNION ALL SELECT 'closing', TIMESTAMP '2026-01-02 00:00:00', narrative_id, 'revenue_trends_headline', snippet_text, word_count
FROM card_headlines""", ("card_headlines",))
_EARLY = "(SELECT count(*) FROM {} WHERE period_month < DATE '1995-01-01')"
_MARTS = ["pnl", "revenue_trends", "cost_analysis", "variance"]
cte("syncs", "SELECT 'opening' AS sync_run_id, TIMESTAMP '2026-01-01 00:00:00' AS synced_at, "
    + " + ".join([_EARLY.format(t) for t in _MARTS] + ["(SELECT count(*) FROM dict)", "(SELECT count(*) FROM snip_table)"])
    + " AS total_rows_synced UNION ALL SELECT 'closing', TIMESTAMP '2026-01-02 00:00:00', "
    + " + ".join(f"(SELECT count(*) FROM {t})" for t in [*_MARTS, "dict", "snip_table"]), (*_MARTS, "dict", "snip_table"))

# The published tables' columns by kind.
PUBLISHED = {
    "mart_pnl_summary": ("pnl", {"period_month": "date", "segment": "string", "revenue": "double", "cogs": "double", "gross_margin": "double",
                                 "opex": "double", "operating_income": "double", "gross_margin_pct": "double",
                                 "operating_margin_pct": "double", "entry_count": "bigint"}),
    "mart_revenue_trends": ("revenue_trends", {"period_month": "date", "segment": "string", "project_code": "string", "project_name": "string",
                                               "client_name": "string", "revenue_inr": "double", "entry_count": "bigint",
                                               "prev_month_revenue": "double", "mom_change_pct": "double"}),
    "mart_cost_analysis": ("cost_analysis", {"period_month": "date", "segment": "string", "cost_centre": "string", "cost_centre_name": "string",
                                             "cost_centre_location": "string", "cost_centre_country": "string", "account_type": "string",
                                             "account_code": "string", "account_name": "string", "cost_inr": "double",
                                             "entry_count": "bigint", "prev_month_cost": "double", "mom_change_pct": "double"}),
    "mart_variance_analysis": ("variance", {"period_month": "date", "segment": "string", "revenue": "double", "prev_revenue": "double",
                                            "revenue_variance": "double", "revenue_variance_pct": "double", "gross_margin": "double",
                                            "prev_gross_margin": "double", "gm_variance": "double", "gm_variance_pct": "double",
                                            "operating_income": "double", "prev_operating_income": "double", "oi_variance": "double",
                                            "oi_variance_pct": "double", "is_material_variance": "boolean"}),
    "mart_metric_dictionary": ("dict", {"metric_key": "string", "metric_name": "string", "calculation_logic": "string", "unit": "string",
                                        "source_model": "string", "used_in_views": "string"}),
    "ai_narrative_snippets": ("snip_table", {"snippet_id": "string", "generated_at": "timestamp", "snippet_type": "string",
                                             "snippet_text": "string", "word_count": "bigint", "source_model": "string"}),
}


def profile_sql(with_type: bool) -> str:
    total = {"double": "sum(CAST(round(CAST({} AS DOUBLE) * 100) AS DECIMAL(38,0)))", "boolean": "sum(CAST({} AS INTEGER))",
             "date": "sum(date_diff('day', DATE '1970-01-01', {}))", "timestamp": "sum(epoch({}))", "string": "sum(length({}))"}
    total["bigint"] = total["double"]
    parts = []
    for name, (t, columns) in PUBLISHED.items():
        for c, kind in columns.items():
            ctype = f"CASE WHEN count({c}) = 0 THEN 'string' ELSE '{kind}' END AS column_type, " if with_type else ""
            parts.append(f"SELECT '{name}' AS table_name, '{c}' AS column_name, {ctype}count(*) AS n_rows, count({c}) AS n_values, "
                         f"CAST({total[kind].format(c)} AS BIGINT) AS total FROM {t}")
    return sql("\nUNION ALL\n".join(parts), *[t for t, _ in PUBLISHED.values()])

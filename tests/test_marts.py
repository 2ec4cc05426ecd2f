"""Staging, FX conversion, dimension mapping and the marts on tiny hand-made ledgers."""
import datetime as dt
from decimal import Decimal

from ledgerspark.operators import convert, marts, staging

D = dt.date
GL_SCHEMA = ("entry_id string, entry_date date, project_code string, project_name string, segment string, "
             "cost_centre string, account_code string, account_name string, account_type string, currency string, "
             "amount decimal(18,2), description string")
FX_SCHEMA = "rate_date date, from_currency string, to_currency string, rate decimal(12,6)"


def gl_row(i, d, proj, cc, atype, ccy, amt):
    return (f"GL-{i:06d}", d, proj, "n", "s", cc, "4000", "acct", atype, ccy, Decimal(amt), "x")


def dims(spark):
    p = spark.createDataFrame([("P-1", "Proj 1", "Enterprise", "USD", "C1"), ("P-2", "Proj 2", "Internal", "INR", "C2")],
                              "project_code string, project_name string, segment string, billing_currency string, client_name string")
    c = spark.createDataFrame([("CC-A", "A", "Delhi", "India")],
                              "cost_centre string, cost_centre_name string, location string, country string")
    return p, c


def test_fx_conversion_rounds_half_away_and_keeps_rows(spark):
    gl = spark.createDataFrame([
        gl_row(1, D(2026, 1, 1), "P-1", "CC-A", "Revenue", "USD", "100.05"),
        gl_row(2, D(2026, 1, 1), "P-2", "CC-A", "Revenue", "INR", "50.00"),
        gl_row(3, D(2026, 1, 2), "P-1", "CC-A", "COGS", "USD", "-10.00"),   # no rate that day
    ], GL_SCHEMA)
    fx = spark.createDataFrame([(D(2026, 1, 1), "USD", "INR", Decimal("83.250000"))], FX_SCHEMA)
    out = {r.entry_id: r for r in convert.fx_convert(staging.stage_gl(gl), staging.stage_fx(fx)).collect()}
    assert len(out) == 3                                   # never dropped
    assert out["GL-000001"].amount_inr == Decimal("8329.16")  # 100.05 * 83.25 = 8329.1625
    assert out["GL-000002"].fx_rate == Decimal("1.000000") and out["GL-000002"].amount_inr == Decimal("50.00")
    assert out["GL-000003"].amount_inr is None and out["GL-000003"].fx_rate is None


def test_duplicate_rates_fan_out(spark):
    gl = spark.createDataFrame([gl_row(1, D(2026, 1, 1), "P-1", "CC-A", "Revenue", "USD", "1.00")], GL_SCHEMA)
    fx = spark.createDataFrame([(D(2026, 1, 1), "USD", "INR", Decimal("80")), (D(2026, 1, 1), "USD", "INR", Decimal("81"))],
                               FX_SCHEMA)
    assert convert.fx_convert(gl, fx).count() == 2


def test_orphans_flagged_not_dropped(spark):
    p, c = dims(spark)
    gl = spark.createDataFrame([gl_row(1, D(2026, 1, 1), "P-9", "CC-Z", "Revenue", "INR", "10.00"),
                                gl_row(2, D(2026, 1, 1), "P-1", "CC-A", "Revenue", "INR", "10.00")], GL_SCHEMA)
    fx = spark.createDataFrame([], FX_SCHEMA)
    m = {r.entry_id: r for r in convert.map_dimensions(convert.fx_convert(gl, fx), p, c).collect()}
    assert m["GL-000001"].is_orphan_project and m["GL-000001"].is_orphan_cost_centre
    assert m["GL-000001"].segment_governed is None
    assert not m["GL-000002"].is_orphan_project and m["GL-000002"].segment_governed == "Enterprise"


def _mapped(spark, rows):
    p, c = dims(spark)
    gl = spark.createDataFrame(rows, GL_SCHEMA)
    return convert.map_dimensions(convert.fx_convert(gl, spark.createDataFrame([], FX_SCHEMA)), p, c)


def test_pnl_pivot_margins_and_grain(spark):
    m = _mapped(spark, [
        gl_row(1, D(2026, 1, 3), "P-2", "CC-A", "Revenue", "INR", "1000.00"),
        gl_row(2, D(2026, 1, 9), "P-2", "CC-A", "COGS", "INR", "-400.00"),
        gl_row(3, D(2026, 1, 9), "P-2", "CC-A", "OpEx", "INR", "-100.00"),
        gl_row(4, D(2026, 2, 1), "P-2", "CC-A", "OpEx", "INR", "-50.00"),
    ])
    pnl = {r.period_month: r for r in marts.pnl_summary(m).collect()}
    jan = pnl[D(2026, 1, 1)]
    assert (jan.revenue, jan.cogs, jan.opex) == (Decimal("1000.00"), Decimal("-400.00"), Decimal("-100.00"))
    assert jan.gross_margin == Decimal("600.00") and jan.operating_income == Decimal("500.00")
    assert jan.gross_margin_pct == 60.0 and jan.operating_margin_pct == 50.0 and jan.entry_count == 3
    feb = pnl[D(2026, 2, 1)]
    assert feb.revenue == Decimal("0.00") and feb.gross_margin_pct is None   # zero revenue -> null ratio


def test_variance_first_period_and_materiality(spark):
    m = _mapped(spark, [
        gl_row(1, D(2026, 1, 3), "P-2", "CC-A", "Revenue", "INR", "1000.00"),
        gl_row(2, D(2026, 2, 3), "P-2", "CC-A", "Revenue", "INR", "1100.00"),   # +10.0% exactly: not material
        gl_row(3, D(2026, 3, 3), "P-2", "CC-A", "Revenue", "INR", "1300.00"),   # +18.2%: material
    ])
    v = {r.period_month: r for r in marts.variance_analysis(marts.pnl_summary(m)).collect()}
    first = v[D(2026, 1, 1)]
    assert first.prev_revenue is None and first.revenue_variance == Decimal("1000.00")
    assert first.revenue_variance_pct is None and first.is_material_variance is False
    assert v[D(2026, 2, 1)].is_material_variance is False
    assert v[D(2026, 3, 1)].is_material_variance is True
    assert v[D(2026, 3, 1)].oi_variance_pct == 18.18


def test_revenue_mom_uses_abs_and_cost_mom_does_not(spark):
    m = _mapped(spark, [
        gl_row(1, D(2026, 1, 3), "P-1", "CC-A", "Revenue", "INR", "-100.00"),
        gl_row(2, D(2026, 2, 3), "P-1", "CC-A", "Revenue", "INR", "50.00"),
        gl_row(3, D(2026, 1, 3), "P-1", "CC-A", "COGS", "INR", "-200.00"),
        gl_row(4, D(2026, 2, 3), "P-1", "CC-A", "COGS", "INR", "-100.00"),
    ])
    rt = {r.period_month: r for r in marts.revenue_trends(m).collect()}
    assert rt[D(2026, 2, 1)].prev_month_revenue == Decimal("-100.00")
    assert rt[D(2026, 2, 1)].mom_change_pct == 150.0          # (50 - -100) / |-100|
    ca = {r.period_month: r for r in marts.cost_analysis(m).collect()}
    assert ca[D(2026, 1, 1)].cost_inr == Decimal("200.00")    # absolute cost
    assert ca[D(2026, 2, 1)].mom_change_pct == -50.0


def test_metric_dictionary_has_eleven_governed_keys(spark):
    d = marts.metric_dictionary(spark)
    assert d.count() == 11 and d.select("metric_key").distinct().count() == 11
    assert marts.metric_lookup(d, "gross_margin").first().metric_name == "Gross Margin"
    miss = marts.metric_lookup(d, "nope").first()
    assert miss.metric_key is None and "No metric found for key 'nope'" in miss.error

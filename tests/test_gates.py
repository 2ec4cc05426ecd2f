"""Gates pass on clean generated data and fail on one corruption each; the runner stops early."""
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import convert, gates, marts, staging
from ledgerspark.sources import generators as g


@pytest.fixture(scope="module")
def clean(spark):
    gl = g.gen_gl(spark, 500).cache()
    fx = g.gen_fx(spark).cache()
    pay = g.gen_payroll(spark, 200).cache()
    mapped = convert.map_dimensions(convert.fx_convert(staging.stage_gl(gl), staging.stage_fx(fx)),
                                    g.dim_projects(spark), g.dim_cost_centres(spark)).cache()
    pnl = marts.pnl_summary(mapped).cache()
    return dict(gl=gl, fx=fx, pay=pay, mapped=mapped, pnl=pnl, trends=marts.revenue_trends(mapped),
                cost=marts.cost_analysis(mapped), var=marts.variance_analysis(pnl), d=marts.metric_dictionary(spark))


def ok(report):
    return gates.gate_passed(report)


def test_all_gates_pass_on_clean_data(clean):
    c = clean
    assert ok(gates.gate_g1(c["gl"]))
    assert ok(gates.gate_g2(c["fx"], c["gl"]))
    assert ok(gates.gate_g3(c["pay"]))
    assert ok(gates.gate_g4(c["mapped"], c["pnl"]))
    assert ok(gates.gate_g5(c["pnl"], c["trends"], c["cost"], c["var"], c["d"]))
    assert ok(gates.gate_g6(c["pnl"], c["d"]))


def test_g1_duplicate_id_and_bad_account_type(clean):
    gl = clean["gl"]
    assert not ok(gates.gate_g1(gl.unionByName(gl.limit(1))))
    bad = gl.withColumn("account_type", F.when(F.col("entry_id") == "GL-000001", "Misc").otherwise(F.col("account_type")))
    rep = {r.check: r for r in gates.gate_g1(bad).collect()}
    assert not rep["account_type in set"].passed and rep["account_type in set"].detail == "unexpected=1"


def test_g1_missing_column_is_a_failing_row_not_an_error(clean):
    rep = {r.check: r for r in gates.gate_g1(clean["gl"].drop("currency")).collect()}
    assert not rep["columns match set"].passed and not rep["currency in set"].passed


def test_g2_zero_and_missing_rate(clean):
    fx = clean["fx"]
    zero = fx.withColumn("rate", F.when(F.col("rate_date") == F.lit("2026-01-01").cast("date"), F.lit(0))
                         .otherwise(F.col("rate")).cast("decimal(12,6)"))
    assert not ok(gates.gate_g2(zero, clean["gl"]))
    used = clean["gl"].where(F.col("currency") != "INR").select("entry_date").first()[0]
    missing = fx.where(F.col("rate_date") != F.lit(used))
    rep = {r.check: r for r in gates.gate_g2(missing, clean["gl"]).collect()}
    assert not rep["all GL dates have FX rates"].passed


def test_g3_negative_hours_and_duplicate_allocation(clean):
    pay = clean["pay"]
    neg = pay.withColumn("hours_logged", F.when(F.col("allocation_id") == "PAY-000001", F.lit(-10))
                         .otherwise(F.col("hours_logged")).cast("decimal(8,2)"))
    assert not ok(gates.gate_g3(neg))
    rep = {r.check: r for r in gates.gate_g3(pay.unionByName(pay.limit(1))).collect()}
    assert rep["allocation_id unique"].detail == "dupes=1"


def test_g3_row_count_ceiling_is_a_parameter(clean):
    assert not ok(gates.gate_g3(clean["pay"], max_rows=100))
    assert ok(gates.gate_g3(clean["pay"], max_rows=10 ** 12))


def test_g4_corrupted_operating_income(clean):
    pnl = clean["pnl"].withColumn("operating_income", F.col("operating_income") + F.lit(Decimal("5.00")))
    rep = {r.check: r for r in gates.gate_g4(clean["mapped"], pnl).collect()}
    assert not rep["operating_income = revenue + cogs + opex"].passed
    assert rep["total INR reconciliation"].passed


def test_g5_shifted_revenue(clean):
    c = clean
    trends = c["trends"].withColumn("revenue_inr", F.col("revenue_inr") + F.lit(Decimal("1.00")))
    rep = {r.check: r for r in gates.gate_g5(c["pnl"], trends, c["cost"], c["var"], c["d"]).collect()}
    assert not rep["revenue: pnl vs trends"].passed and rep["costs: pnl vs cost_analysis"].passed


def test_g6_pct_out_of_range_negative_revenue_and_deleted_metric(clean):
    c = clean
    assert not ok(gates.gate_g6(c["pnl"].withColumn("gross_margin_pct", F.lit(250.0)), c["d"]))
    assert not ok(gates.gate_g6(c["pnl"].withColumn("revenue", F.lit(Decimal("-1.00"))), c["d"]))
    assert not ok(gates.gate_g6(c["pnl"], c["d"].where(F.col("metric_key") != "opex")))
    warn = [r for r in gates.gate_g6(c["pnl"], c["d"]).collect() if r.severity == "warning"]
    assert len(warn) == 1 and warn[0].passed


def test_runner_stops_at_first_failure(spark, clean):
    called = []

    def g(name, rep):
        def build():
            called.append(name)
            return rep
        return (name, build)

    bad_g1 = gates.gate_g1(clean["gl"].unionByName(clean["gl"].limit(1)))
    report = gates.run_gates(spark, [g("g1", bad_g1), g("g2", gates.gate_g2(clean["fx"], clean["gl"]))])
    assert called == ["g1"]
    assert {r.gate for r in report.collect()} == {"g1"}


def test_column_tests_as_counted_by_hand(spark):
    import random
    from collections import Counter
    from ledgerspark.operators import checks as C
    rnd = random.Random(41)
    pick = lambda *v: rnd.choice(v)
    child = [(pick(1, 2, 2, 3, None), pick("a", "b", None, "z"), pick("x", "y", "q", None), pick(1.5, None)) for _ in range(60)] + [(7, "only", "x", 0.0)]
    parent = [("a", 2), ("b", 2), ("b", 3), (None, None)]
    rules = {"child": [C.unique("id"), C.not_null("id"), C.accepted("kind", "x", "y"), C.accepted_from("code", "parent", "code"),
                       C.relationship("code", "parent", "code"), C.relationship("id", "parent", "number"), C.unique_combination("id", "code"),
                       C.not_null("nowhere"), C.relationship("code", "parent", "nowhere"), C.unique("amount")],
             "parent": [C.unique("code"), C.not_null("number"), C.unique_combination("code", "number")], "empty": [C.unique("id"), C.not_null("id")]}
    frames = {"child": spark.createDataFrame(child, "id int, code string, kind string, amount double"),
              "parent": spark.createDataFrame(parent, "code string, number long"), "empty": spark.createDataFrame([], "id int")}
    got = {(r.model, r.rule_no): (r.failures, r.passed) for r in C.run_all_model_tests(frames, rules).collect()}
    dup = lambda keys: sum(n > 1 for n in Counter(keys).values())
    ids, codes, kinds = zip(*[r[:3] for r in child])
    known = [c for c in codes if c is not None]
    want = [dup(i for i in ids if i is not None), ids.count(None), len({k for k in kinds if k not in ("x", "y", None)}),
            len({c for c in known if c not in "ab"}), sum(c not in ("a", "b") for c in known), sum(i is not None and i not in (2, 3) for i in ids),
            dup(zip(ids, codes)), None, None, dup(r[3] for r in child if r[3] is not None)]
    assert [got["child", i] for i in range(len(want))] == [(f, f == 0) for f in want]
    assert [got["parent", i][0] for i in range(3)] == [1, 1, 0] and got["empty", 0] == got["empty", 1] == (0, True)


def test_column_tests_scan_and_shuffle_once(spark):
    from ledgerspark.operators import checks as C
    from ledgerspark.plans.ledger import Ledger
    lg = Ledger.of(spark, "/root/testdata/sf0.001", persist=True)
    models = {m: lg.models()[m] for m in ("int_entries_cost_centre_mapped", "dim_projects", "dim_cost_centres")}
    rules = {"int_entries_cost_centre_mapped": C.MODEL_RULES["int_entries_cost_centre_mapped"]}
    out = C.run_all_model_tests(models, rules)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    ledger = models["int_entries_cost_centre_mapped"].inputFiles()[0].rsplit("/", 2)[-2]
    assert plan.count(f"{ledger}]") == 1 or plan.count("FileScan") == 3       # the ledger and its two parents, each once
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 2
    assert "Broadcast" not in plan
    rel = {(r.test, r.column_name): r.failures for r in out.collect()}
    assert rel["relationships", "project_code"] > 0 and rel["relationships", "cost_centre"] > 0


def test_no_row_ceiling_by_default(spark):
    gl = staging.stage_gl(g.gen_gl(spark, 100_001))
    rep = {r.check: r.passed for r in gates.gate_g1(gl).collect()}
    assert all(rep.values())
    rep = {r.check: r.passed for r in gates.gate_g1(gl, 10, 100_000).collect()}
    assert not rep.pop("row count in range") and all(rep.values())


def test_raw_columns_of_a_staged_table(clean):
    from ledgerspark.operators import staging
    raw = clean["gl"].withColumn("more", F.lit(1)).drop("description")
    rep = {r.check: r for r in gates.gate_g1(staging.stage_gl(raw, True), columns=raw.columns).collect()}
    assert not rep["columns match set"].passed
    assert rep["columns match set"].detail == "missing=['description'] extra=['more']"
    pay = clean["pay"].drop("hours_logged")
    rep = {r.check: r.passed for r in gates.gate_g3(staging.stage_payroll(pay, True), columns=pay.columns).collect()}
    assert not rep["all columns present"] and not rep["hours_logged positive"]

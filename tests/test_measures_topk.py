"""Measures at any grain, cube, selectors, prior month, top-k tools, latest-per-key, drift z-score."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerspark.operators import measures as M
from ledgerspark.operators import topk as T
from ledgerspark.operators import windows as W

PNL = ("period_month date, segment string, revenue decimal(38,2), cogs decimal(38,2), gross_margin decimal(38,2), "
       "opex decimal(38,2), operating_income decimal(38,2), gross_margin_pct double, operating_margin_pct double, "
       "entry_count long")


def pnl(spark):
    def row(m, seg, rev, cogs, opex):
        r, c, o = Decimal(rev), Decimal(cogs), Decimal(opex)
        return (dt.date(2026, m, 1), seg, r, c, r + c, o, r + c + o, None, None, 1)
    return spark.createDataFrame([row(1, "A", "100", "-40", "-10"), row(1, "B", "300", "-100", "-50"),
                                  row(3, "A", "200", "-50", "-50"), row(1, None, "10", "0", "0")], PNL)


def test_cube_ratio_of_sums(spark):
    cube = M.margin_cube(pnl(spark))
    total = cube.where(F.col("grouping_id") == 3).first()
    assert total.total_revenue == Decimal("610.00")
    assert abs(total.gross_margin_pct - (420 / 610 * 100)) < 1e-9
    orphan = cube.where((F.col("grouping_id") == 0) & F.col("segment").isNull()).count()
    assert orphan == 1      # the null segment is a real group, told apart by grouping_id


def test_prior_month_is_calendar_not_previous_row(spark):
    r = {(x.period_month, x.segment): x for x in M.prior_month_measure(pnl(spark), ["segment"]).collect()}
    assert r[(dt.date(2026, 3, 1), "A")].prior_operating_income is None   # February missing
    assert r[(dt.date(2026, 1, 1), "A")].oi_change_pct is None


def test_selected_value(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 1.0), ("y", 1.0), ("y", 2.0), ("z", None)], "k string, v double")
    r = {x.k: x.s for x in df.groupBy("k").agg(M.selected_value("v").alias("s")).collect()}
    assert r == {"x": 1.0, "y": None, "z": None}


def test_variance_breakdown_order_filters_and_limit(spark):
    rows = [(dt.date(2026, m, 1), s, Decimal(1), None, None, Decimal(1), None, Decimal(1), None, m == 2 and s == "B")
            for m in range(1, 13) for s in ["A", "B", "C"]]
    v = spark.createDataFrame(rows, "period_month date, segment string, revenue decimal(38,2), prev_revenue decimal(38,2), "
                                    "revenue_variance_pct double, gross_margin decimal(38,2), gm_variance_pct double, "
                                    "operating_income decimal(38,2), oi_variance_pct double, is_material_variance boolean")
    out = T.variance_breakdown(v).collect()
    assert len(out) == 25 and out[0].segment == "B" and out[0].is_material_variance
    assert [r.segment for r in T.variance_breakdown(v, segment="C").collect()][:2] == ["C", "C"]
    assert T.variance_breakdown(v, period_month="2026-03-01").count() == 3


def test_latest_per_key_keeps_ties(spark):
    t1, t2 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)
    df = spark.createDataFrame([("a", t1, 1), ("a", t2, 2), ("a", t2, 3), ("b", t1, 4), (None, t2, 5)],
                               "k string, ts timestamp, v int")
    assert sorted(r.v for r in W.latest_per_key(df, "k", "ts").collect()) == [2, 3, 4]
    flags = {r.v: r.is_latest for r in W.is_latest_flag(df, "k", "ts").collect()}
    assert flags == {1: False, 2: True, 3: True, 4: True, 5: True}


def test_margin_drift_zscore(spark):
    def row(m, v):
        return (dt.date(2026, m, 1), "A", Decimal(1), Decimal(0), Decimal(1), Decimal(0), Decimal(1), 0.0, v, 1)
    df = spark.createDataFrame([row(1, 10.0), row(2, 12.0), row(3, 11.0), row(4, 11.0), row(5, 30.0)], PNL)
    r = W.margin_drift(df).first()
    import statistics
    prior = [10.0, 12.0, 11.0, 11.0]
    z = (30.0 - statistics.mean(prior)) / statistics.pstdev(prior)
    assert abs(r.z_score - round(z, 6)) < 1e-6 and r.is_drift_warning
    short = spark.createDataFrame([row(1, 10.0), row(2, 50.0), row(3, 11.0)], PNL)
    assert W.margin_drift(short).first().z_score is None


def test_set_difference_is_null_safe(spark):
    a = spark.createDataFrame([("x",), (None,)], "s string")
    b = spark.createDataFrame([("x",), ("y",)], "s string")
    r = {(x.s, x.only_in) for x in T.set_difference(a, b, ["s"], "a", "b").collect()}
    assert r == {(None, "a"), ("y", "b")}


def test_sized_broadcast_bounds(spark):
    from ledgerspark.operators.joins import sized_broadcast

    def is_broadcast(df):
        return "ResolvedHint (strategy=broadcast)" in df._jdf.queryExecution().analyzed().toString()

    small = spark.range(100).selectExpr("id", "repeat('x', 10) AS s")
    assert is_broadcast(sized_broadcast(small, max_rows=100))
    # one row over the row bound, or over the byte bound: stays a shuffle join side
    assert not is_broadcast(sized_broadcast(small, max_rows=99))
    assert not is_broadcast(sized_broadcast(small, max_rows=1000, max_bytes=100 * (8 + 10) - 1))
    assert is_broadcast(sized_broadcast(small, max_rows=1000, max_bytes=100 * (8 + 10)))
    # a scan already estimated above the byte bound is not counted at all
    big = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    assert not is_broadcast(sized_broadcast(big, max_rows=10**9, max_bytes=1024))


def test_size_check_estimates_and_never_limits(spark):
    from ledgerspark.operators.joins import estimated_bytes, proven_small
    small = spark.range(100)
    assert estimated_bytes(small) > 0
    assert proven_small(small, max_rows=100) and not proven_small(small, max_rows=99)
    # A side estimated far over the bound is declined before any job: this one would fail if it were run.
    fails = spark.range(10 ** 9).selectExpr("raise_error('counted') AS x")
    assert not proven_small(fails, max_bytes=1024)


def test_records_json_is_ordered_limited_and_plain(spark):
    import datetime as dt
    import json
    from decimal import Decimal
    from ledgerspark.operators import topk as T
    rows = [(dt.date(2026, m, 1), seg, Decimal("12345678.90") * m, None if m == 1 else 0.5 * m, m % 2 == 0)
            for m in (3, 1, 2) for seg in ('a "b"', None, "c\n")]
    df = spark.createDataFrame(rows, "period_month date, segment string, revenue decimal(18,2), pct double, is_material_variance boolean")
    text = T.records_json(df, T._variance_order(), ["period_month", "segment", "revenue", "pct", "is_material_variance"], k=7).first()[0]
    got = json.loads(text)
    want = sorted(rows, key=lambda r: (not r[4], r[0], r[1] is None, r[1] or ""))[:7]
    assert got == [{"period_month": f"{r[0]}T00:00:00.000", "segment": r[1], "revenue": float(r[2]), "pct": r[3], "is_material_variance": r[4]}
                   for r in want]
    assert "E7" not in text and "37037036.7" in text
    assert T.records_json(df.limit(0), T._variance_order(), ["segment"]).first()[0] == "[]"


def test_filters_of_the_variance_tools(spark):
    from ledgerspark.operators import topk as T
    df = spark.createDataFrame([("2026-01-01", "x", 1), ("2026-02-01", "x", 2), ("2026-02-01", None, 3)], "period_month string, segment string, n int")
    df = df.withColumn("period_month", df.period_month.cast("date"))
    pick = lambda **f: sorted(r.n for r in T._filters(df, f.get("month"), f.get("segment")).collect())
    assert pick() == [1, 2, 3] and pick(month="2026-02-01") == [2, 3] and pick(segment="x") == [1, 2]
    assert pick(month="2026-02-01", segment="x") == [2] and pick(month="", segment="") == [1, 2, 3]

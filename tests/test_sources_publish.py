"""Bronze CSV reading, corpus scan, generators, publish types, sinks, streaming ingestion, pipeline."""
import datetime as dt
import os
import time

from pyspark.sql import functions as F

from ledgerspark.operators import publish as PB
from ledgerspark.sources import bronze, corpus
from ledgerspark.sources import generators as g


def test_bronze_csv_keeps_text(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "erp_gl_entries.csv")
    with open(p, "w") as f:
        f.write(",".join(bronze.GL_COLUMNS) + "\n")
        f.write("GL-000001,2026-01-05,PR-11,Harbour,Enterprise,CC-PUN,0400,Acct,Revenue,USD,123.45,desc\n")
    df = bronze.read_csv_source(spark, tmpdir_path, "erp_gl_entries")
    r = df.first()
    assert r.account_code == "0400" and dict(df.dtypes)["amount"] == "string"


def test_corpus_scan_skips_underscore_files(spark, tmpdir_path):
    for layer, name in [("marts", "mart_a.sql"), ("staging", "stg_b.sql"), ("staging", "_sources.sql")]:
        os.makedirs(os.path.join(tmpdir_path, layer), exist_ok=True)
        with open(os.path.join(tmpdir_path, layer, name), "w") as f:
            f.write(f"select 1 -- {name}\nfrom x\n")
    rows = {r.model_name: r for r in corpus.read_sql_corpus(spark, tmpdir_path).collect()}
    assert set(rows) == {"mart_a", "stg_b"} and rows["mart_a"].layer == "marts"
    assert rows["stg_b"].text.endswith("from x\n")


def test_generators_deterministic_and_in_range(spark):
    a = g.gen_gl(spark, 300, seed=7)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, g.gen_gl(spark, 300, seed=7).collect()))
    s = a.groupBy("account_type").agg(F.min("amount").alias("lo"), F.max("amount").alias("hi")).collect()
    for r in s:
        if r.account_type == "Revenue":
            assert 50000 <= r.lo and r.hi <= 500000
        elif r.account_type == "COGS":
            assert -200000 <= r.lo and r.hi <= -20000
        else:
            assert -80000 <= r.lo and r.hi <= -5000
    assert a.first().entry_id.startswith("GL-") and a.agg(F.max("entry_date")).first()[0] < dt.date(2026, 6, 30)
    p = g.gen_payroll(spark, 200)
    assert p.where((F.col("hours_logged") * F.col("rate_per_hour")).cast("decimal(18,2)") != F.col("cost_inr")).count() == 0
    fx = g.gen_fx(spark)
    assert fx.count() == 180 * 4 and fx.agg(F.max("rate_date")).first()[0] == dt.date(2026, 6, 29)


def test_normalize_types(spark):
    from decimal import Decimal
    df = spark.createDataFrame([(True, 1, Decimal("1.50"), float("nan"), dt.date(2026, 1, 1), "x", None)],
                               "b boolean, i int, d decimal(10,2), f double, dt date, s string, n string")
    out = PB.normalize_types(df)
    types = dict(out.dtypes)
    assert types == {"b": "boolean", "i": "bigint", "d": "double", "f": "double", "dt": "date", "s": "string",
                     "n": "string"}
    assert out.first().f is None


def test_csv_export_and_logs(spark, tmpdir_path):
    df = g.gen_fx(spark)
    PB.export_csv(df, os.path.join(tmpdir_path, "fx_csv"))
    back = spark.read.option("header", True).csv(os.path.join(tmpdir_path, "fx_csv"))
    assert back.count() == df.count()
    # one part only under a proven row bound; beyond it the export is still whole, in parts
    n = df.count()
    assert PB.export_csv(df.repartition(4), os.path.join(tmpdir_path, "one"), single_file=True)
    assert not PB.export_csv(df.repartition(4), os.path.join(tmpdir_path, "many"), single_file=True,
                             single_file_max_rows=n - 1)
    parts = [f for f in os.listdir(os.path.join(tmpdir_path, "one")) if f.endswith(".csv")]
    assert len(parts) == 1
    assert spark.read.option("header", True).csv(os.path.join(tmpdir_path, "many")).count() == n


def test_csv_round_trip_keeps_odd_text(spark, tmpdir_path):
    rows = [(1, 'a "quoted", word', dt.date(2026, 1, 1)), (2, "two\nlines", None), (3, "back\\slash", None), (4, None, None), (5, "  blank ", None)]
    df = spark.createDataFrame(rows, "i int, t string, d date")
    PB.export_csv(df, os.path.join(tmpdir_path, "odd"))
    back = PB.read_csv_export(spark, os.path.join(tmpdir_path, "odd"), df.schema)
    assert [tuple(r) for r in back.orderBy("i").collect()] == rows


# ---------------------------------------------------------------- bronze files by header
def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_files_are_read_by_their_header(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "fx_rates.csv")
    put(f"{root}/a.csv", "rate_date,from_currency,to_currency,rate\n2026-01-01,USD,INR,083\n")
    put(f"{root}/more/b.csv", "rate,Note,TO_CURRENCY,from_currency,rate_date\n1.5,\"x, y\",INR,EUR,2026-01-02\n2.5,,INR,GBP,2026-01-03\n")
    put(f"{root}/c.csv", "from_currency,rate_date\nAED,2026-01-04\n")
    put(f"{root}/_SUCCESS", "")
    put(f"{root}/empty.csv", "")
    rows = {r.from_currency: tuple(r) for r in bronze.read_csv_source(spark, tmpdir_path, "fx_rates").collect()}
    assert rows == {"USD": ("2026-01-01", "USD", "INR", "083"), "EUR": ("2026-01-02", "EUR", "INR", "1.5"),
                    "GBP": ("2026-01-03", "GBP", "INR", "2.5"), "AED": ("2026-01-04", "AED", None, None)}
    # the given names, in the given order
    some = bronze.read_csv_source(spark, tmpdir_path, "fx_rates", columns=["note", "rate", "nowhere"])
    assert some.columns == ["note", "rate", "nowhere"]
    assert sorted(tuple(r) for r in some.collect() if r.note) == [("x, y", "1.5", None)]
    # without names: all of all files
    files = bronze.csv_files(spark, root)
    assert len(files) == 3 and sorted(c.lower() for c in bronze.read_csv_files(spark, files).columns) == [
        "from_currency", "note", "rate", "rate_date", "to_currency"]
    # a column that isn't asked for isn't parsed
    plan = bronze.read_csv_source(spark, tmpdir_path, "fx_rates").select("rate")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 3


def test_repeated_and_unnamed_columns(spark, tmpdir_path):
    put(f"{tmpdir_path}/t.csv", "a,,a,b\n1,2,3,4\n")
    assert tuple(bronze.read_csv_source(spark, tmpdir_path, "t", columns=["b", "a"]).first()) == ("4", "1")
    put(f"{tmpdir_path}/u.csv", "\ufeffa,b\n1,2\n")
    assert bronze.read_csv_source(spark, tmpdir_path, "u").columns == ["a", "b"]


def test_missing_table_and_empty_folder(spark, tmpdir_path):
    import pytest
    with pytest.raises(FileNotFoundError):
        bronze.read_csv_source(spark, tmpdir_path, "fx_rates")
    os.makedirs(os.path.join(tmpdir_path, "fx_rates.csv"))
    assert bronze.read_csv_source(spark, tmpdir_path, "fx_rates").count() == 0


def test_audit_counts_bad_cells_and_lines(spark, tmpdir_path):
    from ledgerspark.operators.checks import run_source_tests
    put(f"{tmpdir_path}/payroll_entries.csv", "allocation_id,allocation_date,employee_id,project_code,cost_centre,hours_logged,rate_per_hour,cost_inr\n"
        "P1,2026-01-01,E1,A,B,8.5,100,850\nP1,2026-02-30, ,A,B,eight,100,800\n,01/02/2026,E3,A,B,,-1e2,1\nP4,2026-01-04\nP5,2026-01-05,E5,A,B,1,2,3,4\n")
    raw = bronze.read_csv_source(spark, tmpdir_path, "payroll_entries", corrupt=True)
    found = {(r.column_name, r.problem): r.failures for r in bronze.audit_cells(raw, "payroll_entries").collect()}
    assert found == {("allocation_date", "blank"): 0, ("allocation_date", "bad_cell"): 2, ("hours_logged", "blank"): 2,
                     ("hours_logged", "bad_cell"): 1, ("rate_per_hour", "blank"): 1, ("rate_per_hour", "bad_cell"): 0, ("", "bad_line"): 2}
    rules = {(r.test, r.column_name): (r.failures, r.passed) for r in run_source_tests(
        {"payroll_entries": bronze.read_csv_source(spark, tmpdir_path, "payroll_entries")}).collect()}
    assert rules == {("unique", "allocation_id"): (1, False), ("not_null", "allocation_id"): (1, False),
                     ("not_null", "allocation_date"): (2, False), ("not_null", "employee_id"): (2, False)}


# ---------------------------------------------------------------- corpus with sidecars
YML = """version: 2

models:
  - name: stg_x       # a comment
    description: |
      Text - name: not one
    columns:
      - name: "id"
        tests:
          - not_null
          - accepted_values:
              values: ['a', 'b']
              - nested
      - name: other
        description: none
      - name: last
        data_tests:
        - unique
        - relationships:
            to: ref('y')
"""


def test_sidecars_are_paired_by_path(spark, tmpdir_path):
    put(f"{tmpdir_path}/staging/stg_x.sql", "select 1")
    put(f"{tmpdir_path}/staging/stg_x.yml", YML)
    put(f"{tmpdir_path}/marts/stg_x.sql", "select 2")
    put(f"{tmpdir_path}/marts/other.yml", "models: []")
    put(f"{tmpdir_path}/marts/_hidden.sql", "select 3")
    c = corpus.read_sql_corpus(spark, tmpdir_path)
    rows = {(r.layer, r.model_name): (r.text, r.yml_content) for r in c.collect()}
    assert rows == {("staging", "stg_x"): ("select 1", YML), ("marts", "stg_x"): ("select 2", "No YAML file found.")}
    found = {r.column_name: (r.model, r.tests) for r in corpus.yaml_columns(c).collect()}
    assert found == {"id": ("stg_x", ["not_null", "accepted_values"]), "other": ("stg_x", []), "last": ("stg_x", ["unique", "relationships"])}


def test_streaming_ingestion_is_incremental(spark, tmpdir_path):
    from ledgerspark.streaming.incremental import marts_from_stream_output, start_ledger_stream
    landing, out = os.path.join(tmpdir_path, "landing"), os.path.join(tmpdir_path, "out")
    gl = g.gen_gl(spark, 120)
    gl.where(F.col("entry_id") <= "GL-000060").write.option("header", True).csv(os.path.join(landing, "day1"))
    fx, pr, cc = g.gen_fx(spark), g.dim_projects(spark), g.dim_cost_centres(spark)
    ck = os.path.join(tmpdir_path, "ckpt")
    q = start_ledger_stream(spark, os.path.join(landing, "*"), fx, pr, cc, out, checkpoint=ck)
    q.awaitTermination(120)
    assert spark.read.parquet(os.path.join(out, "mapped")).count() == 60
    # the second day's files have their columns in another order, and one more
    gl.where(F.col("entry_id") > "GL-000060").select(F.lit("x").alias("extra"), *reversed(gl.columns)).write.option("header", True).csv(
        os.path.join(landing, "day2"))
    q = start_ledger_stream(spark, os.path.join(landing, "*"), fx, pr, cc, out, checkpoint=ck)
    q.awaitTermination(120)
    m = marts_from_stream_output(spark, out)
    assert m["mart_pnl_summary"].agg(F.sum("entry_count")).first()[0] == 120


def test_daily_pipeline_runs_and_blocks(spark, tmpdir_path):
    from ledgerspark.plans.pipeline import Bronze, run_daily
    b = Bronze(g.gen_gl(spark, 500), g.gen_fx(spark), g.gen_payroll(spark, 200), g.dim_projects(spark),
               g.dim_cost_centres(spark))
    res = run_daily(spark, b, os.path.join(tmpdir_path, "run"))
    assert res.passed and {r.gate for r in res.report.collect()} == {"g1", "g2", "g3", "g4", "g5", "g6"}
    assert res.source_tests.count() == 11 and all(r.passed for r in res.source_tests.collect())
    assert spark.read.parquet(res.tables["mart_pnl_summary"]).count() > 0
    bad = Bronze(b.gl.unionByName(b.gl.limit(1)), b.fx, b.payroll, b.dim_projects, b.dim_cost_centres)
    res = run_daily(spark, bad, os.path.join(tmpdir_path, "run2"))
    assert not res.passed and res.tables == {} and {r.gate for r in res.report.collect()} == {"g1"}
    assert [(r.test, r.column_name) for r in res.source_tests.collect() if not r.passed] == [("unique", "entry_id")]
    stopped = run_daily(spark, bad, os.path.join(tmpdir_path, "run3"), block_on_sources=True)
    assert not stopped.passed and stopped.report.columns[0] == "source"


def test_source_rules_declared():
    from ledgerspark.operators.checks import SOURCE_RULES
    assert sum(len(v) for v in SOURCE_RULES.values()) == 11


def test_fact_tables_are_never_broadcast(spark):
    # The ledger adapter joins lineitem with orders and customers: those are fact-size
    # sides and must stay shuffle joins; only the proven-small nation/region side is
    # broadcast (the planner's file-size estimate must not broadcast lineitem).
    from ledgerspark.sources import testdata
    plan = testdata.gl_entries(spark, "/root/testdata/sf0.01")._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            subtree = []
            for nxt in lines[i + 1:]:
                if len(nxt) - len(nxt.lstrip(" :+-")) <= depth:
                    break
                subtree.append(nxt)
            scanned = " ".join(subtree)
            assert "lineitem" not in scanned and "orders" not in scanned, scanned
    assert "BroadcastExchange" in plan and "SortMergeJoin" in plan


def test_cluster_conf_sizes_partitions():
    from ledgerspark.session import cluster_conf
    tb = 1024 ** 4
    c = cluster_conf(30 * tb, 4000)
    assert int(c["spark.sql.shuffle.partitions"]) == 30 * tb // (256 * 1024 ** 2)   # 122,880 reducers of 256 MB
    assert int(cluster_conf(10 * 1024 ** 3, 4000)["spark.sql.shuffle.partitions"]) == 12000   # 3 waves minimum
    assert int(c["spark.sql.files.maxPartitionBytes"]) == 512 * 1024 ** 2


def test_write_back_cuts_lineage_in_the_shared_folder(spark):
    from ledgerspark.session import write_back
    df = spark.range(1000).selectExpr("id", "id % 7 AS k").groupBy("k").count()
    out = write_back(df, "wb-test")
    plan = out._jdf.queryExecution().executedPlan().toString()
    ckpt = spark.conf.get("spark.checkpoint.dir")
    assert "FileScan parquet" in plan and "HashAggregate" not in plan and "Range" not in plan
    assert ckpt.rstrip("/").split("/")[-1] in plan
    assert sorted(out.collect()) == sorted(df.collect())


# ---------------------------------------------------------------- landed files at scale
def _documents(spark):
    return spark.createDataFrame([(3, "b", "s1", "en"), (1, "a\nx", "s1", "en"), (501, None, "s1", "de"), (2, "é", "", None), (2, "é", None, "fr"),
                                  (None, "no id", "s1", "en")], "doc_id long, text string, source string, lang string")


def test_corpus_files_are_named_by_their_tasks(spark, tmpdir_path, monkeypatch):
    from ledgerspark import shared
    from ledgerspark.sources import bronze_files

    def refuse(*_):
        raise AssertionError("the driver renames every file")
    monkeypatch.setattr(shared, "rename_parts", refuse)
    root = f"{tmpdir_path}/corpus"
    bronze_files.write_corpus(_documents(spark), root)
    sql = {f"{d}/{f}": open(f"{root}/{d}/{f}", encoding="utf-8").read() for d in os.listdir(root) for f in os.listdir(f"{root}/{d}") if f.endswith(".sql")}
    assert sql == {"s1/part_0.sql": "a\nx\nb\n", "s1/part_1.sql": "\n", "none/part_0.sql": "é\né\n",
                   "s1/part___HIVE_DEFAULT_PARTITION__.sql": "no id\n"}
    assert not [f for _, _, files in os.walk(root) for f in files if f.startswith(".") and not f.endswith(".crc")]


def test_corpus_files_are_the_same_by_both_ways(spark, tmpdir_path, monkeypatch):
    from ledgerspark import shared
    from ledgerspark.sources import bronze_files
    rows = []
    for i, reaches in enumerate((True, False)):
        monkeypatch.setattr(shared, "arrow_reaches", lambda _, r=reaches: r)
        bronze_files.write_corpus(_documents(spark), f"{tmpdir_path}/corpus{i}")
        rows.append(sorted((r.layer, r.model_name, r.text, r.yml_content) for r in corpus.read_sql_corpus(spark, f"{tmpdir_path}/corpus{i}").collect()))
    assert rows[0] == rows[1] and len(rows[0]) == 4


def test_sidecars_are_written_by_many_tasks(spark, tmpdir_path, monkeypatch):
    from ledgerspark import shared
    from ledgerspark.sources import bronze_files
    seen, write = {}, shared.write_named
    monkeypatch.setattr(shared, "write_named", lambda rows, root, suffix: (seen.update({suffix: rows.rdd.getNumPartitions()}), write(rows, root, suffix)))
    bronze_files.write_corpus(_documents(spark), f"{tmpdir_path}/corpus")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert seen == {"sql": n, "yml": n}


def test_deliveries_are_compressed(spark, tmpdir_path):
    from ledgerspark.sources import bronze, bronze_files
    gl = g.gen_gl(spark, 90)
    bronze_files.write_bronze(gl, g.gen_fx(spark), g.gen_payroll(spark, 30), tmpdir_path)
    files = bronze.csv_files(spark, f"{tmpdir_path}/erp_gl_entries.csv")
    assert files and all(f.endswith(".csv.gz") for f in files)
    back = bronze.read_csv_source(spark, tmpdir_path, "erp_gl_entries")
    assert {r.entry_id for r in gl.select("entry_id").collect()} <= {r.entry_id for r in back.collect()}


def test_marts_need_no_written_mapping(spark):
    from ledgerspark import shared
    from ledgerspark.plans.ledger import Ledger
    lg = Ledger(spark, "/root/testdata/sf0.001", persist=True)
    assert lg.pnl.count() and lg.cost_analysis.count() and lg.revenue_trends.count()
    written = shared.names(spark, lg.path("."))
    assert "mart_pnl_summary" in written and "int_entries_cost_centre_mapped" not in written


def test_a_rule_is_grouped_by_its_number(spark):
    from ledgerspark.operators import checks as C
    a = spark.createDataFrame([("x",), ("x",), (None,)], "k string")
    b = spark.createDataFrame([("y",), (None,)], "k string")
    rules = {"a": [C.unique("k"), C.not_null("k")], "b": [C.unique("k"), C.relationship("k", "a", "k")]}
    out = C.evaluate_models({"a": a, "b": b}, rules, {"a": a, "b": b})
    assert sorted((r.model, r.rule_no, r.failures) for r in out.collect()) == [("a", 0, 1), ("a", 1, 1), ("b", 0, 0), ("b", 1, 1)]
    keys = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate [" in x and "key#" in x]
    assert keys and not any("model#" in x for x in keys)

"""Synthetic anomaly injection: known-bad mutations of the bronze tables, run
through the real gates, scored against what each gate is expected to catch.

Mutations are pure DataFrame -> DataFrame plan transforms over the same base
(no copies of the data) that change exactly one row. "The first row" is the first
in a full ordering of the rows — the smallest key, then the other columns in order,
nulls first; Spark has no file order — found by one global min with partial
aggregation. If equal rows repeat it, one of them is changed.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators import gates
from ledgerspark.session import write_back

# FX file order of currencies (first row = earliest date, then this order).
FX_CURRENCY_ORDER = ["USD", "EUR", "GBP", "AED"]


def first_row(df: DataFrame, order: list[F.Column], where: F.Column | None = None) -> DataFrame:
    """One-row frame: the first row by ``order`` and then by all columns, among those matching ``where``."""
    src = df if where is None else df.where(where)
    whole = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))
    return F.broadcast(src.agg(F.min(whole).alias("_m")).where(F.col("_m").isNotNull()).select("_m._row.*"))


def _first(df: DataFrame, key: str, where: F.Column | None = None) -> DataFrame:
    """The row with the smallest ``key`` (optionally among rows matching ``where``)."""
    known = F.col(key).isNotNull()
    return first_row(df, [F.col(key)], known if where is None else known & where)


def without_first(df: DataFrame, first: DataFrame) -> DataFrame:
    """``df`` less one copy of the row ``first`` (compared in all columns, nulls equal)."""
    f = first.toDF(*[f"_f{i}" for i in range(len(df.columns))])
    same = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"_f{i}")) for i, c in enumerate(df.columns)])
    others = df.join(F.broadcast(f), same, "left_anti")
    copies = df.join(F.broadcast(f), same, "left_semi").groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    copies = copies.where("_n > 1").withColumn("_i", F.explode(F.sequence(F.lit(2).cast("long"), F.col("_n"))))
    return others.unionByName(copies.select(*[F.col(f"`{c}`") for c in df.columns]))


def _set_on(df: DataFrame, first: DataFrame, col: str, value: F.Column) -> DataFrame:
    """``df`` with one column of its row ``first`` changed, in that one row."""
    dtype = dict(df.dtypes)[col]
    changed = first.select(*[value.cast(dtype).alias(c) if c == col else F.col(f"`{c}`") for c in df.columns])
    return without_first(df, first).unionByName(changed)


def _detail(first: DataFrame, text: F.Column) -> DataFrame:
    return first.select(text.alias("mutation_detail"))


@dataclass
class Mutation:
    data: DataFrame                 # the mutated table
    detail: DataFrame               # one row: mutation_detail
    keys: DataFrame | None = None   # one-row frame of the key whose rows were changed or added


def duplicate_first_row(df: DataFrame, key: str) -> Mutation:
    first = _first(df, key)
    return Mutation(df.unionByName(first), _detail(first, F.concat(F.lit(f"duplicated row with {key}="), F.col(key))), first.select(key))


def null_entry_date(gl: DataFrame) -> Mutation:
    first = _first(gl, "entry_id")
    return Mutation(_set_on(gl, first, "entry_date", F.lit(None)),
                    _detail(first, F.concat(F.lit("set entry_date to null on entry_id="), F.col("entry_id"))), first.select("entry_id"))


def invalid_account_type(gl: DataFrame) -> Mutation:
    first = _first(gl, "entry_id")
    return Mutation(_set_on(gl, first, "account_type", F.lit("Miscellaneous")),
                    _detail(first, F.concat(F.lit("set account_type='Miscellaneous' (not in Revenue/COGS/OpEx) on entry_id="),
                                            F.col("entry_id"))), first.select("entry_id"))


def invalid_currency(gl: DataFrame) -> Mutation:
    first = _first(gl, "entry_id")
    return Mutation(_set_on(gl, first, "currency", F.lit("JPY")),
                    _detail(first, F.concat(F.lit("set currency='JPY' (not in INR/USD/EUR/GBP/AED) on entry_id="),
                                            F.col("entry_id"))), first.select("entry_id"))


def negative_revenue_amount(gl: DataFrame) -> Mutation:
    first = _first(gl, "entry_id", F.col("account_type") == "Revenue")
    data = _set_on(gl, first, "amount", -F.abs(F.col("amount")))
    text = F.concat(F.lit("flipped Revenue entry_id="), F.col("entry_id"), F.lit(" amount "),
                    F.col("amount").cast("string"), F.lit(" -> "), (-F.abs(F.col("amount"))).cast("string"),
                    F.lit(" (G1-G3 don't check amount sign per account_type — only G6 post-dbt does)"))
    return Mutation(data, _detail(first, text), first.select("entry_id"))


def missing_fx_rate(fx: DataFrame, gl: DataFrame, base: str = "INR") -> Mutation:
    # Exactly one target row (the smallest (entry_id, entry_date, currency) among foreign
    # postings), so the broadcast below holds one row even if that entry_id is duplicated.
    foreign = gl.where(~F.col("currency").eqNullSafe(F.lit(base)) & F.col("entry_id").isNotNull())
    target = F.broadcast(foreign.agg(F.min(F.struct("entry_id", "entry_date", "currency")).alias("s"))
                         .select("s.*").where(F.col("entry_id").isNotNull()))
    data = fx.join(target.select(F.col("entry_date").alias("rate_date"), F.col("currency").alias("from_currency")),
                   ["rate_date", "from_currency"], "left_anti")
    text = F.concat(F.lit("removed fx_rates row(s) for ("), F.col("entry_date").cast("string"), F.lit(", "),
                    F.col("currency"), F.lit("), still used by entry_id="), F.col("entry_id"))
    return Mutation(data, target.select(text.alias("mutation_detail")))


def zero_fx_rate(fx: DataFrame) -> Mutation:
    rank = F.array_position(F.array(*[F.lit(c) for c in FX_CURRENCY_ORDER]), F.col("from_currency"))
    first = first_row(fx, [F.col("rate_date"), F.when(rank == 0, 99).otherwise(rank), F.col("from_currency")], F.col("rate_date").isNotNull())
    data = _set_on(fx, first, "rate", F.lit(0))
    text = F.concat(F.lit("set fx rate to 0 for "), F.col("rate_date").cast("string"), F.lit("/"), F.col("from_currency"))
    return Mutation(data, first.select(text.alias("mutation_detail")))


def negative_hours_logged(payroll: DataFrame) -> Mutation:
    first = _first(payroll, "allocation_id")
    return Mutation(_set_on(payroll, first, "hours_logged", F.lit(-10.0)),
                    _detail(first, F.concat(F.lit("set hours_logged=-10.0 on allocation_id="), F.col("allocation_id"))),
                    first.select("allocation_id"))


# The anomaly catalogue (type, mutated file, gate, expected to be caught).
ANOMALIES = [
    ("duplicate_entry_id", "erp_gl_entries.csv", "g1", True),
    ("null_entry_date", "erp_gl_entries.csv", "g1", True),
    ("invalid_account_type", "erp_gl_entries.csv", "g1", True),
    ("invalid_currency", "erp_gl_entries.csv", "g1", True),
    ("negative_revenue_amount", "erp_gl_entries.csv", "g1", False),
    ("missing_fx_rate_for_used_date", "fx_rates.csv", "g2", True),
    ("zero_fx_rate", "fx_rates.csv", "g2", True),
    ("duplicate_payroll_allocation_id", "payroll_entries.csv", "g3", True),
    ("negative_hours_logged", "payroll_entries.csv", "g3", True),
]


def mutate(anomaly_type: str, gl: DataFrame, fx: DataFrame, payroll: DataFrame) -> tuple[Mutation, dict]:
    """Apply one anomaly; returns the mutation and the (gl, fx, payroll) inputs its gate should see."""
    t = anomaly_type
    if t == "duplicate_entry_id":
        m = duplicate_first_row(gl, "entry_id")
    elif t == "null_entry_date":
        m = null_entry_date(gl)
    elif t == "invalid_account_type":
        m = invalid_account_type(gl)
    elif t == "invalid_currency":
        m = invalid_currency(gl)
    elif t == "negative_revenue_amount":
        m = negative_revenue_amount(gl)
    elif t == "missing_fx_rate_for_used_date":
        m = missing_fx_rate(fx, gl)
    elif t == "zero_fx_rate":
        m = zero_fx_rate(fx)
    elif t == "duplicate_payroll_allocation_id":
        m = duplicate_first_row(payroll, "allocation_id")
    elif t == "negative_hours_logged":
        m = negative_hours_logged(payroll)
    else:
        raise ValueError(t)
    target = next(a for a in ANOMALIES if a[0] == t)[1]
    inputs = {"gl": gl, "fx": fx, "payroll": payroll}
    inputs[{"erp_gl_entries.csv": "gl", "fx_rates.csv": "fx", "payroll_entries.csv": "payroll"}[target]] = m.data
    return m, inputs


def _gate(gate: str, inputs: dict) -> DataFrame:
    if gate == "g1":
        return gates.gate_g1(inputs["gl"])
    if gate == "g2":
        return gates.gate_g2(inputs["fx"], inputs["gl"])
    return gates.gate_g3(inputs["payroll"])


def _target_rows(df: DataFrame, key: str, conditions: list[F.Column]) -> DataFrame:
    """Every row whose ``key`` is the smallest key overall or among the rows matching
    one of ``conditions``: the rows any key-targeted mutation can change.

    One global aggregate finds the (at most 1 + len(conditions)) keys, one
    filtered scan with that broadcast key list keeps their rows; the result is
    written once under the shared checkpoint folder (lineage cut, survives a
    lost executor). It is small unless one key is hot, and then still a
    distributed table, never a driver-side list.
    """
    k = F.col(key)
    mins = [F.min(k)] + [F.min(F.when(c, k)) for c in conditions]
    keys = (df.agg(F.array(*mins).alias("_k")).select(F.explode("_k").alias(key))
            .where(F.col(key).isNotNull()).distinct())
    return write_back(df.join(F.broadcast(keys), key, "left_semi"), f"anomaly-targets-{key}")


def _caught(report: DataFrame) -> DataFrame:
    return report.agg(
        (F.sum(F.when((F.col("severity") == "hard") & ~F.col("passed"), 1).otherwise(0)) > 0).alias("was_caught"))


def scorecard(gl: DataFrame, fx: DataFrame, payroll: DataFrame, catalogue=ANOMALIES,
              incremental: bool = True, base: str = "INR") -> DataFrame:
    """One row per anomaly: did its gate fail (was_caught), and was that expected.

    ``incremental=False`` runs each gate over its whole mutated table (nine
    gate runs, five of them grouping the whole ledger by entry_id). The
    default gives the same rows with one pass per table: every G1 / G3 total
    is a sum over key groups and a key-targeted mutation only changes the rows
    of its one target key, so each gate is ``base totals - target rows before +
    target rows after``, all mutations of a gate in one tagged grouped pass
    (``gates.gate_g1_deltas`` / ``gate_g3_deltas``). The mutations themselves run
    on the written target rows: the smallest key of a subset holding all
    rows of the smallest keys is that same key, so a mutation of the subset
    changes exactly the rows it changes in the whole table. G2 runs on the
    (days x currencies) rate table against the ledger's distinct foreign
    (date, currency) pairs, computed once.
    """
    if not incremental:
        return _scorecard_full(gl, fx, payroll, catalogue)
    from ledgerspark.operators.topk import foreign_pairs
    foreign = ~F.col("currency").eqNullSafe(F.lit(base)) & F.col("entry_id").isNotNull()
    gl_sub = _target_rows(gl, "entry_id", [F.col("account_type") == "Revenue", foreign])
    pay_sub = _target_rows(payroll, "allocation_id", [])
    # Shared by several gate runs: written once (one pass over each table), so no
    # mutation repeats the ledger-wide grouping whatever exchange reuse does.
    g1_base = write_back(gates.g1_totals(gl), "anomaly-g1-base")
    g3_base = write_back(gates.g3_totals(payroll), "anomaly-g3-base")
    pairs = write_back(foreign_pairs(gl, base), "anomaly-fx-pairs")
    g1_changes, g3_changes, reports, details = [], [], [], []
    for t, target, gate, expected in catalogue:
        m, inputs = mutate(t, gl_sub, fx, pay_sub)
        if gate == "g1" and m.keys is not None:
            g1_changes.append((t, gl_sub.join(m.keys, "entry_id", "left_semi"),
                               m.data.join(m.keys, "entry_id", "left_semi")))
        elif gate == "g3" and m.keys is not None:
            g3_changes.append((t, pay_sub.join(m.keys, "allocation_id", "left_semi"),
                               m.data.join(m.keys, "allocation_id", "left_semi")))
        elif gate == "g2" and target == "fx_rates.csv":
            reports.append(gates.gate_g2(inputs["fx"], pairs=pairs, base=base)
                           .select(F.lit(t).alias("_tag"), *gates.GATE_COLUMNS))
        else:   # not key-targeted: run its gate over the whole mutated table
            m, inputs = mutate(t, gl, fx, payroll)
            reports.append(_gate(gate, inputs).select(F.lit(t).alias("_tag"), *gates.GATE_COLUMNS))
        details.append(m.detail.select(F.lit(t).alias("_tag"), "mutation_detail"))
    if g1_changes:
        reports.append(gates.gate_g1_deltas(g1_base, g1_changes).select("_tag", *gates.GATE_COLUMNS))
    if g3_changes:
        reports.append(gates.gate_g3_deltas(g3_base, g3_changes).select("_tag", *gates.GATE_COLUMNS))
    return _assemble(gl.sparkSession, catalogue, reports, details)


def _assemble(spark, catalogue, reports: list[DataFrame], details: list[DataFrame]) -> DataFrame:
    """One scorecard row per catalogue entry from tagged gate reports and mutation details
    (tagged unions and one aggregate; every entry gets a row even without a target)."""
    cat = spark.createDataFrame([(t, f, g, e) for t, f, g, e in catalogue],
                                "_tag string, target_file string, gate_checked string, expected_to_be_caught boolean")
    caught = (reduce(DataFrame.unionByName, reports)
              .select("_tag", ((F.col("severity") == "hard") & ~F.col("passed")).alias("_failed")))
    u = (cat.unionByName(caught, allowMissingColumns=True)
         .unionByName(reduce(DataFrame.unionByName, details), allowMissingColumns=True))
    out = u.groupBy("_tag").agg(
        F.max("target_file").alias("target_file"), F.max("gate_checked").alias("gate_checked"),
        F.max("mutation_detail").alias("mutation_detail"),
        F.max("expected_to_be_caught").alias("expected_to_be_caught"),
        F.coalesce(F.max("_failed"), F.lit(False)).alias("was_caught"))
    return out.select(F.col("_tag").alias("anomaly_type"), "target_file", "gate_checked", "mutation_detail",
                      "expected_to_be_caught", "was_caught",
                      (F.col("was_caught") == F.col("expected_to_be_caught")).alias("matches_expectation"))


def _card_row(t, target, gate, expected, report: DataFrame, m: Mutation) -> DataFrame:
    detail = m.detail.agg(F.max("mutation_detail").alias("mutation_detail"))
    return gates._one_row([_caught(report), detail]).select(
        F.lit(t).alias("anomaly_type"), F.lit(target).alias("target_file"), F.lit(gate).alias("gate_checked"),
        "mutation_detail", F.lit(expected).alias("expected_to_be_caught"), "was_caught")


def _finish(rows: list[DataFrame]) -> DataFrame:
    out = reduce(DataFrame.unionByName, rows)
    return out.withColumn("matches_expectation", F.col("was_caught") == F.col("expected_to_be_caught"))


def _scorecard_full(gl: DataFrame, fx: DataFrame, payroll: DataFrame, catalogue=ANOMALIES) -> DataFrame:
    """Each gate over its whole mutated table (the direct form; used to check the incremental one)."""
    rows = []
    for t, target, gate, expected in catalogue:
        m, inputs = mutate(t, gl, fx, payroll)
        rows.append(_card_row(t, target, gate, expected, _gate(gate, inputs), m))
    return _finish(rows)


def anomaly_summary(card: DataFrame) -> DataFrame:
    """caught / escaped / unexpected counts of a scorecard."""
    return card.agg(
        F.sum(F.when(F.col("was_caught"), 1).otherwise(0)).cast("long").alias("caught"),
        F.sum(F.when(~F.col("was_caught"), 1).otherwise(0)).cast("long").alias("escaped"),
        F.sum(F.when(~F.col("matches_expectation"), 1).otherwise(0)).cast("long").alias("unexpected"),
        F.count(F.lit(1)).alias("total"))


def escapes_to_review(card: DataFrame, run_at: str) -> DataFrame:
    """Every anomaly that escaped its gate becomes a human-review queue row (confidence 0)."""
    e = card.where(~F.col("was_caught"))
    exp = F.when(F.col("expected_to_be_caught"), F.lit("True")).otherwise(F.lit("False"))
    text = F.concat(F.lit("[AI-5 SYNTHETIC ANOMALY ESCAPED DETECTION] anomaly='"), F.col("anomaly_type"),
                    F.lit("' file="), F.col("target_file"), F.lit(" gate_checked="), F.col("gate_checked"),
                    F.lit(" expected_to_be_caught="), exp, F.lit(" — "), F.col("mutation_detail"))
    nd = F.lit(None).cast("double")
    ns = F.lit(None).cast("string")
    return e.select(
        F.sha2(F.concat(F.lit("ai5:"), F.col("anomaly_type"), F.lit(":"), F.lit(run_at)), 256).alias("review_id"),
        F.lit(run_at).cast("timestamp").alias("run_at"),
        F.lit("ai5_synthetic_anomaly").alias("source_chain"),
        text.alias("claim_text"),
        nd.alias("self_reported_score"), nd.alias("second_judge_score"), nd.alias("retrieval_grounding_score"),
        F.lit(0.0).alias("confidence_score"), F.lit("human_review").alias("routing_band"),
        ns.alias("reviewer_verdict"), ns.alias("reviewer_reason_code"), ns.alias("reviewer_edited_text"),
        F.lit(None).cast("timestamp").alias("reviewed_at"), ns.alias("reviewed_by"))

"""Review queue queries and decisions; documentation drift reasons."""
from ledgerspark.operators import drift as DR
from ledgerspark.operators import review as RV

Q_SCHEMA = ("review_id string, run_at timestamp, source_chain string, claim_text string, self_reported_score double, "
            "second_judge_score double, retrieval_grounding_score double, confidence_score double, routing_band string, "
            "reviewer_verdict string, reviewer_reason_code string, reviewer_edited_text string, reviewed_at timestamp, "
            "reviewed_by string")


def queue(spark):
    import datetime as dt
    t1, t2 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)
    rows = [("r1", t2, "c", "claim 1", .5, .5, .5, .6, "human_review", None, None, None, None, None),
            ("r2", t1, "c", "claim 2", .5, .5, .5, .6, "human_review", None, None, None, None, None),
            ("r3", t1, "c", "claim 3", .9, .9, 1., .95, "auto_accept", None, None, None, None, None),
            ("r4", t1, "c", "claim 4", .1, .1, 0., .05, "rejected", None, None, None, None, None)]
    return spark.createDataFrame(rows, Q_SCHEMA)


def test_status_next_and_decisions(spark):
    q = queue(spark)
    assert RV.next_pending(q).first().review_id == "r2"          # oldest first
    d = spark.createDataFrame([("r2", "approved", None, None, "2026-02-01 00:00:00", "rev"),
                               ("r3", "edited", None, "claim 3 fixed", "2026-02-01 00:00:00", "rev"),
                               ("r4", "rejected", "hallucinated_metric", None, "2026-02-01 00:00:00", "rev")],
                              "review_id string, decision string, reason_code string, edited_text string, "
                              "reviewed_at string, reviewed_by string") \
        .selectExpr("review_id", "decision", "reason_code", "edited_text", "cast(reviewed_at as timestamp) reviewed_at",
                    "reviewed_by")
    a = {r.review_id: r for r in RV.apply_decisions(q, d).collect()}
    assert a["r2"].reviewer_verdict == "approved" and a["r2"].reviewer_reason_code == "matches_mart_data"
    assert a["r3"].reviewer_edited_text == "claim 3 fixed" and a["r3"].reviewer_reason_code is None
    assert a["r4"].reviewer_reason_code == "hallucinated_metric"
    assert a["r1"].reviewer_verdict is None
    applied = RV.apply_decisions(q, d)
    st = {r.routing_band: (r.pending, r.total) for r in RV.queue_status(applied).collect()}
    assert st == {"human_review": (1, 2), "auto_accept": (0, 1), "rejected": (0, 1)}
    acc = {r.routing_band: r for r in RV.band_accuracy(applied).collect()}
    assert acc["human_review"].approval_rate_pct == 100.0 and acc["auto_accept"].edited == 1
    assert RV.next_pending(applied).first().review_id == "r1"


def test_reason_codes_fixed():
    assert len(RV.REASON_CODES) == 7 and RV.REASON_CODES[0] == "matches_mart_data"


def fp(spark, rows):
    return spark.createDataFrame(rows, "model_name string, layer string, sha256 string")


def test_drift_reasons(spark):
    cur = fp(spark, [("a", "marts", "h1"), ("b", "marts", "h2"), ("c", "staging", "h3")])
    doc = fp(spark, [("a", "marts", "h1"), ("b", "marts", "old"), ("gone", None, "h9"), ("gone2", "intermediate", "h8")])
    r = {x.model_name: x for x in DR.compare_fingerprints(cur, doc).collect()}
    assert r["a"].drift_reason == "in_sync" and not r["a"].is_drifted
    assert r["b"].drift_reason == "sql_changed_since_docs" and r["b"].documented_sql_hash == "old"
    assert r["c"].drift_reason == "never_documented" and r["c"].documented_sql_hash is None
    assert r["gone"].drift_reason == "doc_entry_orphaned" and r["gone"].layer == "unknown"
    assert r["gone2"].layer == "intermediate" and r["gone2"].current_sql_hash is None
    s = DR.drift_summary(DR.compare_fingerprints(cur, doc)).first()
    assert (s.models, s.in_sync, s.drifted, s.doc_entry_orphaned) == (5, 1, 4, 2)


def test_missing_manifest_means_never_documented(spark):
    cur = fp(spark, [("a", "marts", "h1")])
    r = DR.compare_fingerprints(cur, fp(spark, [])).first()
    assert r.drift_reason == "never_documented"


def test_fingerprint_is_sha256(spark):
    import hashlib
    df = spark.createDataFrame([("m", "l", "select 1")], "n string, l string, t string")
    assert DR.fingerprints(df, "n", "l", "t").first().sha256 == hashlib.sha256(b"select 1").hexdigest()

"""Narrative inputs derived from the marts.

The reference scores commentary written about its P&L mart. Here one
commentary per (month, segment) is rendered from the P&L rows with built-in
string functions — some figures deliberately off — together with the
responses a reviewer model would return for each claim (plain, fenced, string
typed, malformed and empty JSON), a whole-narrative verdict and a response
holding narrative + card headline. Everything is a deterministic function of
the mart rows (integer hashing), so both engines derive the same inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators.measures import pnl_crore_grounding


def _fmt2(x: F.Column) -> F.Column:
    return F.coalesce(x.cast("decimal(18,2)").cast("string"), F.lit("n/a"))


def _nhash(period: F.Column, segment: F.Column) -> F.Column:
    yyyymm = F.year(period) * 100 + F.month(period)
    sc = F.coalesce(F.ascii(segment), F.lit(0)) * 7 + F.coalesce(F.length(segment), F.lit(0))
    return (yyyymm * 31 + sc * 131) % 1009


def narratives(pnl: DataFrame) -> DataFrame:
    """One board commentary per P&L row: (narrative_id, period_month, segment, h, text)."""
    g = pnl_crore_grounding(pnl)
    h = _nhash(F.col("period_month"), F.col("segment"))
    seg = F.coalesce(F.col("segment"), F.lit("Unmapped"))
    mon = F.date_format("period_month", "MMM yyyy")
    rev = F.col("revenue_cr") + F.when(h % 4 == 0, F.lit(0.37)).otherwise(F.lit(0.0))
    gm = F.col("gross_margin_pct") + F.when(h % 7 == 0, F.lit(1.3)).otherwise(F.lit(0.0))
    text = F.concat(seg, F.lit(" revenue reached "), _fmt2(rev), F.lit(" Cr in "), mon,
                    F.lit(". Gross margin was "), _fmt2(gm), F.lit("% of revenue. Operating income stood at "),
                    _fmt2(F.col("operating_income_cr")), F.lit(" Cr, a margin of "),
                    _fmt2(F.col("operating_margin_pct")), F.lit(" percent. Trading was in line with plan."))
    return g.select(
        F.concat(F.date_format("period_month", "yyyy-MM"), F.lit("|"), seg).alias("narrative_id"),
        "period_month", "segment", h.alias("h"), text.alias("text"),
        F.concat(seg, F.lit(" revenue at "), _fmt2(F.col("revenue_cr")), F.lit(" Cr in "), mon, F.lit(".")).alias("card"))


def _response(variant: F.Column, sup: F.Column, conf: F.Column) -> F.Column:
    nl = F.lit("\n")
    return (F.when(variant == 0, F.concat(F.lit('{"supported": '), sup, F.lit(', "confidence": '), conf, F.lit("}")))
            .when(variant == 1, F.concat(F.lit("```json"), nl, F.lit('{"supported": '), sup, F.lit(', "confidence": '),
                                         conf, F.lit("}"), nl, F.lit("```")))
            .when(variant == 2, F.concat(F.lit('{"supported": "'), sup, F.lit('", "confidence": "'), conf, F.lit('"}')))
            .when(variant == 3, F.concat(F.lit("Supported: "), sup, F.lit(" (confidence "), conf, F.lit(")")))
            .when(variant == 4, F.lit("{}"))
            .when(variant == 6, F.concat(F.lit("{'supported': "), sup, F.lit(", 'confidence': "), conf, F.lit("}")))
            .when(variant == 7, F.concat(F.lit('{"supported": '), sup, F.lit(', "confidence": '), conf, F.lit('} {"x": 1}')))
            .when(variant == 8, F.concat(F.lit('{"supported": [], "confidence": '), conf, F.lit("}")))
            .when(variant == 9, F.concat(F.lit('{"supported": '), sup, F.lit(', "confidence": "'), conf, F.lit('d"}')))
            .when(variant == 10, F.concat(F.lit('{"note": {"supported": "x"}, "supported": '), sup, F.lit(', "confidence": '),
                                          conf, F.lit("}")))
            .otherwise(F.concat(F.lit("```"), nl, F.lit('{"confidence": '), conf, F.lit(', "supported": '), sup,
                                F.lit("}"), nl, F.lit("```"))))


def judge_responses(claims: DataFrame) -> DataFrame:
    """(narrative_id, claim_no, self_response, judge_response) for narrative claims (needs column h)."""
    claims = claims.withColumn("_hc", (F.col("h") * 7 + F.col("claim_no") * 101) % 1013)
    hc = F.col("_hc")
    sup = F.when(hc % 5 == 0, F.lit("false")).otherwise(F.lit("true"))
    jsup = F.when(hc % 3 == 0, F.lit("false")).otherwise(F.lit("true"))
    conf = F.concat(F.lit("0."), F.lpad((F.lit(50) + hc % 50).cast("string"), 2, "0"))
    jconf = F.concat(F.lit("0."), F.lpad((F.lit(40) + (hc * 3) % 60).cast("string"), 2, "0"))
    c = claims.withColumns({"_sv": hc % 11, "_ss": sup, "_sc": conf, "_jv": (hc * 5 + 3) % 11, "_js": jsup, "_jc": jconf})
    return c.select("narrative_id", "claim_no",
                    _response(F.col("_sv"), F.col("_ss"), F.col("_sc")).alias("self_response"),
                    _response(F.col("_jv"), F.col("_js"), F.col("_jc")).alias("judge_response"))


def verdict_responses(grounded: DataFrame, narr: DataFrame) -> DataFrame:
    """Whole-narrative verdict JSON per narrative (some fenced, some with text after the JSON, some over-lenient)."""
    status = (F.when(F.col("n_figures") == 0, F.lit("UNVERIFIABLE"))
              .when(F.col("grounding_score") < 1.0, F.lit("INCONSISTENT")))
    g = grounded.select("narrative_id", "claim_text", "n_figures", "grounding_score", status.alias("status"))
    agg = g.groupBy("narrative_id").agg(
        F.count(F.lit(1)).alias("total_claims"),
        F.sum(F.when(F.col("status").isNull(), 1).otherwise(0)).cast("long").alias("consistent"),
        F.sum(F.when(F.col("status") == "INCONSISTENT", 1).otherwise(0)).cast("long").alias("inconsistent"),
        F.sum(F.when(F.col("status") == "UNVERIFIABLE", 1).otherwise(0)).cast("long").alias("unverifiable"),
        F.collect_list(F.when(F.col("status").isNotNull(),
                              F.struct(F.col("claim_text").alias("claim"),
                                       F.lit("value in mart_pnl_summary").alias("expected"),
                                       F.col("status").alias("status")))).alias("issues"))
    j = agg.join(narr.select("narrative_id", "h"), "narrative_id", "inner")
    v = F.col("h") % 5
    verdict = F.when((F.col("inconsistent") == 0) | (v == 2), F.lit("PASS")).otherwise(F.lit("FAIL"))
    js = F.to_json(F.struct(verdict.alias("verdict"), "total_claims", "consistent", "inconsistent", "unverifiable",
                            "issues"))
    raw = (F.when(v == 0, F.concat(F.lit("```json\n"), js, F.lit("\n```")))
           .when(v == 1, F.concat(js, F.lit(" and that is all, {")))
           .otherwise(js))
    return j.select("narrative_id", raw.alias("verdict_response"))


def headline_responses(narr: DataFrame) -> DataFrame:
    """One model response per narrative holding narrative and card headline (delimiter sometimes missing)."""
    v = F.col("h") % 3
    delim = F.lit("\n===CARD_HEADLINE===")
    raw = (F.when(v == 0, F.concat(F.col("text"), delim, F.lit("\n"), F.col("card")))
           .when(v == 1, F.concat(F.col("text"), delim, F.lit("   ")))
           .otherwise(F.col("text")))
    return narr.select("narrative_id", raw.alias("response"))


def one_line_responses(narr: DataFrame) -> DataFrame:
    """One model response per narrative to a request for a one-line headline: as asked, with further lines, far too
    long, blank, or empty."""
    v = F.col("h") % 5
    raw = (F.when(v == 0, F.col("card")).when(v == 1, F.concat(F.lit("\n  "), F.col("card"), F.lit(" \nA second line.")))
           .when(v == 2, F.lit("  \n\t ")).when(v == 3, F.col("text")).otherwise(F.lit("")))
    return narr.select("narrative_id", "period_month", raw.alias("response"))

"""Narrative operators: claim extraction, figure grounding against the marts,
judge-response parsing, confidence scoring and routing, whole-narrative
verdicts, headline splitting and word-bounded snippets.

All of it runs column-wise over a table of texts (one row per narrative or
document) with built-in string / regex / JSON / higher-order functions — no
Python UDF. Generators over arrays (``filter``, ``transform``) work per row,
so a long text is processed whole inside its own task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.num import round_to
from ledgerspark.functions.text import DIGIT, ELLIPSIS, FIGURE, NON_WS, SENTENCE_SPLIT, WS, ascii_digits, split_words, strip_ws
from ledgerspark.operators.joins import with_band_match
from ledgerspark.operators.measures import pnl_crore_grounding

# Fixed values of the scoring (must equal the reference's).
AUTO_ACCEPT_THRESHOLD = 0.85
HUMAN_REVIEW_THRESHOLD = 0.55
WEIGHT_SELF_REPORTED = 0.20
WEIGHT_SECOND_JUDGE = 0.35
WEIGHT_RETRIEVAL_GROUNDING = 0.45
FIGURE_TOLERANCE_ABS = 0.05
NO_FIGURE_SCORE = 0.5
GROUNDING_COLUMNS = ["revenue_cr", "gross_margin_cr", "gross_margin_pct", "operating_income_cr",
                     "operating_margin_pct"]
HEADLINE_DELIMITER = "===CARD_HEADLINE==="
MAX_HEADLINE_WORDS = 25


# ---------------------------------------------------------------- claims
def claim_sentences(text: F.Column) -> F.Column:
    """Sentences of a text that contain a digit, stripped, in order (an array)."""
    flat = strip_ws(F.regexp_replace(text, "\n", " "))
    parts = F.transform(F.split(flat, SENTENCE_SPLIT, -1), lambda s: strip_ws(s))
    return F.filter(parts, lambda s: (F.length(s) > 0) & s.rlike(DIGIT))


def extract_claims(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per claim: (id, claim_no from 1, claim_text)."""
    return (df.select(F.col(id_col), F.posexplode(claim_sentences(F.col(text_col))).alias("pos", "claim_text"))
            .select(id_col, (F.col("pos") + 1).cast("long").alias("claim_no"), "claim_text"))


# ---------------------------------------------------------------- grounding
def figures(text: F.Column) -> F.Column:
    """Numbers carrying a unit (Cr / % / percent) as doubles, commas removed; digits of any script count."""
    return F.transform(F.regexp_extract_all(text, F.lit(FIGURE), 1),
                       lambda m: ascii_digits(F.replace(m, F.lit(","), F.lit(""))).try_cast("double"))


def measure_values(frame: DataFrame, cols: list[str] = GROUNDING_COLUMNS) -> DataFrame:
    """Every non-null value of the grounding measure columns of a frame, as one column ``value``."""
    return frame.select(F.explode(F.array(*[F.col(c).cast("double") for c in cols])).alias("value")) \
        .where(F.col("value").isNotNull())


def mart_values(pnl: DataFrame) -> DataFrame:
    """Grounding values of the P&L mart (amounts in crore, margins in %)."""
    return measure_values(pnl_crore_grounding(pnl))


def ground_claims(claims: DataFrame, keys: list[str], values: DataFrame,
                  tol: float = FIGURE_TOLERANCE_ABS) -> DataFrame:
    """Per claim: figures found, figures matching any value (column ``value``) within ``tol``, score.

    score = matched / figures, or 0.5 when the claim has no figure. Which
    segment or month a value belongs to is not considered. Figures are taken
    once, one row each beside their claim, matched by one join with the interval
    index of the values and summed up again per claim.
    """
    found = claims.select(*keys, "claim_text", F.explode_outer(figures(F.col("claim_text"))).alias("_figure"))
    matched = with_band_match(found, "_figure", values, "value", tol, "_hit")
    per_claim = matched.groupBy(*keys).agg(
        F.first("claim_text").alias("claim_text"), F.count("_figure").alias("n_figures"),
        F.count(F.when(F.col("_hit"), 1)).alias("n_matched"))
    n, m = F.col("n_figures"), F.col("n_matched")
    score = F.when(n == 0, F.lit(NO_FIGURE_SCORE)).otherwise(m.cast("double") / n.cast("double"))
    return per_claim.select(*keys, "claim_text", "n_figures", "n_matched", score.alias("grounding_score"))


# ---------------------------------------------------------------- judge responses
def _strip_fences(c: F.Column) -> F.Column:
    return strip_ws(F.replace(F.replace(c, F.lit("```json"), F.lit("")), F.lit("```"), F.lit("")))


# Python's grammar of float() for text (after strip): digits may be grouped by single underscores.
FLOAT_TEXT = (r"(?i)\A[+-]?(?:(?:\d(?:_?\d)*)(?:\.(?:\d(?:_?\d)*)?)?(?:e[+-]?\d(?:_?\d)*)?"
              r"|\.\d(?:_?\d)*(?:e[+-]?\d(?:_?\d)*)?|inf|infinity|nan)\z")


# JSON as the reference's parser reads it: double quotes only; NaN and Infinity are numbers.
JSON_OPTIONS = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "true", "columnNameOfCorruptRecord": "_bad"}


def _json_object(c: F.Column, fields: str) -> F.Column:
    """The one JSON object that a text holds, as a struct of the given fields; null for anything else.

    Of a repeated key the last value counts. The parser stops after the first value, so the text is parsed inside
    an array and inside an object: text after the value breaks at least one of them, and a second value would be
    the array's second element.
    """
    inside = F.from_json(F.concat(F.lit('{"x":'), c, F.lit("}")), f"x struct<{fields}>, _bad string", JSON_OPTIONS)
    listed = F.from_json(F.concat(F.lit("["), c, F.lit("]")), f"array<struct<{fields}>>", JSON_OPTIONS)
    one = (c.startswith("{") & c.endswith("}") & inside["_bad"].isNull() & (F.size(listed) == 1))
    return F.when(one, F.coalesce(inside["x"], listed[0]))


def parse_judge(df: DataFrame, raw_col: str, prefix: str) -> DataFrame:
    """Add ``{prefix}_supported``, ``{prefix}_confidence``, ``{prefix}_parse_ok`` parsed from a judge response.

    Code fences are removed; the rest must be exactly one JSON object.
    ``supported`` is taken by truthiness of its JSON type (missing and null are
    false, a string is true when non-empty, a number when non-zero, an array or
    object when it has elements); ``confidence`` becomes a double (missing = 0.0;
    a text by Python's float grammar, digits of any script). Any failure gives
    (false, 0.0) with ``parse_ok`` false; so does, unlike in Python, a ``supported`` or
    ``confidence`` that is an object with a key repeated inside it. Each step is its own projection referring
    to the previous step's columns, so the plan stays small.
    """
    t = [f"_{prefix}_{n}" for n in ("o", "s", "c", "st", "ct", "ss", "cs", "conf", "supb", "ok")]
    o, s, c, st, ct, ss, cs, conf, supb, ok = (F.col(x) for x in t)
    df = df.withColumn("_raw", _strip_fences(F.col(raw_col)))
    df = df.withColumn(t[0], _json_object(F.col("_raw"), "supported variant, confidence variant")).drop("_raw")
    df = df.withColumns({t[1]: o["supported"], t[2]: o["confidence"]})
    df = df.withColumns({t[3]: F.schema_of_variant(s), t[4]: F.schema_of_variant(c),
                         t[5]: F.coalesce(F.try_variant_get(s, "$", "string"), F.lit("")),
                         t[6]: F.coalesce(F.try_variant_get(c, "$", "string"), F.lit(""))})
    number = ascii_digits(strip_ws(cs))
    df = df.withColumns({
        t[7]: (F.when(ct.isNull(), F.lit(0.0))
               .when(ct == "BOOLEAN", F.when(cs == "true", 1.0).otherwise(0.0))
               .when(ct == "STRING", F.when(number.rlike(r"(?i)\A[+-]?nan\z"), F.lit(float("nan")))
                     .when(number.rlike(FLOAT_TEXT), F.replace(number, F.lit("_"), F.lit("")).try_cast("double")))
               .when((ct == "VOID") | ct.startswith("ARRAY") | ct.startswith("OBJECT"), F.lit(None).cast("double"))
               .otherwise(cs.try_cast("double"))),
        t[8]: (F.when(st.isNull() | (st == "VOID"), F.lit(False))
               .when(st == "STRING", F.length(ss) > 0)
               .when(st == "BOOLEAN", ss == "true")
               .when(st.startswith("ARRAY") | st.startswith("OBJECT"), ~ss.isin("[]", "{}"))
               .otherwise(F.coalesce(ss.try_cast("double") != 0, F.lit(True))))})
    df = df.withColumn(t[9], F.coalesce(o.isNotNull() & conf.isNotNull(), F.lit(False)))
    df = df.withColumns({
        f"{prefix}_supported": F.when(ok, supb).otherwise(F.lit(False)),
        f"{prefix}_confidence": F.when(ok, conf).otherwise(F.lit(0.0)),
        f"{prefix}_parse_ok": ok})
    return df.drop(*t)


def directional(supported: F.Column, confidence: F.Column) -> F.Column:
    """A confident 'not supported' scores low: supported ? c : 1 - c."""
    return F.when(supported, confidence).otherwise(F.lit(1.0) - confidence)


def route(composite: F.Column) -> F.Column:
    return (F.when(composite >= AUTO_ACCEPT_THRESHOLD, F.lit("auto_accept"))
            .when(composite >= HUMAN_REVIEW_THRESHOLD, F.lit("human_review"))
            .otherwise(F.lit("rejected")))


def judge_scores(responses: DataFrame) -> DataFrame:
    """Parse both responses of each claim and add the directional self / judge scores."""
    p = parse_judge(parse_judge(responses, "self_response", "self"), "judge_response", "judge")
    return p.withColumns({
        "self_score": directional(F.col("self_supported"), F.col("self_confidence")),
        "judge_score": directional(F.col("judge_supported"), F.col("judge_confidence"))})


def score_claims(grounded: DataFrame, responses: DataFrame, keys: list[str], run_at: str,
                 source_chain: str = "ai1_pnl_narrative") -> DataFrame:
    """Composite confidence (0.20 self + 0.35 judge + 0.45 grounding), band, queue-shaped rows.

    ``responses`` holds (keys..., self_response, judge_response). The band is
    decided on the unrounded composite; stored scores are rounded to 3.
    """
    j = grounded.join(judge_scores(responses), keys, "left")
    j = j.withColumn("_composite", F.lit(WEIGHT_SELF_REPORTED) * F.col("self_score")
                     + F.lit(WEIGHT_SECOND_JUDGE) * F.col("judge_score")
                     + F.lit(WEIGHT_RETRIEVAL_GROUNDING) * F.col("grounding_score"))
    ns = F.lit(None).cast("string")
    return j.select(
        *keys,
        F.sha2(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]), 256).alias("review_id"),
        F.lit(run_at).cast("timestamp").alias("run_at"),
        F.lit(source_chain).alias("source_chain"),
        "claim_text",
        round_to("self_score", 3).alias("self_reported_score"),
        round_to("judge_score", 3).alias("second_judge_score"),
        round_to("grounding_score", 3).alias("retrieval_grounding_score"),
        round_to("_composite", 3).alias("confidence_score"),
        route(F.col("_composite")).alias("routing_band"),
        ns.alias("reviewer_verdict"), ns.alias("reviewer_reason_code"), ns.alias("reviewer_edited_text"),
        F.lit(None).cast("timestamp").alias("reviewed_at"), ns.alias("reviewed_by"),
        "self_parse_ok", "judge_parse_ok")


def narrative_gate(scored: DataFrame, key: str) -> DataFrame:
    """Per narrative: pass iff no claim was routed to 'rejected'."""
    return scored.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_claims"),
        F.sum(F.when(F.col("routing_band") == "rejected", 1).otherwise(0)).cast("long").alias("n_rejected"),
    ).withColumn("passed", F.col("n_rejected") == 0)


def band_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("routing_band").agg(F.count(F.lit(1)).alias("claims"))


# ---------------------------------------------------------------- whole-narrative verdict (v1)
VERDICT_SCHEMA = ("verdict string, total_claims long, consistent long, inconsistent long, unverifiable long, "
                  "issues array<struct<claim:string, expected:string, status:string>>")


def parse_verdict(df: DataFrame, raw_col: str) -> DataFrame:
    """Parse a verdict JSON (fences removed) into typed columns.

    Fields are null and parse_ok false when the text is not one JSON object;
    ``rule_verdict`` is FAIL iff an issue is INCONSISTENT, ``passed`` follows
    the stated verdict.
    """
    empty = F.array().cast("array<struct<claim:string,expected:string,status:string>>")
    d = df.withColumn("_c", _strip_fences(F.col(raw_col)))
    d = d.withColumns({
        "_ok": _json_object(F.col("_c"), "verdict variant").isNotNull(),
        "_v": F.from_json(F.col("_c"), VERDICT_SCHEMA, JSON_OPTIONS)})
    d = d.withColumn("_issues", F.coalesce(F.col("_v.issues"), empty))
    ok, v = F.col("_ok"), F.col("_v")
    n_inc = F.size(F.filter(F.col("_issues"), lambda i: i["status"] == "INCONSISTENT"))
    out = d.withColumns({
        "parse_ok": ok,
        "verdict": F.when(ok, F.coalesce(v["verdict"], F.lit("UNKNOWN"))),
        "total_claims": F.when(ok, F.coalesce(v["total_claims"], F.lit(0))),
        "consistent": F.when(ok, F.coalesce(v["consistent"], F.lit(0))),
        "inconsistent": F.when(ok, F.coalesce(v["inconsistent"], F.lit(0))),
        "unverifiable": F.when(ok, F.coalesce(v["unverifiable"], F.lit(0))),
        "n_issues": F.when(ok, F.size(F.col("_issues")).cast("long")),
        "rule_verdict": F.when(ok, F.when(n_inc > 0, F.lit("FAIL")).otherwise(F.lit("PASS"))),
        "passed": ok & F.coalesce(v["verdict"] == "PASS", F.lit(False))})
    return out.drop("_c", "_ok", "_v", "_issues")


# ---------------------------------------------------------------- headlines and snippets
def split_headline(df: DataFrame, raw_col: str) -> DataFrame:
    """Add (narrative, headline, used_fallback) from one response holding both.

    Text after the first delimiter is the headline; when it is missing or
    empty, the headline is the narrative's first sentence and the whole
    (stripped) response is the narrative.
    """
    d = df.withColumn("_parts", F.split(F.col(raw_col), HEADLINE_DELIMITER, 2))
    d = d.withColumns({
        "_found": F.size("_parts") == 2,
        "_before": F.element_at("_parts", 1),
        "_head": strip_ws(F.try_element_at(F.col("_parts"), F.lit(2))),
        "_whole": strip_ws(F.col(raw_col))})
    d = d.withColumn("_use", F.coalesce(F.col("_found") & (F.length("_head") > 0), F.lit(False)))
    first = F.element_at(F.split(F.col("_whole"), "\\. ", -1), 1)
    fallback = F.concat(F.regexp_replace(strip_ws(first), "\\.+\\z", ""), F.lit("."))
    d = d.withColumns({
        "narrative": F.when(F.col("_use"), strip_ws(F.col("_before"))).otherwise(F.col("_whole")),
        "headline": F.when(F.col("_use"), F.col("_head")).otherwise(fallback),
        "used_fallback": ~F.col("_use")})
    return d.drop("_parts", "_found", "_before", "_head", "_whole", "_use")


def first_line_headlines(df: DataFrame, id_col: str, response_col: str,
                         max_words: int = MAX_HEADLINE_WORDS) -> DataFrame:
    """Headline from a one-line model response: first line of the stripped
    response, stripped; an empty response yields no row (the previous headline
    stays current). The kept headline is then word-bounded."""
    line = strip_ws(F.element_at(F.split(strip_ws(F.col(response_col)), "\\r\\n|[\\n\\r\\x0B\\f\\x1C-\\x1E\\x85\\u2028\\u2029]", -1), 1))
    d = df.select(id_col, line.alias("_headline")).where(F.length("_headline") > 0)
    return bounded_snippets(d, id_col, "_headline", max_words)


def bounded_snippets(df: DataFrame, id_col: str, text_col: str, max_words: int = MAX_HEADLINE_WORDS) -> DataFrame:
    """Word-bounded snippet per text; empty (whitespace-only) texts are skipped.

    Over ``max_words`` words: the first words joined by a space, trailing .,;:
    removed, an ellipsis appended; shorter texts are kept unchanged. The whole
    text is split, so ``source_words`` is its full word count.
    """
    # The emptiness test is a find-first (stops at the first non-whitespace character):
    # Catalyst pushes this filter down to the scan, where a split of the whole text
    # would run before the rows are spread over tasks. The split itself runs once,
    # after the filter, on a text known to hold a word.
    d = (df.select(id_col, F.col(text_col).alias("_t")).where(F.col("_t").rlike(NON_WS))
         .select(id_col, "_t", F.split(strip_ws(F.col("_t")), f"{WS}+", -1).alias("_w")))
    cut = F.concat(F.regexp_replace(F.array_join(F.slice("_w", 1, max_words), " "), "[.,;:]+\\z", ""),
                   F.lit(ELLIPSIS))
    d = d.withColumn("snippet_text", F.when(F.size("_w") <= max_words, F.col("_t")).otherwise(cut))
    return d.select(
        id_col, "snippet_text",
        F.size(split_words(F.col("snippet_text"))).cast("long").alias("word_count"),
        F.size("_w").cast("long").alias("source_words"),
        (F.size("_w") > max_words).alias("truncated"))


__all__ = ["extract_claims", "claim_sentences", "figures", "ground_claims", "parse_judge", "judge_scores",
           "score_claims", "narrative_gate", "band_counts", "parse_verdict", "split_headline", "bounded_snippets",
           "WS"]

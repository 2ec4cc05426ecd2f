"""Human-review queue: status, reviewer accuracy per band, next item, decisions.

The queue is a table keyed by review_id. Decisions arrive as a batch and are
applied with one keyed left join (a shuffle on review_id, or a broadcast of a
small batch after a size check); the result is written as a new snapshot —
without a transactional table format there is no in-place UPDATE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.num import round_to
from ledgerspark.operators.joins import sized_broadcast

# Reviewer reason codes, in the reference's order.
REASON_CODES = ["matches_mart_data", "stale_snapshot", "rounding_discrepancy", "wrong_segment_attribution",
                "unsupported_by_retrieval", "hallucinated_metric", "other"]
QUEUE_COLUMNS = ["review_id", "run_at", "source_chain", "claim_text", "self_reported_score", "second_judge_score",
                 "retrieval_grounding_score", "confidence_score", "routing_band", "reviewer_verdict",
                 "reviewer_reason_code", "reviewer_edited_text", "reviewed_at", "reviewed_by"]


def queue_status(queue: DataFrame) -> DataFrame:
    """Per band: claims still waiting for a reviewer, and all claims."""
    return queue.groupBy("routing_band").agg(
        F.sum(F.when(F.col("reviewer_verdict").isNull(), 1).otherwise(0)).cast("long").alias("pending"),
        F.count(F.lit(1)).alias("total"))


def band_accuracy(queue: DataFrame) -> DataFrame:
    """Reviewed claims per band: totals per verdict and approval rate (%, 1 decimal)."""
    v = F.col("reviewer_verdict")
    g = queue.where(v.isNotNull()).groupBy("routing_band").agg(
        F.count(F.lit(1)).alias("total_reviewed"),
        F.sum(F.when(v == "approved", 1).otherwise(0)).cast("long").alias("approved"),
        F.sum(F.when(v == "edited", 1).otherwise(0)).cast("long").alias("edited"),
        F.sum(F.when(v == "rejected", 1).otherwise(0)).cast("long").alias("rejected"))
    rate = F.lit(100.0) * F.col("approved").cast("double") / F.col("total_reviewed").cast("double")
    return g.withColumn("approval_rate_pct", round_to(rate, 1))


def next_pending(queue: DataFrame) -> DataFrame:
    """The oldest human-review claim without a verdict (review_id breaks ties)."""
    return (queue.where((F.col("routing_band") == "human_review") & F.col("reviewer_verdict").isNull())
            .select("review_id", "claim_text", "self_reported_score", "second_judge_score",
                    "retrieval_grounding_score", "confidence_score", "run_at")
            .orderBy("run_at", "review_id").limit(1))


def apply_decisions(queue: DataFrame, decisions: DataFrame, broadcast_rows: int = 1_000_000) -> DataFrame:
    """Apply reviewer decisions (review_id, decision, reason_code, edited_text, reviewed_at, reviewed_by).

    approved -> reason 'matches_mart_data'; edited -> edited text kept, reason
    unchanged; rejected -> the given reason code. Rows without a decision are
    unchanged.
    """
    d = decisions.select(F.col("review_id").alias("_rid"), F.col("decision").alias("_dec"),
                         F.col("reason_code").alias("_reason"), F.col("edited_text").alias("_text"),
                         F.col("reviewed_at").alias("_at"), F.col("reviewed_by").alias("_by"))
    j = queue.join(sized_broadcast(d, broadcast_rows), F.col("review_id") == F.col("_rid"), "left")
    dec = F.col("_dec")
    has = dec.isin("approved", "edited", "rejected")
    out = {
        "reviewer_verdict": F.when(has, dec).otherwise(F.col("reviewer_verdict")),
        "reviewer_reason_code": (F.when(dec == "approved", F.lit("matches_mart_data"))
                                 .when(dec == "rejected", F.col("_reason"))
                                 .otherwise(F.col("reviewer_reason_code"))),
        "reviewer_edited_text": F.when(dec == "edited", F.col("_text")).otherwise(F.col("reviewer_edited_text")),
        "reviewed_at": F.when(has, F.col("_at")).otherwise(F.col("reviewed_at")),
        "reviewed_by": F.when(has, F.col("_by")).otherwise(F.col("reviewed_by")),
    }
    return j.select(*[out[c].alias(c) if c in out else F.col(c) for c in queue.columns])


def decisions_from_queue(queue: DataFrame, reviewed_at: str, reviewer: str = "reviewer") -> DataFrame:
    """A deterministic batch of reviewer decisions derived from the review ids (for tests and
    the registered query): one row per queue row — about a quarter each approved, edited,
    rejected, and no decision yet (null, which leaves the row pending)."""
    k = F.conv(F.substring("review_id", 1, 2), 16, 10).cast("int")
    dec = (F.when(k % 4 == 0, F.lit("approved")).when(k % 4 == 1, F.lit("edited"))
           .when(k % 4 == 2, F.lit("rejected")))
    reason = F.element_at(F.array(*[F.lit(r) for r in REASON_CODES]), (k % 7) + 1)
    return queue.select(
        "review_id", dec.alias("decision"),
        F.when(dec == "rejected", reason).alias("reason_code"),
        F.when(dec == "edited", F.concat(F.col("claim_text"), F.lit(" [edited]"))).alias("edited_text"),
        F.lit(reviewed_at).cast("timestamp").alias("reviewed_at"),
        F.lit(reviewer).alias("reviewed_by"))

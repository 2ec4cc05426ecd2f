"""A training corpus from raw documents: toxicity, line dedup, near-dedup, decontamination, token ids.

Each stage takes (spark, docs, sf_dir) and returns a frame; every stage but the
last returns the columns of its input. ``run`` writes each stage's frame into
the shared checkpoint folder and reads it again for the next one.

1. toxicity: documents that score at least 0.7 go; the model is fitted on the
   labels of rows that aren't held out.
2. line_dedup: lines in later copies of a run of at least 50 words go; a
   document keeps its row, also with an empty text; ``n_chars`` follows the text.
3. near_dedup: one document of each group of near-duplicates (equal texts
   among them) stays, that with the smallest doc_id. Documents that line dedup
   has emptied are equal texts: one empty document of them all stays.
4. decontamination: documents that hold a benchmark item go.
5. sentencepiece: the documents with their piece ids.

Nulls, empty texts, repeated rows and empty tables: as the operators define
them. Further columns are carried along; names that clash with the operators'
own are kept apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm import decontaminate, line_dedup, prob_minhash, sentencepiece_fst
from ledgerspark.llm import toxicity as tox
from ledgerspark.llm.common import Scratch, fresh, table, text_or_empty

#: Documents to leave out are broadcast up to so many (counted first); more are joined by shuffle.
BROADCAST_ROWS = 100_000


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't score as toxic."""
    model, share = tox.fit_model(docs, table(spark, sf_dir, "labels"))
    score, worst = fresh("toxicity_score", docs.columns), fresh("toxicity_word", docs.columns)
    scored = tox.score_documents(docs, model, share, score_as=score, worst_as=worst)
    return scored.where(F.col(score) < tox.THRESHOLD).drop(score, worst)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs."""
    out = line_dedup.drop_repeated_lines(docs, removed_as=None)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length(text_or_empty(F.col("text"))).cast(kind))
    return out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    found = prob_minhash.NearDuplicates(docs)
    mark, key, h = (fresh(c, docs.columns) for c in ("hash_of_text", "kept_id", "kept_hash"))
    kept = found.scratch.keep(found.members().where("kept").select(F.col("id").alias(key), F.col("hash").alias(h)), "kept")
    rows = docs.withColumn(mark, F.unhex(F.md5(text_or_empty(F.col("text")).cast("binary"))))
    same = F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(mark) == F.col(h))
    out = rows.join(kept.hint("merge"), same, "left_semi")
    if found.rows.groupBy("id", "hash").count().where("count > 1").take(1):     # rows that repeat id and text
        out = out.dropDuplicates(["doc_id", mark])
    return out.drop(mark)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    scratch = Scratch(spark, "pipeline")
    mark, key, h = (fresh(c, docs.columns) for c in ("hash_of_text", "leak_id", "leak_hash"))
    leaks = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    leaks = scratch.keep(leaks.select(F.col("doc_id").alias(key), F.col("text_hash").alias(h)).distinct(), "leaks")
    if leaks.count() <= BROADCAST_ROWS:
        leaks = F.broadcast(leaks)
    rows = docs.withColumn(mark, F.unhex(F.md5(text_or_empty(F.col("text")).cast("binary"))))
    same = F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(mark) == F.col(h))
    return rows.join(leaks, same, "left_anti").drop(mark)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with piece ids, their number, and whether they decode to the text."""
    names = {k: fresh(v, docs.columns) for k, v in
             (("ids_as", "token_ids"), ("count_as", "n_tokens"), ("round_trip_as", "round_trip"))}
    return sentencepiece_fst.encode_documents(docs, **names)


STAGES = [("toxicity", toxicity), ("line_dedup", dedup_lines), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("sentencepiece", sentencepiece)]

#: Not expressible in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    scratch = Scratch(spark, "corpus")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        new = scratch.keep(stage(spark, docs, sf_dir), name)
        scratch.drop(docs)
        docs = new
    return docs

"""Exact duplicates: 128-bit content hash, then bytes.

Rows are grouped by the MD5 of the text (128 bits). Inside a hash group the
text itself is a grouping key, so Spark's aggregation compares the bytes: two
texts that collide in the hash come out as two classes. Texts meet in that
aggregation only after the map side has combined equal ones, so a text that
fills a third of the table reaches its reducer as one row per scan task.

The rows get their class by the hash alone (16 bytes and an id per row are
shuffled, not the text; AQE splits a hot hash). Only the rows of hashes that
hold more than one class, if there are any, are matched by hash and text.

Defined results: null text counts as empty; a null id is kept but never chosen
before a known one; rows that repeat both id and text are rows of their own, of
which one stays; an empty table gives an empty table; further columns of the
input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch, table, text_or_empty


def content_hash(text: Column) -> Column:
    """128-bit hash of a text's UTF-8 bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
                hash_of=content_hash) -> DataFrame:
    """One row per input row: the id, ``keep_id`` (id of the row of its class that stays), ``group_size``,
    ``kept`` and ``text_sha256``.

    ``keep`` is the stable id that stays, "smallest" or "largest". ``hash_of`` makes the grouping hash of a
    text column (tests pass a weak one to force collisions).
    """
    pick = {"smallest": F.min, "largest": F.max}[keep]
    spark = df.sparkSession
    scratch = Scratch(spark, "exact-dedup")
    text = text_or_empty(F.col(text_col))
    rows = df.select(F.col(id_col).alias("_id"), text.alias("_text"))
    rows = rows.select("_id", "_text", hash_of(F.col("_text")).alias("_h"))

    # Exact classes: the text is a grouping key, its bytes are compared in the aggregation.
    by_text = rows.groupBy("_h", "_text").agg(pick("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    classes = scratch.keep(by_text.select(
        "_h", "keep_id", "group_size", F.sha2(F.col("_text").cast("binary"), 256).alias("text_sha256")), "classes")
    per_hash = classes.groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    collided = per_hash.where("_n > 1").select("_h")

    # Rows with equal hash and id are counted, so that exactly one of repeated rows is the one that stays.
    ids = rows.groupBy("_h", "_id").agg(F.count(F.lit(1)).alias("_m"))
    if not collided.take(1):
        out = ids.join(classes, "_h")
    else:
        many = scratch.keep(collided, "collided")
        plain = ids.join(many, "_h", "left_anti").join(classes, "_h")
        apart = rows.join(F.broadcast(many) if many.count() <= 100_000 else many, "_h")
        apart = apart.groupBy("_h", "_id", F.sha2(F.col("_text").cast("binary"), 256).alias("text_sha256")).agg(
            F.count(F.lit(1)).alias("_m")).join(classes, ["_h", "text_sha256"])
        out = plain.unionByName(apart.select(plain.columns))
    first = F.col("_id").eqNullSafe(F.col("keep_id"))
    one = out.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_m"))).alias("_copy"))
    return one.select(F.col("_id").alias(id_col), "keep_id", "group_size",
                      (first & (F.col("_copy") == 1)).alias("kept"), "text_sha256")


def op1_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document with its class of equal texts; the largest doc_id stays."""
    return exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


ORACLE_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body),
r AS (SELECT t.doc_id, g.keep_id, g.group_size, t.body,
             row_number() OVER (PARTITION BY t.body ORDER BY t.doc_id DESC NULLS LAST) = 1 AS kept
      FROM t JOIN g USING (body))
SELECT doc_id, keep_id, group_size, kept, sha256(body) AS text_sha256 FROM r
"""

QUERIES = {"op1_exact_dedup": op1_exact_dedup}
ORACLE = {"op1_exact_dedup": ORACLE_SQL}

"""Documentation drift: content fingerprints of the current texts against the
fingerprints recorded when they were last documented.

One full outer join on the name; sha-256 is the built-in ``sha2``. The text
corpus can be any table of (name, layer, text), e.g. a directory of SQL files
read with ``wholetext`` (see ``sources.corpus``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fingerprints(df: DataFrame, name: str, layer: str, text: str) -> DataFrame:
    """(model_name, layer, sha256) of whole texts."""
    return df.select(F.col(name).alias("model_name"), F.col(layer).alias("layer"),
                     F.sha2(F.col(text), 256).alias("sha256"))


def compare_fingerprints(current: DataFrame, documented: DataFrame) -> DataFrame:
    """One row per current model plus one per documented model that no longer exists.

    drift_reason: in_sync | sql_changed_since_docs | never_documented | doc_entry_orphaned.
    An orphaned entry without a recorded layer reports layer 'unknown'.
    """
    c = current.select("model_name", F.col("layer").alias("c_layer"), F.col("sha256").alias("current_sql_hash"))
    d = documented.select(F.col("model_name").alias("d_name"), F.col("layer").alias("d_layer"),
                          F.col("sha256").alias("documented_sql_hash"))
    j = c.join(d, c.model_name == d.d_name, "full_outer")
    on_disk = F.col("model_name").isNotNull()
    reason = (F.when(on_disk & F.col("d_name").isNull(), F.lit("never_documented"))
              .when(on_disk & (F.col("current_sql_hash") != F.col("documented_sql_hash")),
                    F.lit("sql_changed_since_docs"))
              .when(on_disk, F.lit("in_sync"))
              .otherwise(F.lit("doc_entry_orphaned")))
    return j.select(
        F.coalesce("model_name", "d_name").alias("model_name"),
        F.when(on_disk, F.col("c_layer")).otherwise(F.coalesce(F.col("d_layer"), F.lit("unknown"))).alias("layer"),
        "current_sql_hash",
        F.when(on_disk & F.col("d_name").isNull(), F.lit(None).cast("string"))
         .otherwise(F.col("documented_sql_hash")).alias("documented_sql_hash"),
        (reason != "in_sync").alias("is_drifted"),
        reason.alias("drift_reason"))


def drift_summary(results: DataFrame) -> DataFrame:
    """Models in sync / drifted, and the count per reason, as one row."""
    r = F.col("drift_reason")
    return results.agg(
        F.count(F.lit(1)).alias("models"),
        F.sum(F.when(~F.col("is_drifted"), 1).otherwise(0)).cast("long").alias("in_sync"),
        F.sum(F.when(F.col("is_drifted"), 1).otherwise(0)).cast("long").alias("drifted"),
        *[F.sum(F.when(r == x, 1).otherwise(0)).cast("long").alias(x)
          for x in ("sql_changed_since_docs", "never_documented", "doc_entry_orphaned")])

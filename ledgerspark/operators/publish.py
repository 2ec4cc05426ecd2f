"""Sinks: materialized marts and CSV export; publish types. Versioned publishing and
run logs are in ``warehouse``.

Writers are Spark's parallel writers; no data passes through the driver. Row
order is not a table property, so marts are written without a global sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.operators.warehouse import published


def write_mart(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Full replace of one materialized table (parquet)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


SINGLE_FILE_MAX_ROWS = 1_000_000


def export_csv(df: DataFrame, path: str, single_file: bool = False,
               single_file_max_rows: int = SINGLE_FILE_MAX_ROWS) -> bool:
    """Headered CSV export: a directory of parts written in parallel.

    ``single_file`` writes one part (one task) only when a bounded count proves
    the table holds at most ``single_file_max_rows`` rows (a mart); a larger
    table is still exported whole, as parts. Returns whether one part was written.
    """
    one = single_file and df.limit(single_file_max_rows + 1).count() <= single_file_max_rows
    (df.coalesce(1) if one else df).write.mode("overwrite").option("header", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return one


def normalize_types(df: DataFrame) -> DataFrame:
    """Publish types: boolean, bigint, double (decimals included), timestamp, date, else string.

    A column that is null in every row is published as string; NaN becomes
    NULL. Types come from the schema; the all-null test is one aggregation of
    ``count(col)`` over all columns (a publish counts them on its write instead,
    see ``warehouse``).
    """
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first().asDict()
    return df.select(*[published(f, counts[f.name] == 0)[1] for f in df.schema.fields])


def read_csv_export(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An exported table read back in its own types; what a text field can't tell apart (an empty string
    and a null) comes back as null."""
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True).schema(schema).csv(path)

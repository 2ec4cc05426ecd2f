"""Join helpers: size-checked broadcast and a band (tolerance) join by an interval index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only when it is proven to hold at most this many rows ...
DEFAULT_BROADCAST_ROWS = 200_000
# ... and at most this many bytes of column data (strings by their UTF-8 length).
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


# A side whose estimate exceeds the byte bound this many times isn't worth counting (joins and aggregates are estimated
# as the product or the whole of their inputs, far above what they hold, so the estimate alone proves nothing closer).
OVERSIZE = 64


def _row_bytes(df: DataFrame) -> F.Column:
    """Bytes of one row: UTF-8 length of strings and binaries, 8/16 bytes per fixed-width value,
    JSON length for nested values. A measured size, not an estimate."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(t, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)))
        elif isinstance(t, T.DecimalType):
            parts.append(F.lit(16))
        else:
            parts.append(F.lit(8))
    return sum(parts[1:], parts[0]).cast("long") if parts else F.lit(0).cast("long")


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of ``df`` (file-size based; no job)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def proven_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                 max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """Whether ``df`` provably holds at most ``max_rows`` rows and ``max_bytes`` bytes.

    First the optimizer's estimate (no job): a side estimated at more than
    ``OVERSIZE`` times the byte bound is never counted. Otherwise rows and bytes
    are measured by one aggregate with map-side partials: each task reads its
    own split and sends one row, no rows meet in one task.
    """
    if estimated_bytes(df) > OVERSIZE * max_bytes:
        return False
    got = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("b")).first()
    return got["n"] <= max_rows and got["b"] <= max_bytes


def sized_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                    max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Return ``broadcast(df)`` only if ``df`` is ``proven_small``; else ``df`` unchanged,
    so the caller's join stays a shuffle join planned by Catalyst (and split by AQE if
    a key is skewed)."""
    return F.broadcast(df) if proven_small(df, max_rows, max_bytes) else df


def _bucket(v: F.Column, tol: float) -> F.Column:
    """The number of the bucket, 1.5 ``tol`` wide, that holds a value; as a double, so no value overflows it.

    Past 2^53 buckets doubles lie farther apart than ``tol`` and every one is a bucket of its own.
    """
    at = v / F.lit(1.5 * tol)
    return F.when(F.abs(at) < F.lit(2.0 ** 53), F.floor(at).cast("double")).otherwise(at)


def band_index(values: DataFrame, val: str, tol: float) -> DataFrame:
    """Nearest values by bucket: (bucket, own least, own greatest, greatest of the bucket before, least of the one after).

    Buckets are 1.5 ``tol`` wide. Two values of one bucket are then less than twice ``tol`` apart, so a point between
    its bucket's least and greatest lies within ``tol`` of one of them; values two buckets away are farther than
    ``tol``. Four numbers per bucket therefore decide every point of it. One partial aggregate and one shuffle,
    bounded by the number of filled buckets, however often a value occurs.
    """
    v = F.col(val).cast("double")
    rows = values.select(v.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    own = rows.groupBy(_bucket(F.col("v"), tol).alias("b")).agg(F.min("v").alias("least"), F.max("v").alias("greatest"))
    # A bucket also tells its two neighbours about its nearer end.
    null = F.lit(None).cast("double")
    told = own.select(F.explode(F.array(
        F.struct(F.col("b").alias("_bucket"), F.col("least"), F.col("greatest"), null.alias("below"), null.alias("above")),
        F.struct((F.col("b") + 1).alias("_bucket"), null.alias("least"), null.alias("greatest"), F.col("greatest").alias("below"), null.alias("above")),
        F.struct((F.col("b") - 1).alias("_bucket"), null.alias("least"), null.alias("greatest"), null.alias("below"), F.col("least").alias("above")),
    )).alias("t")).select("t.*")
    ends = ["least", "greatest", "below", "above"]
    return told.groupBy("_bucket").agg(*[F.max(c).alias(f"_{c}") for c in ends])


def with_band_match(points: DataFrame, val: str, values: DataFrame, values_val: str, tol: float, as_col: str = "matched") -> DataFrame:
    """``points`` with whether any value lies within ``tol`` (inclusive, computed on doubles) of their column ``val``.

    One left join with the interval index of the values by bucket: no point is duplicated, compared with more
    than four numbers, or joined back to its row. The index is broadcast when proven small, otherwise joined by
    shuffle (a hot bucket is split by AQE, the index has one row for it).
    """
    index = sized_broadcast(band_index(values, values_val, tol))
    v = F.col(val).cast("double")
    joined = points.withColumn("_at", _bucket(v, tol)).join(index, F.col("_at") == F.col("_bucket"), "left")
    near = [F.coalesce(F.abs(v - F.col(c)) <= F.lit(tol), F.lit(False)) for c in ("_least", "_greatest", "_below", "_above")]
    return joined.withColumn(as_col, near[0] | near[1] | near[2] | near[3]).drop("_at", "_bucket", "_least", "_greatest", "_below", "_above")

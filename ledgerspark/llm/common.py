"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: Column) -> Column:
    """A text with null counted as empty."""
    return F.coalesce(col.cast("string"), F.lit(""))


def fresh(name: str, *taken: list[str]) -> str:
    """A column name like ``name`` that none of the given columns has (Spark compares names without case)."""
    used = {c.lower() for columns in taken for c in columns}
    while name.lower() in used:
        name += "_"
    return name


def text_slices(texts: pa.Array, most_bytes: int) -> Iterator[tuple[int, pa.Array]]:
    """(first row, rows) of neighbouring texts of together at most so many bytes; a longer text stands alone."""
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(texts):
        done = size[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(size, done + most_bytes, side="right")))
        yield lo, texts.slice(lo, hi - lo)
        lo = hi


class Scratch:
    """Written intermediate tables in the shared checkpoint folder.

    ``keep`` writes a frame as Parquet and reads it back (lineage is cut and a
    lost executor costs nothing that was written); ``drop`` deletes a table
    that no later step reads, so a long job doesn't pile up shuffle-sized
    files. Tables that the returned frame still reads stay until the cluster
    clears the checkpoint folder.
    """

    def __init__(self, spark: SparkSession, prefix: str):
        self.spark = spark
        self.prefix = prefix
        self.paths: dict[int, str] = {}

    def path(self, name: str) -> str:
        return scratch_path(self.spark, f"{self.prefix}-{name}-{uuid.uuid4().hex[:12]}")

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(back)] = path
        return back

    def drop(self, df: DataFrame) -> None:
        path = self.paths.pop(id(df), None)
        if path is not None:
            jvm = self.spark._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def held_out(doc_id: Column) -> Column:
    """The rows whose crc32(doc_id as text) mod 3 is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def hash_sample(df: DataFrame, key: Column, n: int, total: int) -> DataFrame:
    """The ``n`` rows whose key has the smallest hash, of a frame of ``total`` rows.

    A threshold on the hash leaves about ``2 n`` rows before they are ordered, so a scan
    task doesn't send its own ``n`` smallest rows.
    """
    place = F.shiftrightunsigned(F.xxhash64(key, F.lit(7)), 1) / F.lit(float(1 << 63))
    share = min(1.0, (2.0 * n + 50) / max(1, total))
    return df.withColumn("_place", place).where(F.col("_place") <= share).orderBy("_place", key).limit(n).drop("_place")

"""Full-reload publishing as versioned snapshots.

A publish writes every table into a folder of its own and then creates one commit
file that names them all. Readers resolve tables through the newest commit, so they
see all tables of one publish or all of the one before; a publish that fails in
the middle, or whose executors are lost, leaves nothing that a reader looks at.

    <root>/tables/<table>/<run>-<attempt>/part-*.parquet    written once, never changed
    <root>/commits/<version>.json                           created once, exclusively

Each table is computed once: rows and the non-null values of every column are
counted by an ``Observation`` on the write, and the rows are checked against the
written files' footers before the commit. The types a column is published with follow
from its schema and those counts (see ``published``), recorded in the commit and
applied by the reader.

The commits are the sync log as well: one row per publish, written together with
it. A publish is known by its run id; repeating one that has been committed writes
nothing and returns its counts.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark import shared

COMMIT = ("version long, sync_run_id string, synced_at string, total_rows_synced long, "
          "tables map<string, struct<path: string, rows: long, columns: array<struct<name: string, type: string>>>>, complete boolean")


class PublishError(RuntimeError):
    """The written rows aren't the rows of the frame."""


def published(field: T.StructField, all_null: bool = False) -> tuple[str, Column]:
    """The type a column is published with, and its value: boolean, bigint, double (decimals too; NaN is
    null), timestamp, date, else string; a column without any value is a string."""
    c, t = F.col(f"`{field.name}`"), field.dataType
    if all_null:
        return "string", c.cast("string").alias(field.name)
    if isinstance(t, (T.BooleanType, T.TimestampType, T.TimestampNTZType, T.DateType)):
        return t.simpleString(), c.alias(field.name)
    if isinstance(t, T.IntegralType):
        return "bigint", c.cast("bigint").alias(field.name)
    if isinstance(t, (T.FractionalType, T.DecimalType)):
        d = c.cast("double")
        return "double", F.when(~F.isnan(d), d).alias(field.name)
    return "string", c.cast("string").alias(field.name)


class Warehouse:
    """Published tables under one folder that the driver and all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # ---------------------------------------------------------------- commits
    def _commit_path(self, version: int) -> str:
        return f"{self.root}/commits/{version:012d}.json"

    def _commits(self) -> DataFrame:
        """All complete commits; a commit file that was cut off while it was written counts as none."""
        if not shared.names(self.spark, f"{self.root}/commits"):
            return self.spark.createDataFrame([], COMMIT)
        rows = self.spark.read.schema(COMMIT).json(f"{self.root}/commits")
        return rows.where("complete")

    def versions(self) -> list[int]:
        return sorted(r.version for r in self._commits().select("version").collect())

    def _find(self, version: int | None):
        found = self._commits()
        found = found.where(F.col("version") == version) if version is not None else found.orderBy(F.desc("version")).limit(1)
        row = found.first()
        if row is None:
            raise LookupError(f"{self.root}: no committed publish" + (f" {version}" if version is not None else ""))
        return row

    # ---------------------------------------------------------------- publish
    def publish(self, tables: Mapping[str, DataFrame], run_id: str, synced_at: str | None = None) -> dict[str, int]:
        """Replace all tables at once; rows of each. ``synced_at``: the time of the log (default: now, UTC)."""
        done = self._commits().where(F.col("sync_run_id") == run_id).first()
        if done is not None:
            return {name: t.rows for name, t in done.tables.items()}
        attempt = f"{uuid.uuid5(uuid.NAMESPACE_URL, run_id).hex[:12]}-{uuid.uuid4().hex[:12]}"
        written: dict[str, dict] = {}
        try:
            for name, df in tables.items():
                written[name] = {"path": f"{self.root}/tables/{name}/{attempt}"}
                written[name] |= self._write(df, written[name]["path"])
            self._commit(run_id, written, synced_at)
        except BaseException:
            for t in written.values():
                shared.remove(self.spark, t["path"])
            raise
        return {name: t["rows"] for name, t in written.items()}

    def _write(self, df: DataFrame, path: str) -> dict:
        seen = Observation()
        counts = [F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]
        df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts).write.parquet(path)
        got = seen.get
        rows = self.spark.read.schema(df.schema).parquet(path).count()     # from the files' footers
        # A stage that ran again may have been observed twice; then the frame itself decides.
        if rows != got["rows"] and rows != df.count():
            raise PublishError(f"{path}: {rows} rows written of {got['rows']}")
        return {"rows": rows, "columns": [{"name": f.name, "type": published(f, got[f"c{i}"] == 0)[0]}
                                          for i, f in enumerate(df.schema.fields)]}

    def _commit(self, run_id: str, tables: dict[str, dict], synced_at: str | None) -> None:
        at = synced_at or self.spark.sql("SELECT CAST(current_timestamp() AS STRING)").first()[0]
        taken = shared.names(self.spark, f"{self.root}/commits")
        version = int(taken[-1].split(".")[0]) + 1 if taken else 1
        while True:
            text = json.dumps({"version": version, "sync_run_id": run_id, "synced_at": at,
                               "total_rows_synced": sum(t["rows"] for t in tables.values()), "tables": tables, "complete": True})
            if shared.write_once(self.spark, self._commit_path(version), text):
                return
            version += 1       # another publisher took it

    # ---------------------------------------------------------------- read
    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A table as of a publish (the last committed one by default), in its published types."""
        table = self._find(version).tables[name]
        raw = self.spark.read.parquet(table.path)
        kinds = {c.name: c.type for c in table.columns}
        return raw.select(*[published(f, kinds[f.name] == "string")[1] for f in raw.schema.fields])

    def sync_log(self) -> DataFrame:
        """One row per publish: sync_run_id, synced_at, total_rows_synced."""
        return self._commits().select("sync_run_id", F.col("synced_at").cast("timestamp").alias("synced_at"), "total_rows_synced")

    def expire(self, keep: int) -> list[int]:
        """Delete the tables of all but the last ``keep`` publishes; their log rows stay. Returns the expired versions."""
        rows = self._commits().orderBy(F.desc("version")).collect()
        held = {t.path for r in rows[:keep] for t in r.tables.values()}
        for r in rows[keep:]:
            for t in r.tables.values():
                if t.path not in held:
                    shared.remove(self.spark, t.path)
        return sorted(r.version for r in rows[keep:])


# ---------------------------------------------------------------- run logs
class RunLog:
    """Append-only rows of runs, each run once.

    A run's rows are one partition, written by dynamic partition overwrite (an attempt
    that failed half-way is replaced by the next), and count from the moment its
    commit file exists. Appending a committed run again adds and changes nothing.

        <root>/rows/run=<run>/part-*.parquet
        <root>/committed/<run>
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def append(self, df: DataFrame, run_id: str, run_at: str | None = None, id_col: str = "id", time_col: str = "run_at") -> bool:
        """Add a run's rows, with an id for each (the same in every attempt, if the rows are) and the run's time; whether they were added."""
        if not run_id or not all(c.isalnum() or c in "._-" for c in run_id):
            raise ValueError(f"a run id has letters, digits, dots, dashes and underscores only: {run_id!r}")
        if shared.exists(self.spark, f"{self.root}/committed/{run_id}"):
            return False
        ts = F.lit(run_at).cast("timestamp") if run_at else F.current_timestamp()
        cols = [F.col(f"`{c}`") for c in df.columns]
        content = F.to_json(F.struct(F.lit(run_id).alias("_run"), *cols), {"ignoreNullFields": "false"})
        # Equal rows of a run are counted, and told apart by their number.
        rows = df.select(F.sha2(content, 256).alias("_h"), *cols).groupBy("_h", *cols).agg(F.count(F.lit(1)).alias("_n"))
        rows = rows.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
        rows = rows.select(F.sha2(F.concat_ws("/", "_h", "_i"), 256).alias(id_col), ts.alias(time_col), *cols,
                           F.lit(run_id).alias("run_id"), F.lit(run_id).alias("run"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(f"{self.root}/rows")
        return shared.write_once(self.spark, f"{self.root}/committed/{run_id}", run_id)

    def read(self) -> DataFrame:
        """The rows of all committed runs, with their ``run_id``."""
        if not shared.names(self.spark, f"{self.root}/committed"):
            raise LookupError(f"{self.root}: no committed run")
        done = self.spark.read.text(f"{self.root}/committed").select(F.col("value").alias("run_id"))
        rows = self.spark.read.option("mergeSchema", True).option("basePath", f"{self.root}/rows").parquet(f"{self.root}/rows")
        return rows.drop("run").join(done, "run_id", "left_semi")


def rows_synced_latest(sync_log: DataFrame) -> DataFrame:
    """Rows synced in the latest run and when the data was last refreshed."""
    return sync_log.agg(F.max_by("total_rows_synced", "synced_at").alias("rows_synced_latest"),
                        F.max("synced_at").alias("last_refreshed"))


def latest_per(rows: DataFrame, key: str, time_col: str) -> DataFrame:
    """The rows of each key's latest time (what a card shows of a run log): an aggregate, then a semi-join, so a hot key isn't sorted."""
    last = rows.groupBy(F.col(key).alias("_k")).agg(F.max(time_col).alias("_t"))
    return rows.join(last, F.col(key).eqNullSafe(F.col("_k")) & (F.col(time_col) == F.col("_t")), "left_semi")

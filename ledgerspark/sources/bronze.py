"""Bronze sources: headered CSV files read as text by their column names, then typed in staging.

No schema inference: every column is read as a string (codes such as ``0400`` keep
their leading zeros), the staging functions cast.

The files of a table needn't agree on the order or number of their columns. The header
line of every file is read first (a few hundred bytes each, by a few threads in the
driver: file names and headers only, no rows), files with the same header become one CSV
scan with that header as its schema, and the scans are united by name. There are as many
scans as different headers, each prunes columns and splits files as usual; nothing is joined or read twice.
"""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerspark.functions.text import strip_ws

# Bronze column lists.
GL_COLUMNS = ["entry_id", "entry_date", "project_code", "project_name", "segment", "cost_centre",
              "account_code", "account_name", "account_type", "currency", "amount", "description"]
FX_COLUMNS = ["rate_date", "from_currency", "to_currency", "rate"]
PAYROLL_COLUMNS = ["allocation_id", "allocation_date", "employee_id", "project_code", "cost_centre",
                   "hours_logged", "rate_per_hour", "cost_inr"]
DIM_PROJECT_COLUMNS = ["project_code", "project_name", "segment", "billing_currency", "client_name"]
DIM_COST_CENTRE_COLUMNS = ["cost_centre", "cost_centre_name", "location", "country"]

BRONZE_TABLES = {
    "erp_gl_entries": GL_COLUMNS,
    "fx_rates": FX_COLUMNS,
    "payroll_entries": PAYROLL_COLUMNS,
    "dim_projects": DIM_PROJECT_COLUMNS,
    "dim_cost_centres": DIM_COST_CENTRE_COLUMNS,
}
# The types that staging gives the bronze columns that aren't text (and that a source carries itself).
BRONZE_TYPES = {
    "erp_gl_entries": {"entry_date": "date", "amount": "decimal(18,2)"},
    "fx_rates": {"rate_date": "date", "rate": "decimal(12,6)"},
    "payroll_entries": {"allocation_date": "date", "hours_logged": "decimal(8,2)", "rate_per_hour": "decimal(10,2)"},
}

#: Lines of a file that its columns don't fit (too few or too many fields) keep their text in this column.
CORRUPT = "_corrupt_record"
HEADER_THREADS = 16


def csv_files(spark: SparkSession, path: str) -> list[str]:
    """The files of a path: a file, a folder of parts (and folders in it), or a pattern of either. Hidden ones are left out."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    shown = lambda s: not s.getPath().getName().startswith(("_", "."))

    def under(status) -> list[str]:
        if not status.isDirectory():
            return [status.getPath().toString()] if status.getLen() else []
        return [f for s in fs.listStatus(status.getPath()) if shown(s) for f in under(s)]
    found = fs.globStatus(p)
    if found is None or not len(found):
        raise FileNotFoundError(path)
    return sorted(f for s in found for f in under(s))


def csv_header(spark: SparkSession, file: str) -> tuple[str, ...]:
    """The column names in a file's first line (a byte order mark before it is skipped)."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(file)
    stream = p.getFileSystem(conf).open(p)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        line = reader.readLine() or ""
    finally:
        reader.close()
    return tuple(c.strip() for c in next(csv.reader([line.removeprefix("\ufeff")]), []))


def csv_headers(spark: SparkSession, files: list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of each different header."""
    groups: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        for file, header in zip(files, pool.map(lambda f: csv_header(spark, f), files)):
            groups.setdefault(header, []).append(file)
    return groups


def read_csv_files(spark: SparkSession, files: list[str], columns: list[str] | None = None, corrupt: bool = False) -> DataFrame:
    """Files with a header each, as text by column name.

    ``columns``: the names to return, in this order; a file that lacks one has nulls in it, further ones are
    left out. Without it, all names of all files. Names are compared without case. ``corrupt`` adds the column
    ``_corrupt_record`` with the text of lines that have more or fewer fields than their file's header.
    """
    groups = csv_headers(spark, files)
    names = columns or list({c.lower(): c for header in groups for c in header}.values())
    parts = []
    for header, own in groups.items():
        # Columns by position, so names that a header repeats or leaves out can't disturb the others.
        at = {c.lower(): f"c{i}" for i, c in reversed(list(enumerate(header))) if c}
        schema = StructType([StructField(f"c{i}", StringType()) for i in range(len(header))] + [StructField(CORRUPT, StringType())] * corrupt)
        rows = spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE").option(
            "escape", '"').option("columnNameOfCorruptRecord", CORRUPT).option(
            "columnPruning", not corrupt).csv(own)      # a parser that skips columns doesn't count them
        null = F.lit(None).cast("string")
        parts.append(rows.select(*[(F.col(at[n.lower()]) if n.lower() in at else null).alias(n) for n in names],
                                 *([CORRUPT] if corrupt else [])))
    if not parts:
        return spark.createDataFrame([], StructType([StructField(c, StringType()) for c in [*names, *([CORRUPT] if corrupt else [])]]))
    return reduce(DataFrame.unionAll, parts)


def read_csv_source(spark: SparkSession, bronze_path: str, table: str, columns: list[str] | None = None,
                    corrupt: bool = False) -> DataFrame:
    """``<bronze_path>/<table>.csv`` (a file or a folder of parts) as text; ``columns`` as for ``read_csv_files``,
    by default those of the table's bronze shape."""
    return read_csv_files(spark, csv_files(spark, f"{bronze_path.rstrip('/')}/{table}.csv"), columns or BRONZE_TABLES.get(table), corrupt)


def blank_to_null(df: DataFrame) -> DataFrame:
    """Empty CSV fields are nulls, as a CSV reader in the reference sees them."""
    return df.select(*[F.when(F.trim(F.col(c)) == "", None).otherwise(F.col(c)).alias(c)
                       if dict(df.dtypes)[c] == "string" else F.col(c) for c in df.columns])


# ---------------------------------------------------------------- audit before staging
def _typed(c: Column, kind: str) -> Column:
    """The cell in its staged type, or null: a date is read as YYYY-MM-DD, a number as a plain decimal."""
    text = strip_ws(c)
    if kind == "date":
        return F.when(text.rlike(r"\A\d{4}-\d{2}-\d{2}\z"), F.try_to_date(text, "yyyy-MM-dd"))
    return F.when(text.rlike(r"\A[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z"), text.try_cast(kind))


def typed_cells(raw: DataFrame, table: str) -> DataFrame:
    """Text rows with the typed columns cast leniently: a cell that is blank or doesn't fit its type is null."""
    kinds, given = BRONZE_TYPES.get(table, {}), dict(raw.dtypes)
    rows = blank_to_null(raw)
    # A column that isn't text has its type already.
    return rows.select(*[_typed(F.col(c), kinds[c]).alias(c) if c in kinds and given[c] == "string" else F.col(c) for c in rows.columns])


def audit_cells(raw: DataFrame, table: str) -> DataFrame:
    """What staging would stumble over, in one pass: (source, column_name, problem, failures).

    Per typed column ``blank`` and ``bad_cell`` (not blank, but not of its type); per source ``bad_line`` (fields that
    don't fit the header; needs ``corrupt``).
    """
    text = blank_to_null(raw)
    checks = []
    for c, kind in BRONZE_TYPES.get(table, {}).items():
        checks += [(c, "blank", F.col(c).isNull()), (c, "bad_cell", F.col(c).isNotNull() & _typed(F.col(c), kind).isNull())]
    if CORRUPT in raw.columns:
        checks.append(("", "bad_line", F.col(CORRUPT).isNotNull()))
    found = text.agg(F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(p).alias("problem"), F.count(F.when(x, 1)).alias("failures"))
                               for c, p, x in checks]).alias("r"))
    return found.select(F.lit(table).alias("source"), F.explode("r").alias("r")).select("source", "r.*")

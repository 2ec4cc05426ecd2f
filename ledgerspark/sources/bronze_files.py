"""The given tables as landed files: bronze CSV deliveries and a corpus of model files.

Deliveries differ in the order of their columns and carry columns nobody asked for, some cells and lines are bad:
what a reader by column name and the source tests have to cope with. All by fixed rules on the rows' keys, so
SQL over the same tables derives the same contents. Tasks write the files in parallel. Deliveries are
compressed, which readers tell by the files' names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.sources.bronze import FX_COLUMNS, GL_COLUMNS, PAYROLL_COLUMNS

#: A corpus file holds the documents of one source with ids in a range of so many.
FILE_IDS = 500
#: The range of documents without an id, as Spark's writers name it.
NO_PART = "__HIVE_DEFAULT_PARTITION__"


def _number(key: str) -> Column:
    """The first number in a key such as 12-7-3-1-19960102 or PAY-12."""
    return F.regexp_extract(F.col(key), r"(\d+)", 1).cast("long")


def gl_cells(gl: DataFrame) -> DataFrame:
    """The ledger's rows as text cells, some of them bad (by order number)."""
    n = _number("entry_id")
    text = gl.select(*[F.col(c).cast("string").alias(c) for c in GL_COLUMNS])
    return text.withColumns({
        "_n": n,
        "entry_date": F.when(n % 211 == 3, F.lit("")).when(n % 223 == 5, F.lit("31/12/1996")).when(n % 227 == 7, F.lit("1996-02-31")).otherwise(F.col("entry_date")),
        "amount": F.when(n % 229 == 9, F.lit("n/a")).when(n % 233 == 11, F.lit(" ")).when(n % 239 == 13, F.concat(F.col("amount"), F.lit(" INR"))).otherwise(F.col("amount"))})


def payroll_cells(payroll: DataFrame) -> DataFrame:
    n = _number("allocation_id")
    text = payroll.select(*[F.col(c).cast("string").alias(c) for c in PAYROLL_COLUMNS])
    return text.withColumns({
        "_n": n, "employee_id": F.when(n % 101 == 1, F.lit("")).otherwise(F.col("employee_id")),
        "allocation_date": F.when(n % 103 == 2, F.lit("unknown")).otherwise(F.col("allocation_date")),
        # Every 107th allocation has the number of the one before.
        "allocation_id": F.when(n % 107 == 0, F.concat(F.lit("PAY-"), (n - 1).cast("string"))).otherwise(F.col("allocation_id"))})


def fx_cells(fx: DataFrame) -> DataFrame:
    text = fx.select(*[F.col(c).cast("string").alias(c) for c in FX_COLUMNS])
    day = F.substring("rate_date", 9, 2).cast("int")
    return text.withColumns({"_n": day.cast("long"), "rate": F.when((day == 31) & (F.col("from_currency") == "GBP"), F.lit("#REF!")).otherwise(F.col("rate"))})


def _deliver(cells: DataFrame, columns: list[str], path: str) -> None:
    """Three deliveries: the usual columns, reversed with one more, and rotated between two that nobody asked for."""
    third = len(columns) // 3
    ways = [columns, [*reversed(columns), "loaded_by"], ["batch", *columns[third:], *columns[:third], "checked"]]
    for i, names in enumerate(ways):
        rows = cells.where(F.col("_n") % 3 == i)
        rows = rows.select(*[F.coalesce(c, F.lit("")).alias(c) if c in columns else F.lit(f"{c} {i}").alias(c) for c in names])
        rows.write.option("header", True).option("escape", '"').option("compression", "gzip").csv(f"{path}/delivery{i}")


def bad_lines(gl: DataFrame) -> DataFrame:
    """Lines that don't fit the usual header: two fields, or one too many (by order number)."""
    n = _number("entry_id")
    short = F.concat(F.lit("X"), F.col("entry_id"), F.lit(","), F.col("entry_date").cast("string"))
    long = F.concat(short, F.lit("," * 9), F.col("amount").cast("string"), F.lit(",one,more"))
    return gl.where((n % 509).isin(4, 5)).select(F.when(n % 509 == 4, short).otherwise(long).alias(",".join(GL_COLUMNS)))


def write_bronze(gl: DataFrame, fx: DataFrame, payroll: DataFrame, root: str) -> None:
    """``erp_gl_entries.csv``, ``fx_rates.csv`` and ``payroll_entries.csv``, folders of deliveries."""
    _deliver(gl_cells(gl), GL_COLUMNS, f"{root}/erp_gl_entries.csv")
    # One text column, so its commas are written as they are.
    bad_lines(gl).write.option("header", True).option("sep", "\u0001").option("compression", "gzip").csv(f"{root}/erp_gl_entries.csv/delivery3")
    _deliver(fx_cells(fx), FX_COLUMNS, f"{root}/fx_rates.csv")
    _deliver(payroll_cells(payroll), PAYROLL_COLUMNS, f"{root}/payroll_entries.csv")


def write_corpus(documents: DataFrame, root: str) -> None:
    """``<root>/<source>/part_<n>.sql``: the texts of a range of ids in their order, a line break after each; two of
    three files have a sidecar that declares a column for each of their languages."""
    from ledgerspark import shared
    spark = documents.sparkSession
    part = F.floor(F.col("doc_id") / F.lit(FILE_IDS))
    rows = documents.select(F.coalesce(F.nullif(F.col("source"), F.lit("")), F.lit("none")).alias("layer"), part.alias("part"), "doc_id",
                            F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    folders = ["layer", "part"]
    # A number of partitions that is said isn't lowered: sidecars are tiny but as many as files, and each takes its time.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sql = rows.repartition(tasks, *folders).sortWithinPartitions(*folders, "doc_id").select(*folders, F.col("text").alias("value"))
    with_sidecar = (F.col("part") + F.ascii(F.substring("layer", -1, 1))) % 3 != 2
    columns = rows.where(with_sidecar).groupBy("layer", "part", "lang").agg(F.count(F.lit(1)).alias("n"))
    tests = F.when(F.col("n") % 2 == 0, F.lit("          - not_null\n")).otherwise(F.lit("          - unique\n          - accepted_values:\n              values: ['a', 'b']\n"))
    block = F.concat(F.lit("      - name: "), F.col("lang"), F.lit("\n        tests:\n"), tests)
    yml = columns.groupBy("layer", "part").agg(F.array_sort(F.collect_list(F.struct("lang", block.alias("block")))).alias("b"))
    name = F.concat(F.lit("version: 2\n\nmodels:\n  - name: part_"), F.col("part").cast("string"), F.lit("\n    # by language\n    columns:\n"))
    yml = yml.select(*folders, F.concat(name, F.array_join(F.transform("b", lambda b: b["block"]), "")).alias("value"))
    yml = yml.repartition(tasks, *folders).sortWithinPartitions(*folders)
    shared.make_folder(spark, root)
    for files, suffix in ((sql, "sql"), (yml, "yml")):
        if shared.arrow_reaches(root):
            name = F.concat(F.lit("part_"), F.coalesce(F.col("part").cast("string"), F.lit(NO_PART)))
            shared.write_named(files.select(F.col("layer").alias("folder"), name.alias("name"), F.col("value").alias("line")), root, suffix)
        else:
            # Tasks commit their files themselves (version 2); the driver only renames them.
            raw = f"{root}-raw/{suffix}"
            files.write.partitionBy(*folders).option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(raw)
            shared.rename_parts(spark, raw, root, suffix)

"""Text corpus scan: every ``*.sql`` file under a root, read whole, one row per file, with the YAML file beside it.

name = file stem, layer = parent directory name; files whose name starts with
``_`` are skipped. Spark lists and reads the files in parallel; a file is one
row, never split. A model's sidecar is the ``.yml`` of the same folder and stem:
both scans are joined by the path without its extension.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

NO_YAML = "No YAML file found."


def _files(spark: SparkSession, root: str, glob: str) -> DataFrame:
    df = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
          .text(root, wholetext=True)
          .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")))
    return df.withColumn("stem", F.regexp_replace("path", r"\.[^./]+$", ""))


def layer_of(path: str = "path") -> Column:
    """A file's layer: the name of its folder."""
    return F.regexp_extract(path, r"/([^/]+)/[^/]+$", 1)


def read_sql_corpus(spark: SparkSession, root: str, glob: str = "*.sql", yaml_glob: str = "*.yml",
                    no_yaml: str = NO_YAML) -> DataFrame:
    """One row per model file: model_name, layer, text, path and ``yml_content`` (``no_yaml`` where there is no sidecar)."""
    name = F.regexp_extract("path", r"/([^/]+)\.[^./]+$", 1)
    models = _files(spark, root, glob).withColumns({"model_name": name, "layer": layer_of()}).where(~F.col("model_name").startswith("_"))
    sidecars = _files(spark, root, yaml_glob).select("stem", F.col("text").alias("yml"))
    return models.join(sidecars, "stem", "left").select(
        "model_name", "layer", "text", "path", F.coalesce("yml", F.lit(no_yaml)).alias("yml_content"))


def yaml_columns(corpus: DataFrame, text_col: str = "yml_content") -> DataFrame:
    """The columns and column tests that sidecars declare: (path, model, column_name, tests).

    A reader of the blocks that such files hold, not of all YAML: list items ``- name: x`` nest by their
    indentation (models, then their columns), and the list below ``tests:`` or ``data_tests:`` belongs to the item
    above it. ``model`` is the nearest item above of less indentation; items without one are no columns. ``tests`` are
    the tests' names in order, without their arguments. Comments and blank lines are skipped.
    """
    lines = corpus.select("path", F.posexplode(F.split(F.col(text_col), "\r\n|\n|\r")).alias("at", "line"))
    lines = lines.where(~F.col("line").rlike(r"\A\s*(#.*)?\z")).withColumn("indent", F.length(F.regexp_extract("line", r"\A( *)", 1)))
    item = F.regexp_extract("line", r"\A *- +name: *[\"']?([^\"'#]*?)[\"']? *(?:#.*)?\z", 1)
    key = F.regexp_extract("line", r"\A *(?:- +)?([\w.]+) *:", 1)
    entry = F.regexp_extract("line", r"\A *- +([\w.]+) *:? *(?:#.*)?\z", 1)
    lines = lines.withColumns({"item": F.nullif(item, F.lit("")), "key": F.nullif(key, F.lit("")), "entry": F.nullif(entry, F.lit(""))})
    by_file = Window.partitionBy("path").orderBy("at")
    above = lambda c: F.last(c, ignorenulls=True).over(by_file)
    is_item = F.col("item").isNotNull()
    # Items and the indentation of the first of them: models; deeper ones are columns.
    lines = lines.withColumn("outer", F.min(F.when(is_item, F.col("indent"))).over(Window.partitionBy("path")))
    lines = lines.withColumns({
        "model": above(F.when(is_item & (F.col("indent") == F.col("outer")), F.col("item"))),
        "owner": above(F.when(is_item, F.struct("at", "item", "indent"))),
        "tests_at": above(F.when(F.col("key").isin("tests", "data_tests"), F.col("indent")).when(is_item, F.lit(-1)))})
    # Entries of the list directly below ``tests:``, not those nested in a test's arguments.
    below = (F.col("tests_at") >= 0) & F.col("entry").isNotNull() & (F.col("indent") >= F.col("tests_at"))
    first = F.min(F.when(below, F.col("indent"))).over(Window.partitionBy("path", "owner"))
    lines = lines.withColumn("test", F.when(below & (F.col("indent") == first), F.col("entry")))
    columns = lines.where(F.col("owner").isNotNull() & (F.col("owner.indent") > F.col("outer")))
    found = columns.groupBy("path", "model", F.col("owner.at").alias("item_at"), F.col("owner.item").alias("column_name")).agg(
        F.sort_array(F.collect_list(F.when(F.col("test").isNotNull(), F.struct("at", "test")))).alias("tests"))
    return found.select("path", "model", "column_name", F.col("tests.test").alias("tests"))

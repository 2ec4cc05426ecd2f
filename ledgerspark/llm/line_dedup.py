"""Repeated line runs by prefix doubling over line-ID sequences, in DataFrame functions only.

Every document is a sequence of line IDs (MD5 of the line). Suffixes are sorted
into classes by distributed prefix doubling: two suffixes are in one class of
depth 1 if they begin with the same line, in one class of depth 2k if they and
the suffixes k lines later are in the same classes of depth k. A class is named
by its leftmost suffix in (id, text hash, line number) order, so a suffix that
isn't its class's name has an earlier copy of its first 2**j lines. Lines that
occur once, stretches of repeated lines that are too short, and suffixes alone
in their class drop out after each step, so the rounds work on what is repeated.

A longest-common-prefix interval of depth m is the set of suffixes that agree on
m lines; it is identified by m and the classes of depth 2**j at the suffix's
first line and 2**j lines before the m-th ends (2**j <= m < 2**(j+1)). A line
run counts if it has at least ``MIN_WORDS`` words. It is enough to look at the
shortest such runs that begin or end at each line: every line of a longer
repeated run lies in one of them. Runs that aren't the first of their interval
are later copies; their lines are deleted (overlapping ones merged into maximal
runs), and the first copy stays.

Defined results: null text counts as empty; null ids come first; rows that
repeat id and text are one document, all of them keep the same lines; an empty
text stays an empty text; a document all of whose lines are later copies keeps
its row with an empty text; an empty table gives an empty table; further
columns of the input are kept by `drop_repeated_lines`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch, fresh, table, text_or_empty

MIN_WORDS = 50


def line_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, h, pos, line, words): a row per line."""
    text = text_or_empty(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"),
                       F.posexplode(F.split(text, "\n", -1)).alias("pos", "body"))
    trimmed = F.trim(F.translate(F.col("body"), "\t\r\f\u000b", "    "))
    words = F.when(F.length(trimmed) == 0, 0).otherwise(F.size(F.split(trimmed, " +")))
    return rows.select("id", "h", "pos", F.unhex(F.md5(F.col("body").cast("binary"))).alias("line"), words.alias("words"))


def repeated_stretches(lines: DataFrame, min_words: int) -> DataFrame:
    """(id, h, seg, pos, words, name, total): lines that occur again, in stretches of at least ``min_words`` words;
    ``name`` is the line's first place, ``total`` the words of the stretch up to the line."""
    place = F.struct("id", "h", "pos")
    again = lines.groupBy("line").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("name")).where("n > 1")
    rows = lines.join(again.select("line", "name").hint("merge"), "line").drop("line").distinct()
    doc = Window.partitionBy("id", "h").orderBy("pos")
    rows = rows.withColumn("seg", F.col("pos") - F.row_number().over(doc))
    stretch = Window.partitionBy("id", "h", "seg")
    rows = rows.withColumn("total", F.sum("words").over(stretch.orderBy("pos"))).withColumn(
        "whole", F.sum("words").over(stretch))
    return rows.where(F.col("whole") >= min_words).drop("whole")


def shortest_runs(rows: DataFrame, min_words: int) -> DataFrame:
    """(id, h, pos, m): the shortest runs with enough words that begin at a line, and those that end at a line."""
    common = ["id", "h", "seg"]
    stretch = Window.partitionBy(*common)
    # Totals of all lines and the totals that lines look for, merged in one running pass.
    before = F.col("total") - F.col("words")
    seek = lambda kind, value, at: F.struct(F.lit(kind).alias("kind"), value.cast("long").alias("value"), at.alias("at"))
    asked = rows.select(*common, F.explode(F.array(
        seek(0, F.col("total"), F.col("pos")), seek(1, before + min_words, F.col("pos")),
        seek(2, before, F.col("pos")), seek(3, F.col("total") - min_words, F.col("pos")))).alias("x")).select(*common, "x.*")
    # Begins at a line: the first line whose total is at least the total before it and the bound.
    down = stretch.orderBy(F.desc("value"), F.asc("kind"), F.desc("at")).rowsBetween(Window.unboundedPreceding, 0)
    end = F.last(F.when(F.col("kind") == 0, F.col("at")), ignorenulls=True).over(down)
    starts = asked.where("kind < 2").withColumn("end", end).where("kind = 1 AND end IS NOT NULL")
    # Ends at a line: the last line before which the total is at most the line's total less the bound.
    up = stretch.orderBy(F.asc("value"), F.asc("kind"), F.asc("at")).rowsBetween(Window.unboundedPreceding, 0)
    begin = F.last(F.when(F.col("kind") == 2, F.col("at")), ignorenulls=True).over(up)
    ends = asked.where("kind >= 2").withColumn("begin", begin).where("kind = 3 AND begin IS NOT NULL")
    return starts.select("id", "h", F.col("at").alias("pos"), (F.col("end") - F.col("at") + 1).alias("m")).unionByName(
        ends.select("id", "h", F.col("begin").alias("pos"), (F.col("at") - F.col("begin") + 1).alias("m"))).distinct()


def suffix_classes(rows: DataFrame, depth: int, scratch: Scratch) -> list[DataFrame]:
    """Per level j the table (id, h, pos, name) of suffixes whose first 2**j lines occur again, for 2**j <= depth."""
    levels = [rows.select("id", "h", "pos", "name")]
    k = 1
    while 2 * k <= depth:
        later = Window.partitionBy("id", "h").orderBy("pos").rangeBetween(k, k)
        pairs = levels[-1].withColumn("next", F.first("name").over(later)).where(F.col("next").isNotNull())
        pairs = scratch.keep(pairs, "pairs")
        classes = pairs.groupBy("name", "next").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "h", "pos")).alias("new"))
        again = classes.where("n > 1").select("name", "next", "new")
        level = scratch.keep(pairs.join(again.hint("merge"), ["name", "next"]).select(
            "id", "h", "pos", F.col("new").alias("name")), "level")
        scratch.drop(pairs)
        levels.append(level)
        k *= 2
    return levels


def later_copies(runs: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(id, h, pos, end): runs that have an earlier copy, from ``pos`` to before ``end``."""
    level = F.floor(F.log2(F.col("m") + F.lit(0.5))).cast("int")
    wanted = runs.withColumn("j", level).withColumn(
        "second", F.col("pos") + F.col("m") - F.pow(F.lit(2), F.col("j")).cast("int"))
    out = None
    for j, names in enumerate(levels):
        at = wanted.where(F.col("j") == j)
        same = ["id", "h"]
        first = names.select(*(F.col(c).alias(f"{c}_") for c in same), F.col("pos").alias("pos_"), F.col("name").alias("first"))
        other = names.select(*(F.col(c).alias(f"{c}_") for c in same), F.col("pos").alias("pos_"), F.col("name").alias("last"))
        on = lambda col: (F.col("id").eqNullSafe(F.col("id_"))) & (F.col("h") == F.col("h_")) & (F.col(col) == F.col("pos_"))
        both = at.join(first, on("pos")).drop("id_", "h_", "pos_").join(other, on("second")).drop("id_", "h_", "pos_")
        out = both if out is None else out.unionByName(both)
    place = F.struct("id", "h", "pos")
    interval = ["m", "first", "last"]
    leftmost = out.groupBy(*interval).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("leftmost")).where("n > 1")
    found = out.join(leftmost.select(*interval, "leftmost").hint("merge"), interval)
    return found.where(F.col("leftmost") < place).select("id", "h", "pos", (F.col("pos") + F.col("m")).alias("end"))


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                  scratch: Scratch | None = None) -> DataFrame:
    """(id, h, start, end): the maximal runs of lines of each document that are later copies (end: the line after)."""
    scratch = scratch or Scratch(docs.sparkSession, "line-dedup")
    lines = scratch.keep(line_table(docs, id_col, text_col), "lines")
    rows = scratch.keep(repeated_stretches(lines, min_words), "stretches")
    scratch.drop(lines)
    runs = scratch.keep(shortest_runs(rows, min_words), "runs")
    depth = runs.agg(F.max("m")).first()[0] or 1
    copies = later_copies(runs, suffix_classes(rows, depth, scratch)).groupBy("id", "h", "pos").agg(F.max("end").alias("end"))
    copies = scratch.keep(copies, "copies")
    # Overlapping and touching copies are one maximal run.
    doc = Window.partitionBy("id", "h").orderBy("pos")
    reach = F.max("end").over(doc.rowsBetween(Window.unboundedPreceding, -1))
    new = (F.coalesce(reach, F.lit(-1)) < F.col("pos")).cast("int")
    merged = copies.withColumn("new", new).withColumn("run", F.sum("new").over(doc.rowsBetween(Window.unboundedPreceding, 0)))
    return merged.groupBy("id", "h", "run").agg(F.min("pos").alias("start"), F.max("end").alias("end")).drop("run")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                        removed_as: str | None = "removed_lines") -> DataFrame:
    """The input's columns, the text without its later copies, and the number of lines removed."""
    runs = repeated_runs(docs, id_col, text_col, min_words)
    key, h, cut, mark = (fresh(c, docs.columns) for c in ("id_of_cuts", "h_of_cuts", "cuts", "h_of_text"))
    cuts = runs.groupBy(F.col("id").alias(key), F.col("h").alias(h)).agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias(cut))
    text = text_or_empty(F.col(text_col))
    rows = docs.withColumn(mark, F.xxhash64(text))
    joined = rows.join(cuts.hint("merge"), F.col(id_col).eqNullSafe(F.col(key)) & (F.col(mark) == F.col(h)), "left")
    lines = F.split(text, "\n", -1)
    # What lies between the cuts is kept.
    edges = F.transform(F.sequence(F.lit(0), F.size(cut)), lambda i: F.struct(
        F.when(i == 0, 0).otherwise(F.col(cut)[i - 1]["end"]).alias("a"),
        F.when(i == F.size(cut), F.size(lines)).otherwise(F.col(cut)[i]["start"]).alias("b")))
    kept = F.array_join(F.flatten(F.transform(edges, lambda x: F.slice(lines, x["a"] + 1, x["b"] - x["a"]))), "\n")
    gone = F.aggregate(cut, F.lit(0), lambda n, x: n + x["end"] - x["start"])
    body = F.when(F.col(cut).isNull(), F.col(text_col)).otherwise(kept).alias(text_col)
    count = [F.coalesce(gone, F.lit(0)).cast("long").alias(removed_as)] if removed_as else []
    return joined.select(*(body if c == text_col else F.col(c) for c in docs.columns), *count)


def op6_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document without its lines that repeat a run of at least 50 words from an earlier place."""
    return drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op6_line_dedup": op6_line_dedup}
ORACLE: dict[str, str] = {}

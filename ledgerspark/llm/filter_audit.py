"""Filter interaction audit: what every order of the filters removes, and each filter's Shapley share.

A document is reduced to the set of filters that it fails. A filter pipeline is a
path through the lattice of filter subsets: from the state S (filters already
applied) the filter f leads to S + f and removes the documents that fail f and
nothing in S. Forward counting says how many orders reach a state, backward
counting how many leave it; their product is the number of orders that use an
edge. The edge removals weighted by it, summed for a filter, are its Shapley
numbers, and the steps of a single order are read from the same edges.

Plan: one Arrow pass over the texts gives the four conditions on single texts and
the SHA-256 of the text; what is shuffled after it is some sixty bytes a document,
never a text. Equal texts are found by that digest: rows are combined by (digest,
part, failed filters, labels) before they meet, so a text that fills a third of the
table reaches its group as a few rows. Everything after the count of (part, failed
set) is bounded by parts x 32 sets; the lattice itself (32 states, 80 edges) is a
constant of the filters, not of the data.

Defined results: null texts are empty; a null source is the part ''; a null
doc_id has no label and is never a later copy (nothing is smaller); rows that
repeat a doc_id with equal texts aren't later copies of each other; several label
rows of a document count as one that has a 1 if any has; a document without a
label counts in no label column; an empty table gives no rows. Very long texts are
read whole, one at a time. Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch, table, text_or_empty

#: The audited filters, in bit order: a document's failed set has bit i if it fails FILTERS[i].
FILTERS = "ABCDE"
MIN_WORDS = 50
DISTINCT_PCT = 65
CAPITAL_PCT = 5
SYMBOLS = b"#$%&*|"

_NOT_CAPITALS = bytes(c for c in range(256) if not 65 <= c <= 90)
_NOT_SYMBOLS = bytes(c for c in range(256) if c not in SYMBOLS)


def text_conditions(text: str) -> int:
    """The failed filters A to D of one text, as bits."""
    raw = text.encode()
    words = raw.split()                    # at runs of the six ASCII white-space characters
    failed = len(words) < MIN_WORDS
    failed |= (100 * len(set(words)) < DISTINCT_PCT * len(words)) << 1
    failed |= (100 * len(raw.translate(None, _NOT_CAPITALS)) > CAPITAL_PCT * len(text)) << 2
    failed |= bool(raw.translate(None, _NOT_SYMBOLS)) << 3
    return failed


def _conditions(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(2)
        failed, digests = [], []
        for value in texts:                # one Python text at a time
            text = value.as_py()
            failed.append(text_conditions(text))
            digests.append(hashlib.sha256(text.encode()).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(failed, pa.int32()), pa.array(digests, pa.binary())],
            ["id", "part", "failed", "digest"])


# ---------------------------------------------------------------- the lattice
def edges(filters: str = FILTERS) -> list[tuple[int, int, int]]:
    """(state, filter, number of orders that pass the edge) for every edge of the subset lattice.

    ``forward[S]`` counts the paths from no filter to S, ``backward[S]`` those from S to all filters.
    """
    n = len(filters)
    full = (1 << n) - 1
    by_size = sorted(range(full + 1), key=lambda s: s.bit_count())
    forward, backward = [0] * (full + 1), [0] * (full + 1)
    forward[0] = backward[full] = 1
    for s in by_size:
        for f in range(n):
            if not s >> f & 1:
                forward[s | 1 << f] += forward[s]
    for s in reversed(by_size):
        for f in range(n):
            if not s >> f & 1:
                backward[s] += backward[s | 1 << f]
    return [(s, f, forward[s] * backward[s | 1 << f]) for s in range(full + 1) for f in range(n) if not s >> f & 1]


def order_steps(filters: str = FILTERS, orders: Sequence[str] | None = None) -> list[tuple[str, int, int, int]]:
    """(order, step from 1, state before the step, filter) for the given orders, or all of them."""
    rows = []
    for order in orders if orders is not None else map("".join, permutations(filters)):
        state = 0
        for step, letter in enumerate(order, 1):
            f = filters.index(letter)
            rows.append((order, step, state, f))
            state |= 1 << f
    return rows


# ---------------------------------------------------------------- Spark side
def failed_sets(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                part_col: str = "source") -> DataFrame:
    """Counts of documents by (part, failed): ``n``, ``good`` (quality 1) and ``toxic`` (toxic 1)."""
    scratch = Scratch(docs.sparkSession, "filter-audit")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       text_or_empty(F.col(text_col)).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    rows = rows.mapInArrow(_conditions, f"id {kind}, part string, failed int, digest binary")

    one = lambda c: F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0)))
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        one("quality").alias("good"), one("toxic").alias("toxic"))
    rows = rows.join(marks, "id", "left").select(
        "id", "part", "failed", "digest", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))

    # Rows of equal texts meet only as one row per (part, labels) and task; the first id keeps its own number of rows.
    keys = ["digest", "part", "failed", "good", "toxic"]
    by_id = rows.groupBy("id", *keys).agg(F.count(F.lit(1)).alias("m"))
    group = by_id.groupBy(*keys).agg(
        F.sum("m").alias("n"), F.sum(F.when(F.col("id").isNotNull(), F.col("m")).otherwise(0)).alias("known"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "m"))).alias("first"))
    group = scratch.keep(group, "groups")
    # Only texts that occur in more than one group need their first id looked up.
    first = group.groupBy("digest").agg(F.min("first.id").alias("first_id"), F.count(F.lit(1)).alias("groups")).where("groups > 1")
    split = group.join(first.select("digest", "first_id"), "digest", "left")
    own = F.col("first_id").isNull() | (F.col("first.id") <= F.col("first_id"))
    later = F.col("known") - F.when(own, F.coalesce(F.col("first.m"), F.lit(0))).otherwise(F.lit(0))
    repeated = 1 << FILTERS.index("E")
    states = F.explode(F.array(F.struct(F.col("failed"), (F.col("n") - later).alias("n")),
                               F.struct((F.col("failed") + repeated).alias("failed"), later.alias("n"))))
    each = split.select("part", "good", "toxic", states.alias("s")).select("part", "s.failed", "s.n", "good", "toxic")
    return each.groupBy("part", "failed").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def edge_removals(sets: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part and lattice edge (state, filter): what the filter removes, and how many orders use the edge.

    Columns: part, state, filter, kept, removed, redundant, unique_fails, good_lost, toxic_lost, orders.
    """
    edge = F.explode(F.array(*[F.struct(F.lit(s).alias("state"), F.lit(f).alias("filter"), F.lit(1 << f).alias("bit"),
                                        F.lit(w).cast("long").alias("orders")) for s, f, w in edges(filters)]))
    rows = sets.withColumn("e", edge).select("part", "failed", "n", "good", "toxic", "e.*")
    fails = F.col("failed").bitwiseAND(F.col("bit")) != 0
    gone = F.col("failed").bitwiseAND(F.col("state")) != 0
    total = lambda c, where: F.sum(F.when(where, F.col(c)).otherwise(0))
    return rows.groupBy("part", "state", "filter", "orders").agg(
        total("n", ~gone & ~fails).alias("kept"), total("n", ~gone & fails).alias("removed"),
        total("n", gone & fails).alias("redundant"), total("n", F.col("failed") == F.col("bit")).alias("unique_fails"),
        total("good", ~gone & fails).alias("good_lost"), total("toxic", ~gone & fails).alias("toxic_lost"))


def shapley(removals: DataFrame) -> DataFrame:
    """The edges with ``shapley``: their filter's removals over all orders, by the edges' path counts."""
    return removals.withColumn("shapley", F.sum(F.col("removed") * F.col("orders")).over(Window.partitionBy("part", "filter")))


def filter_audit(sets: DataFrame, filters: str = FILTERS, orders: Sequence[str] | None = None) -> DataFrame:
    """Every step of the given orders (all, if none are given) in every part, with each filter's Shapley sum."""
    steps = sets.sparkSession.createDataFrame(
        order_steps(filters, orders), "filter_order string, step int, state int, filter int")
    measures = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    # The steps are a constant of the filters (600 rows for five of them).
    return shapley(edge_removals(sets, filters)).join(F.broadcast(steps), ["state", "filter"]).select(
        "part", "filter_order", "step", *measures)


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    """The audit of filters A to E over all documents, by source, for all 120 orders."""
    return filter_audit(failed_sets(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body FROM documents),
w AS (SELECT *, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY body) AS first_id FROM t),
f AS (SELECT doc_id, part, {'A': len(words) < 50,
        'B': 100 * len(list_distinct(words)) < 65 * len(words),
        'C': 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 5 * length(body),
        'D': regexp_matches(body, '[#$%&*|]'),
        'E': coalesce(doc_id > first_id, false)} AS fails FROM w),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id),
g AS (SELECT part, fails.A AS fa, fails.B AS fb, fails.C AS fc, fails.D AS fd, fails.E AS fe, count(*) AS n,
        coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
      FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
failing AS (SELECT part, n, good, toxic, concat(CASE WHEN fa THEN 'A' ELSE '' END, CASE WHEN fb THEN 'B' ELSE '' END,
        CASE WHEN fc THEN 'C' ELSE '' END, CASE WHEN fd THEN 'D' ELSE '' END, CASE WHEN fe THEN 'E' ELSE '' END) AS failed FROM g),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order
  FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
  JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
steps AS (SELECT filter_order, CAST(s AS INTEGER) AS step, substr(filter_order, CAST(s AS BIGINT), 1) AS filter,
                 substr(filter_order, 1, CAST(s AS BIGINT) - 1) AS before
          FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS s)),
each AS (SELECT part, filter_order, step, filter, n, good, toxic, failed, contains(failed, filter) AS fails,
                length(translate(failed, before, '')) < length(failed) AS gone
         FROM steps, failing),
out AS (SELECT part, filter_order, step, filter,
  CAST(sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS BIGINT) AS kept,
  CAST(sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END) AS BIGINT) AS removed,
  CAST(sum(CASE WHEN gone AND fails THEN n ELSE 0 END) AS BIGINT) AS redundant,
  CAST(sum(CASE WHEN failed = filter THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
  CAST(sum(CASE WHEN NOT gone AND fails THEN good ELSE 0 END) AS BIGINT) AS good_lost,
  CAST(sum(CASE WHEN NOT gone AND fails THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM each GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM out
"""

QUERIES = {"op13_filter_audit": op13_filter_audit}
ORACLE = {"op13_filter_audit": ORACLE_SQL}

"""Near-duplicates by ProbMinHash over weighted word shingles.

A text's shingles are its runs of five words (lower case, between white space;
a shorter text is one shingle), weighted by how often they occur in it. Each
shingle is a Poisson process of arrivals, at its weight's rate, at uniformly
chosen registers; a register keeps its first arrival's shingle. A shingle stops
as soon as its next arrival is later than every register's (early termination).
Two registers agree with the probability Jaccard similarity of the texts.

1. Texts are grouped by hash; what follows works on different texts only.
2. Registers in bands give bucket keys. Every bucket links its members to one of
   them, the text that most others share buckets with (a star, not all pairs), each pair is verified by the exact
   probability Jaccard of the texts, and linked texts are joined to components.
3. A star that left members apart goes on with its members outside its largest component. Where these are
   few (``DIRECT``), they are compared with all its members. Otherwise the star's text is the measure: two texts that
   share no shingle beyond it are bounded by what either has of it (``shared_bound``), so a pair is compared only if both
   hold one more shingle, which is found by a join on those shingles (of a text's, those that the fewest of the star's
   members hold first, only so many as carry more weight than two texts of the threshold may differ in: what a text
   holds alone fills its share and joins nothing), or if the bound of
   their classes of equal measures allows it. Inside these smaller groups members are compared all at once where
   they are few, a fixed number at a time where they are many, until none is left; two members outside meet once. The
   distance is a metric, so pairs
   whose distances to the star differ by more than the allowed distance are known not to match; of the
   others only pairs whose registers agree often enough (``AGREE``, five standard errors below the
   threshold) are verified by their texts. No bucket is cut off.
4. Components come from repeated minimum labels over the verified links, as
   tables, after the members of stars have been folded into their first ones;
   nothing of this reaches the driver but counts.

``BANDS`` bands of ``ROWS`` registers find a pair of similarity 0.8 with
probability 0.9998, one of 0.85 with 1 - 2e-6.

Defined results: null text counts as empty; texts without words are only
duplicates of equal texts; rows that repeat are members of their class each,
and one stays; null ids are never a class id unless all ids of the class are
null; an empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch, table, text_or_empty

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 36, 7
REGISTERS = BANDS * ROWS
#: Groups with so many members outside their largest component compare all of them at once; others PIVOTS a round.
FEW, PIVOTS = 4096, 512
#: Stars with at most so many members outside the largest component are compared without a refinement: so many pairs a member.
DIRECT = 16
#: Steps of either measure that members are classed by.
STEPS = 40
#: Share of agreeing registers below which a pair of similarity THRESHOLD is five standard errors away.
AGREE = THRESHOLD - 5 * (THRESHOLD * (1 - THRESHOLD) / REGISTERS) ** 0.5
GROUP_BYTES = 2_000_000
#: Shingles that a task hands on at a time, with the text that passes it.
BATCH_SHINGLES = 200_000

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS = np.ones(1, np.uint64)
_INVERSE = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE ** i and its inverse modulo 2 ** 64, for i below n."""
    global _POWERS, _INVERSE
    if len(_POWERS) < n:
        size = max(n, 2 * GROUP_BYTES)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _POWERS = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, _BASE, np.uint64))])
        _INVERSE = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, inverse, np.uint64))])
    return _POWERS, _INVERSE


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word of the texts, in order."""
    data = [t.lower().encode("utf-8", "replace") for t in texts]
    joined = np.frombuffer(b" " + b" ".join(data) + b" ", np.uint8)
    space = joined <= 32
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    power, inverse = _powers(len(joined))
    total = np.concatenate([[np.uint64(0)], np.cumsum((joined.astype(np.uint64) + np.uint64(1)) * power[:len(joined)])])
    hashes = mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _GOLD)
    first = np.concatenate([[0], np.cumsum([len(d) + 1 for d in data])]) + 1
    return hashes, np.searchsorted(first, starts, side="right") - 1


def shingles(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different shingles of the texts: text number, hash (48 bits), how often. Sorted by text and hash."""
    hashes, doc = word_hashes(texts)
    n = np.bincount(doc, minlength=len(texts))
    rolled = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for j in range(words):
        rolled = rolled * _BASE + hashes[j:len(hashes) - words + 1 + j] if len(rolled) else rolled
    whole = np.flatnonzero(doc[:len(rolled)] == doc[words - 1:]) if len(rolled) else np.empty(0, np.int64)
    value, owner = mix(rolled[whole]), doc[whole]
    short = np.flatnonzero((n > 0) & (n < words))
    if short.size:
        at = np.concatenate([[0], np.cumsum(n)])
        extra = []
        for d in short.tolist():
            h = np.uint64(0)
            with np.errstate(over="ignore"):
                for w in hashes[at[d]:at[d + 1]]:
                    h = h * _BASE + w
            extra.append(h + np.uint64(n[d]))
        value, owner = np.concatenate([value, mix(np.array(extra, np.uint64))]), np.concatenate([owner, short])
    keys = np.sort((owner.astype(np.uint64) << np.uint64(48)) | (value >> np.uint64(16)))
    new = np.flatnonzero(np.diff(keys, prepend=keys[:1] + np.uint64(1)) != 0) if keys.size else np.empty(0, np.int64)
    count = np.diff(np.append(new, keys.size))
    keys = keys[new]
    return (keys >> np.uint64(48)).astype(np.int64), keys & np.uint64((1 << 48) - 1), count


def registers(n_texts: int, doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """The shingle that arrives first at each register of each text (0 in texts without shingles)."""
    first = np.full(n_texts * m, np.inf)
    holder = np.zeros(n_texts * m, np.uint64)
    rate = weight.astype(np.float64)
    time = np.zeros(len(shingle))
    live = np.arange(len(shingle))
    seed = mix(shingle + _GOLD)
    step = 0
    while live.size:
        step += 1
        draw = mix(seed[live] + np.uint64(step) * _GOLD)
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / rate[live]
        place = mix(draw ^ _GOLD)
        slot = doc[live] * m + ((place >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(first, slot, time)
        won = first[slot] == time
        holder[slot[won]] = shingle[live[won]]
        last = first.reshape(n_texts, m).max(1)
        on = time < last[doc[live]]
        live, time = live[on], time[on]
    return holder.reshape(n_texts, m)


def band_keys(holder: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit bucket key per text and band."""
    parts = holder[:, :bands * rows].reshape(-1, bands, rows)
    key = np.arange(bands, dtype=np.uint64)[None, :] * _GOLD + np.uint64(1)
    for r in range(rows):
        key = mix(key * _BASE + parts[:, :, r])
    return key.astype(np.int64)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard of two texts' (sorted shingles, weights): the sum over common shingles of
    1 / sum_j max(a_j / a_i, b_j / b_i)."""
    _, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not ia.size:
        return 0.0
    wa, wb = a[1].astype(float), b[1].astype(float)
    ca, cb = wa[ia], wb[ib]
    only_a, only_b = wa.sum() - ca.sum(), wb.sum() - cb.sum()
    # For a common i with ratio r_i = a_i / b_i: max is a_j / a_i where r_j >= r_i, else b_j / b_i.
    ratio = ca / cb
    order = np.argsort(ratio, kind="stable")
    ratio, ca, cb = ratio[order], ca[order], cb[order]
    below_b = np.concatenate([[0.0], np.cumsum(cb)])
    above_a = np.concatenate([np.cumsum(ca[::-1])[::-1], [0.0]])
    cut = np.searchsorted(ratio, ratio, side="left")
    return float((1.0 / ((above_a[cut] + only_a) / ca + (below_b[cut] + only_b) / cb)).sum())


def _groups(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    group, size, at = [], 0, 0
    for i, t in enumerate(texts):
        group.append(t)
        size += len(t)
        if size >= GROUP_BYTES or len(group) >= 4000:
            yield at, group
            group, size, at = [], 0, i + 1
    if group:
        yield at, group


def _signer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            for at, group in _groups(batch.column("text").to_pylist()):
                doc, value, count = shingles(group)
                holder = registers(len(group), doc, value, count)
                keys = band_keys(holder)
                # A byte of each register is enough to count agreement.
                marks = (holder & np.uint64(255)).astype(np.uint8)
                some = np.bincount(doc, minlength=len(group)) > 0
                ends = np.concatenate([[0], np.cumsum(some * BANDS)]).astype(np.int32)
                part = batch.slice(at, len(group))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("hash"), pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[some].ravel())),
                     pa.array([m.tobytes() for m in marks], pa.binary())], ["id", "hash", "keys", "marks"])


MEASURES = ["total", "inside", "least", "lacks", "beyond", "most"]


def measures(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[float, ...]:
    """Of a text a beside a text b: its weight, its weight on b's shingles, the least ratio of its weight to b's on one of
    them, the weight of b's shingles that it lacks, the number of its shingles that b lacks, and the most that one of these weighs."""
    _, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    inside = float(a[1][ia].sum())
    least = float((a[1][ia] / b[1][ib]).min()) if ia.size else 0.0
    own = np.delete(a[1], ia)
    return float(a[1].sum()), inside, least, float(b[1].sum() - b[1][ib].sum()), float(own.size), float(own.max(initial=0))


VERIFIED = "a long, b long, similarity double, " + ", ".join(f"{c} double" for c in MEASURES)


def _verifier(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, text_a, text_b) to (a, b, similarity and a's measures). Neighbouring rows with the same b read its text once."""
    with np.errstate(over="ignore"):
        known, held = None, (np.empty(0, np.uint64), np.empty(0))
        for batch in batches:
            out = []
            for b, ta, tb in zip(*(batch.column(c).to_pylist() for c in ("b", "text_a", "text_b"))):
                if b != known:
                    known, held = b, shingles([tb])[1:]
                mine = shingles([ta])[1:]
                out.append((probability_jaccard(mine, held), *measures(mine, held)))
            columns = np.array(out, float).reshape(-1, 1 + len(MEASURES)).T
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *map(pa.array, columns)],
                                             ["a", "b", "similarity", *MEASURES])


def _beyond(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(v, b, text, text_b) to (v, b, e, part): the shingles of v that b lacks, each with its part of v's weight."""
    with np.errstate(over="ignore"):
        known, held = None, np.empty(0, np.uint64)
        for batch in batches:
            out, size = [], 0
            for v, b, ta, tb in zip(*(batch.column(c).to_pylist() for c in ("v", "b", "text", "text_b"))):
                if b != known:
                    known, held = b, shingles([tb])[1]
                _, value, weight = shingles([ta])
                own = ~np.isin(value, held, assume_unique=True)
                n = int(own.sum())
                out.append((np.full(n, v), np.full(n, b), value[own].astype(np.int64), weight[own] / weight.sum()))
                size += n
                if size >= BATCH_SHINGLES:
                    yield _beyond_batch(out)
                    out, size = [], 0
            if out:
                yield _beyond_batch(out)


def _beyond_batch(out: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["v", "b", "e", "part"])


def first_beyond(beyond: DataFrame, threshold: float) -> DataFrame:
    """(v, b, e, part) to (v, b, e, short): of each text the shingles that others of the star hold too, the rarest of the star
    first, as long as those before weigh at most 1 - threshold of v; ``short``: at most the part of v that the other text may
    lack if it lacks no less of it than v does of the other.

    In every pair of the threshold that shares such shingles the first of them is among either's, and short in one of them,
    whichever order the star's texts have in common; in this one the fewest texts meet.
    """
    half = (1 / threshold - 1) / 2
    held = beyond.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("b", "e")))
    upto = F.sum("part").over(Window.partitionBy("b", "v").orderBy("n", "e").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = held.withColumn("before", upto - F.col("part"))
    return before.where((F.col("n") > 1) & (F.col("before") <= 1 - threshold + 1e-9)).select(
        "v", "b", "e", (F.col("before") <= half / (1 + half) + 1e-9).alias("short"))


def shared_bound(u: str, v: str) -> Column:
    """The probability Jaccard of two texts that share no shingle beyond their star is at most this.

    With shares x and y of their weights on shingles of both, it is at most 1 / (1 / x + 1 / y - 1). What the
    one lacks of the star more than the other, the other holds alone, by at least its least ratio. ``u`` and ``v`` are
    prefixes of columns: the greatest ``inside`` share and ``total``, the least ``least``, the least and greatest ``lacks``.
    """
    c = lambda p, n: F.col(f"{p}_{n}")
    share = lambda p, q: c(p, "share") - c(p, "least") * F.greatest(F.lit(0.0), c(q, "lacks0") - c(p, "lacks1")) / c(p, "total")
    return _joined(share(u, v), share(v, u))


def _joined(x: Column, y: Column) -> Column:
    return F.when((x > 0) & (y > 0), 1 / (1 / x + 1 / y - 1)).otherwise(F.lit(0.0))


def pair_bound(mine: str = "", theirs: str = "p", sharing: Column | None = None) -> Column:
    """The same of any two texts by their measures beside one star: what a text shares beyond the star with another
    weighs no more than all it has there, and than the other's number of such shingles at its own heaviest (nothing, if not ``sharing``)."""
    c = lambda p, n: F.col(f"{p}{n}")

    def share(p: str, q: str) -> Column:
        on_star = c(p, "inside") - c(p, "least") * F.greatest(F.lit(0.0), c(q, "lacks") - c(p, "lacks"))
        beyond = F.least(c(p, "total") - c(p, "inside"), c(p, "most") * c(q, "beyond"))
        beyond = beyond if sharing is None else F.when(sharing, beyond).otherwise(F.lit(0.0))
        return (on_star + beyond) / c(p, "total")
    return _joined(share(mine, theirs), share(theirs, mine))


def _agreeing(least: float):
    """(v, marks, pv, pmarks) to the pairs (a, b) whose registers agree in a share of at least ``least``."""
    def agree(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine, theirs = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, REGISTERS)
                            for c in ("marks", "pmarks"))
            ok = np.flatnonzero((mine == theirs).mean(1) >= least)
            v, p = batch.column("v").to_numpy()[ok], batch.column("pv").to_numpy()[ok]
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(v, p)), pa.array(np.minimum(v, p))], ["a", "b"])
    return agree


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(v, label): the smallest vertex of each vertex's component. Links are (a, b) rows.

    Every vertex with a smaller neighbour is folded into its smallest one, whose links it hands over; on what
    remains every vertex takes the smallest label among itself and its neighbours, then its label's label, until
    nothing changes.
    """
    links = scratch.keep(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    fold = scratch.keep(links.groupBy("a").agg(F.min("b").alias("p")), "fold")
    handed = links.join(fold.hint("merge"), "a").where("b <> p").select(F.greatest("b", "p").alias("a"), F.least("b", "p").alias("b"))
    # A smaller neighbour may be folded itself: its own link stays in the smaller graph.
    inner = fold.join(links.select(F.col("b").alias("a")).distinct(), "a", "left_semi").select("a", F.col("p").alias("b"))
    core = handed.unionByName(inner).distinct()
    both = scratch.keep(core.unionByName(core.select(F.col("b").alias("a"), F.col("a").alias("b"))), "core")
    labels = scratch.keep(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while both.take(1):
        near = both.join(labels.withColumnRenamed("v", "b"), "b").groupBy(F.col("a").alias("v")).agg(F.min("label").alias("near"))
        step = scratch.keep(labels.join(near, "v").select("v", "label", F.least("label", "near").alias("next")), "step")
        jump = step.select(F.col("v").alias("next"), F.col("next").alias("far"))
        new = scratch.keep(step.join(jump, "next").select("v", F.least("next", "far").alias("label"), F.col("label").alias("was")), "labels")
        changed = new.where("label <> was").take(1)
        scratch.drop(step)
        scratch.drop(labels)
        labels = new
        if not changed:
            break
    # Folded vertices take their first one's label, which is its own unless it is in the smaller graph.
    near = fold.join(labels.select(F.col("v").alias("p"), "label").hint("merge"), "p", "left")
    folded = near.select(F.col("a").alias("v"), F.coalesce("label", "p").alias("label"))
    roots = links.select(F.col("b").alias("v")).distinct().join(fold.select(F.col("a").alias("v")), "v", "left_anti")
    roots = roots.join(labels.select("v", "label"), "v", "left").select("v", F.coalesce("label", "v").alias("label"))
    out = scratch.keep(folded.unionByName(roots), "components")
    for df in (links, fold, both, labels):
        scratch.drop(df)
    return out


class NearDuplicates:
    """The tables of one run: ``rows`` (id, hash), ``texts`` (v, hash, id, n) and ``labels`` (v, label) of linked texts."""

    def __init__(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                 few: int = FEW, pivots: int = PIVOTS):
        self.scratch = Scratch(df.sparkSession, "near-dup")
        self.threshold, self.few, self.pivots = threshold, few, pivots
        kind = df.schema[id_col].dataType.simpleString()
        text = text_or_empty(F.col(text_col))
        self.source = df.select(F.col(id_col).alias("id"), F.unhex(F.md5(text.cast("binary"))).alias("hash"), text.alias("text"))
        keep = self.scratch.keep
        self.rows = keep(self.source.mapInArrow(_signer, f"id {kind}, hash binary, keys array<long>, marks binary"), "rows")
        # The number given to a text is fixed by writing it down.
        self.texts = keep(self.rows.groupBy("hash").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"),
                                                        F.first("keys").alias("keys"), F.first("marks").alias("marks"))
                          .withColumn("v", F.monotonically_increasing_id()), "texts")
        self.links, self.labels = self._link()

    def _link(self) -> tuple[DataFrame, DataFrame]:
        """The verified links (a, b, similarity) and the components' labels (v, label)."""
        keep, drop = self.scratch.keep, self.scratch.drop
        member = self.texts.select("v", F.explode("keys").alias("key"))
        shared = member.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        sized = keep(member.join(shared.hint("merge"), "key"), "sized")
        # A bucket's first member is the one that most texts share buckets with: in a group of near copies the text
        # that all of them are near to, so that its star holds the group together.
        central = sized.join(sized.groupBy("v").agg(F.sum("size").alias("c")).hint("merge"), "v")
        firsts = central.groupBy("key").agg(F.max_by("v", F.struct("c", -F.col("v"))).alias("b"))
        buckets = keep(sized.select("key", "v").join(firsts.hint("merge"), "key"), "buckets")
        texts = self.texts.select("v", "hash", "id").join(buckets.select("v").distinct(), "v")
        same = (F.col("s.hash") == F.col("t.hash")) & F.col("s.id").eqNullSafe(F.col("t.id"))
        bodies = keep(self.source.alias("s").join(texts.alias("t").hint("merge"), same).groupBy("v").agg(
            F.first("text").alias("text")), "bodies")
        star = keep(self._verify(buckets.where("v <> b").select(F.col("v").alias("a"), "b").distinct(), bodies), "star")
        matched = lambda df: df.where(F.col("similarity") >= self.threshold).select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), "similarity")
        links = matched(star)
        labels = components(links, self.scratch)
        more = [keep(self._verify(pairs, bodies), "more") for pairs in self._more_pairs(star, labels, bodies)]
        for found in more:
            links = links.unionByName(matched(found))
        links = keep(links.distinct(), "links")
        if any(matched(found).take(1) for found in more):
            drop(labels)
            labels = components(links, self.scratch)
        for df in (sized, buckets, bodies, star, *more):
            drop(df)
        return links, labels

    def _verify(self, pairs: DataFrame, bodies: DataFrame) -> DataFrame:
        with_a = pairs.join(bodies.select(F.col("v").alias("a"), F.col("text").alias("text_a")), "a")
        with_b = with_a.join(bodies.select(F.col("v").alias("b"), F.col("text").alias("text_b")).hint("merge"), "b")
        return with_b.select("a", "b", "text_a", "text_b").mapInArrow(_verifier, VERIFIED)

    def _marked(self, rows: DataFrame) -> DataFrame:
        """The rows (key, v, comp, ...) of groups of several components with ``out`` (outside their group's largest one) and
        ``others``, the number of these."""
        sizes = rows.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
        largest = sizes.groupBy("key").agg(F.max_by("comp", F.struct("n", -F.col("comp"))).alias("largest"),
                                           (F.sum("n") - F.max("n")).alias("others")).where("others > 0")
        return rows.join(largest.hint("merge"), "key").withColumn("out", F.col("comp") != F.col("largest")).drop("largest")

    def _refined(self, rows: DataFrame, bodies: DataFrame) -> DataFrame:
        """The members (key: star) again in smaller groups (key: star and shingle, or star and two classes of members), such
        that every pair with a member outside that may match is in one of them."""
        text = lambda c, name: bodies.select(F.col("v").alias(c), F.col("text").alias(name))
        pairs = rows.select("v", F.col("key").alias("b")).join(text("v", "text"), "v").join(text("b", "text_b").hint("merge"), "b")
        beyond = pairs.select("v", "b", "text", "text_b").mapInArrow(_beyond, "v long, b long, e long, part double")
        more = first_beyond(beyond, self.threshold)
        by_shingle = more.select(F.col("b").alias("key"), "v", F.xxhash64("b", "e").alias("part"), "short", F.lit(True).alias("sharing"))
        # Classes of members by their share inside the star and what they lack of it.
        share = F.col("inside") / F.col("total")
        own = F.struct(F.floor(share * STEPS).alias("i"), F.floor(F.col("lacks") / (F.col("lacks") + F.col("total")) * 2 * STEPS).alias("j"))
        classed = rows.select("key", "v", "total", share.alias("share"), "least", "lacks", own.alias("class"), "out")
        classes = classed.groupBy("key", "class").agg(
            F.max("total").alias("total"), F.max("share").alias("share"), F.min("least").alias("least"), F.min("lacks").alias("lacks0"),
            F.max("lacks").alias("lacks1"), F.count_if("out").alias("out"))
        side = lambda p: classes.select("key", *[F.col(c).alias(f"{p}_{c}") for c in classes.columns if c != "key"])
        near = side("u").where("u_out > 0").join(side("v").hint("merge"), "key").where(shared_bound("u", "v") >= self.threshold - 1e-9)
        near = near.select("key", F.xxhash64("key", "u_class", "v_class").alias("part"),
                           F.explode(F.array_distinct(F.array("u_class", "v_class"))).alias("class"))
        by_class = classed.select("key", "v", "class").join(near.hint("merge"), ["key", "class"]).select(
            "key", "v", "part", F.lit(True).alias("short"), F.lit(False).alias("sharing"))
        parts = self.scratch.keep(by_shingle.unionByName(by_class).distinct(), "members")
        # Shingles of one edit have the same members: one of equal groups is enough, and none of a single one.
        sums = [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("v").cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64("v", F.lit(1))).alias("x")]
        equal = parts.groupBy("key", "part", "sharing").agg(*sums).where("n > 1")
        first = F.min("part").over(Window.partitionBy("key", "sharing", "n", "s", "x")).alias("first")
        equal = equal.select("key", "part", "sharing", first)
        parts = parts.join(equal.hint("merge"), ["key", "part", "sharing"]).groupBy("key", "first", "sharing", "v").agg(F.max("short").alias("short"))
        own = rows.drop("short", "sharing", "out", "others")
        return parts.join(own.hint("merge"), ["key", "v"]).drop("key").withColumnRenamed("first", "key")

    def _more_pairs(self, star: DataFrame, labels: DataFrame, bodies: DataFrame) -> Iterator[DataFrame]:
        """Pairs (a, b) still to be verified, a frame per round; groups with few members apart are done in the first."""
        keep = self.scratch.keep
        apart = star.where(F.col("similarity") < self.threshold).select("b").distinct()
        if not apart.take(1):
            return
        info = self.texts.select("v", "marks").join(labels, "v", "left").select(
            "v", "marks", F.coalesce("label", "v").alias("comp"))
        rows = star.join(apart.hint("merge"), "b", "left_semi").withColumnRenamed("a", "v").join(info.hint("merge"), "v")
        rows = rows.withColumnRenamed("b", "key").withColumns({"short": F.lit(True), "sharing": F.lit(True)})
        opened = keep(self._marked(rows), "open")
        direct, large = opened.where(F.col("others") <= DIRECT), opened.where(F.col("others") > DIRECT)
        fields = ["key", "v", "comp", "marks", "similarity", "short", "sharing", "out", *MEASURES]
        groups = direct.select(fields)
        turn, many = groups.where("out"), None
        if large.take(1):
            parts = keep(self._marked(self._refined(large, bodies)), "parts")
            groups = groups.unionByName(parts.select(fields))
            turn = turn.unionByName(parts.where(F.col("out") & (F.col("others") <= self.few)).select(fields))
            many = parts.where(F.col("out") & (F.col("others") > self.few)).select(fields)
        pivoted, slot = None, F.pmod(F.xxhash64("v"), F.lit(self.pivots)).alias("slot")
        while True:
            busy = False
            if many is not None:
                left = many if pivoted is None else many.join(pivoted, ["key", "v"], "left_anti")
                some = keep(left.groupBy("key", slot).agg(F.min("v").alias("v")).select("key", "v"), "pivots")
                busy = bool(some.take(1))
                if busy:
                    chosen = many.join(some, ["key", "v"], "left_semi")
                    turn = chosen if turn is None else turn.unionByName(chosen)
            if turn is None:
                return
            p = turn.select("key", F.col("v").alias("pv"), F.col("comp").alias("pc"), F.col("marks").alias("pmarks"),
                            F.col("similarity").alias("ps"), F.col("short").alias("pshort"), *[F.col(m).alias(f"p{m}") for m in MEASURES])
            far = 1 - self.threshold + 1e-9
            pairs = groups.join(p.hint("merge"), "key").where(
                (F.col("comp") != F.col("pc")) & (~F.col("out") | (F.col("v") < F.col("pv")))
                & (F.abs(F.col("similarity") - F.col("ps")) <= far) & (F.col("short") | F.col("pshort"))
                & (pair_bound(sharing=F.col("sharing")) >= self.threshold - 1e-9))
            agree = AGREE - THRESHOLD + self.threshold
            yield pairs.select("v", "marks", "pv", "pmarks").mapInArrow(_agreeing(agree), "a long, b long").distinct()
            if not busy:
                return
            pivoted, turn = some if pivoted is None else pivoted.unionByName(some), None

    def classes(self) -> DataFrame:
        """Per text (v, label, hash): ``class_id`` (smallest id of the class), ``class_size`` in rows, ``n_star_links``:
        verified links to other texts by bucket stars and by the rounds that join classes (pairs already in one class aren't compared)."""
        own = self.texts.select("v", "hash", "id", "n").join(self.labels, "v", "left").withColumn(
            "label", F.coalesce("label", "v"))
        per = own.groupBy("label").agg(F.min("id").alias("class_id"), F.sum("n").alias("class_size"))
        both = self.links.select(F.col("a").alias("v")).unionByName(self.links.select(F.col("b").alias("v")))
        degree = both.groupBy("v").agg(F.count(F.lit(1)).alias("n_star_links"))
        return own.join(per.hint("merge"), "label").join(degree, "v", "left").select(
            "v", "label", "hash", "class_id", "class_size", F.coalesce("n_star_links", F.lit(0)).alias("n_star_links"))

    def members(self) -> DataFrame:
        """One row per input row: id, hash, class_id, class_size, n_star_links (of its text) and kept."""
        ids = self.rows.groupBy("hash", "id").agg(F.count(F.lit(1)).alias("m"))
        out = ids.join(self.classes().hint("merge"), "hash")
        # Of the rows with the class's id, one stays (an id can stand at several texts, of one class or of several).
        best = out.where(F.col("id").eqNullSafe(F.col("class_id"))).groupBy("label").agg(F.min("hash").alias("best"))
        out = out.join(best.hint("merge"), "label", "left")
        stays = F.col("id").eqNullSafe(F.col("class_id")) & (F.col("hash") == F.col("best"))
        return out.select("id", "hash", "class_id", "class_size", "n_star_links", stays.alias("stays"),
                          F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))).alias("copy")).select(
            "id", "hash", "class_id", "class_size", "n_star_links", (F.col("stays") & (F.col("copy") == 1)).alias("kept"))


def op7_prob_minhash(spark, sf_dir: str) -> DataFrame:
    """Every document with its class of near-duplicates."""
    found = NearDuplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).members()
    return found.select(F.col("id").alias("doc_id"), "class_id", "class_size", "n_star_links", "kept")


QUERIES = {"op7_prob_minhash": op7_prob_minhash}
ORACLE: dict[str, str] = {}

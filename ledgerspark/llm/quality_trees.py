"""Quality rules: gradient-boosted trees over document statistics.

One Arrow pass counts a document's statistics from its bytes (words, lines, symbols,
repeated windows, letter cases), vectorised over many documents at once. A boosted
forest of small trees, fitted on labelled documents that aren't held out, turns them
into a verdict. The forest is flattened into numpy node arrays (feature, threshold,
children, value), so a batch of documents walks all trees together, a level at a time.

Monotonic constraints hold for the features in ``MONOTONE``: more symbols, repeated
lines, repeated windows, shouting or repetition of one word never raise a score, more
different words never lower it. A split that would break a constraint is not taken, and
the values of either side are bounded by the split's middle from then on, so the whole
forest is monotonic, not only a single split.

The fit reads a bounded sample (``Fit.rows`` labelled documents by hash of their id); its
ids are broadcast and only their statistics, some twenty numbers each, reach the driver.
Counts and scores cover every document and its whole text; scoring needs no shuffle.

Defined results: a null text is empty, it has no words and fails the base rules; rows are
scored one by one, so repeated rows get equal results; a null id is kept and never
labelled; a document with several label rows counts as good if one of them says so; label
rows without a quality are skipped. With no label of one of the two classes there is no
model: the score is null and the base rules alone decide. An empty table gives an empty
table. A text is read whole: about 60 bytes for each word of the longest text. Further
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.common import hash_sample, held_out, table, text_or_empty, text_slices

#: Base rules: documents with fewer words, or a larger share (in hundredths) of words in repeated windows, fail.
MIN_WORDS = 20
MOST_REPEATED_PCT = 30
#: Words of a window that is looked for twice (a power of two).
WINDOW = 8
#: Documents whose probability of good quality is lower are not kept.
THRESHOLD = 0.5
SLICE_BYTES = 4 << 20
_CHUNK = 1 << 20

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_chars", "n_lines", "n_distinct", "n_top", "n_upper", "n_lower", "n_other_letters", "n_digits", "n_shouts", "n_stops", "n_marks"]

# Classes of bytes; those above ASCII are letters of other alphabets, counted by their first byte.
_CLASSES = ["inner", "newline", "blank", "upper", "lower", "other", "digit", "symbol", "shout", "stop", "mark", "control"]
_CLASS = np.full(256, _CLASSES.index("control"), np.uint8)
for _name, _bytes in {"inner": range(128, 192), "other": range(192, 256), "mark": range(33, 127), "newline": b"\n",
                      "blank": b" \t\x0b\x0c\r", "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58),
                      "symbol": b"#*$%&|<>", "shout": b"!?", "stop": b".,;:"}.items():
    _CLASS[[*_bytes]] = _CLASSES.index(_name)
_SPACE = np.isin(np.arange(256), [*b" \t\n\x0b\x0c\r"])


# ---------------------------------------------------------------- statistics
def _class_counts(raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Bytes of each class in each text, a chunk of bytes at a time."""
    k = len(_CLASSES)
    out = np.zeros((len(ends) - 1, k), np.int64)
    for lo in range(0, len(raw), _CHUNK):
        hi = min(len(raw), lo + _CHUNK)
        first, last = np.searchsorted(ends, lo, "right") - 1, np.searchsorted(ends, hi, "left")
        size = np.diff(np.clip(ends[first:last + 1], lo, hi))
        at = np.repeat(np.arange(last - first) * k, size) + _CLASS[raw[lo:hi]]
        out[first:last] += np.bincount(at, minlength=(last - first) * k).reshape(-1, k)
    return out


def _encoded(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers of equal byte strings (neighbouring slices of ``raw``), and how many there are."""
    strings = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
    coded = pc.dictionary_encode(strings)
    return coded.indices.to_numpy().astype(np.int64), max(1, len(coded.dictionary))


def _repeated(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each key, and whether it occurs more than once."""
    _, number, count = np.unique(key, return_inverse=True, return_counts=True)
    return number, count[number] > 1


def _pair_key(a: np.ndarray, b: np.ndarray, doc: np.ndarray | None, size: int) -> np.ndarray:
    key, top = a, size
    if doc is not None:
        if size * (int(doc.max(initial=0)) + 1) >= 1 << 62:
            raise OverflowError("a slice holds too many different words")
        key = doc * size + a
        top = size * (int(doc.max(initial=0)) + 1)
    if top * size >= 1 << 62:
        key = np.unique(key, return_inverse=True)[1]
    return key * size + b


def repeated_window_words(codes: np.ndarray, doc: np.ndarray, size: int, window: int = WINDOW) -> np.ndarray:
    """Which words lie in a window of ``window`` words that its text holds twice or more.

    Windows are doubled: one of 2k words repeats only if both its halves do, so all but the first step see
    the few positions that repeat.
    """
    n = len(codes)
    at = np.flatnonzero(doc[:-1] == doc[1:]) if n > 1 else np.empty(0, np.int64)
    number, again = _repeated(_pair_key(codes[at], codes[at + 1], doc[at], size))
    at, number, width = at[again], number[again], 2
    while width < window:
        other = np.searchsorted(at, at + width)
        both = other < len(at)
        both[both] = at[other[both]] == at[both] + width
        both[both] &= doc[at[both]] == doc[np.minimum(at[both] + 2 * width - 1, n - 1)]
        at, left, right = at[both], number[both], number[other[both]]
        number, again = _repeated(_pair_key(left, right, None, int(number.max(initial=0)) + 1))
        at, number, width = at[again], number[again], 2 * width
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, np.minimum(at + window, n), -1)
    return np.cumsum(change[:-1]) > 0


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of each text (strings without nulls)."""
    m = len(texts)
    texts = texts.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64, m + 1, texts.offset * 8) if m else np.zeros(1, np.int64)
    base = int(ends[0])
    raw = np.frombuffer(texts.buffers()[2], np.uint8, int(ends[-1]) - base, base) if ends[-1] > base else np.empty(0, np.uint8)
    ends = ends - base
    count = dict(zip(_CLASSES, _class_counts(raw, ends).T))
    chars = sum(count.values()) - count["inner"]
    out = {"n_chars": chars, "word_chars": chars - count["newline"] - count["blank"], "n_symbols": count["symbol"],
           "n_upper": count["upper"], "n_lower": count["lower"], "n_other_letters": count["other"], "n_digits": count["digit"],
           "n_shouts": count["shout"], "n_stops": count["stop"], "n_marks": count["mark"]}
    per_text = lambda docs: np.bincount(docs, minlength=m)

    # Words.
    inside = ~_SPACE[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = ends[:-1][ends[:-1] < len(raw)]
    begins[edges] |= inside[edges]
    begins = np.flatnonzero(begins)
    doc = np.searchsorted(ends, begins, "right") - 1
    out["n_words"] = per_text(doc)
    packed = np.append(np.cumsum(inside)[begins] - 1, np.count_nonzero(inside)).astype(np.int64)
    codes, size = _encoded(raw[inside], packed)
    kinds, uses = np.unique(doc * size + codes, return_counts=True)
    out["n_distinct"] = per_text(kinds // size)
    out["n_top"] = np.zeros(m, np.int64)
    np.maximum.at(out["n_top"], kinds // size, uses)
    out["n_repeat_words"] = per_text(doc[repeated_window_words(codes, doc, size)])

    # Lines that hold a word.
    breaks = np.flatnonzero(raw == 10)
    starts = np.union1d(edges, breaks + 1)
    starts = starts[starts < len(raw)]
    full = np.zeros(len(starts), bool)
    full[np.searchsorted(starts, begins, "right") - 1] = True
    packed = np.append(starts - np.searchsorted(breaks, starts), len(raw) - len(breaks)).astype(np.int64)
    codes, size = _encoded(raw[raw != 10], packed)
    doc = np.searchsorted(ends, starts[full], "right") - 1
    out["n_lines"] = per_text(doc)
    out["n_dup_lines"] = out["n_lines"] - per_text(np.unique(doc * size + codes[full]) // size)
    return out


#: Features, and whether the score may only fall (-1) or only rise (1) with them.
MONOTONE = {"log_words": 0, "word_length": 0, "symbols": -1, "capitals": 0, "digits": 0, "shouts": -1, "stops": 0, "marks": 0,
            "dup_lines": -1, "repeat_words": -1, "distinct": 1, "top_word": -1, "line_words": 0}


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    """One row of ``MONOTONE``'s features for each text."""
    share = lambda a, b: s[a] / np.maximum(1, b)
    words, chars = s["n_words"], s["n_chars"]
    columns = {
        "log_words": np.log1p(words), "word_length": share("word_chars", words), "symbols": share("n_symbols", chars),
        "capitals": share("n_upper", s["n_upper"] + s["n_lower"] + s["n_other_letters"]), "digits": share("n_digits", chars),
        "shouts": share("n_shouts", words), "stops": share("n_stops", words), "marks": share("n_marks", chars),
        "dup_lines": share("n_dup_lines", s["n_lines"]), "repeat_words": share("n_repeat_words", words),
        "distinct": share("n_distinct", words), "top_word": share("n_top", words), "line_words": share("n_words", s["n_lines"])}
    return np.column_stack([columns[name] for name in MONOTONE])


# ---------------------------------------------------------------- trees
@dataclass
class Trees:
    """All trees in one array of nodes; a leaf is its own child."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """The log-odds of good quality; rows are walked down all trees together."""
        out = np.empty(len(x))
        for lo in range(0, len(x), 4096):
            part = x[lo:lo + 4096]
            node = np.broadcast_to(self.roots, (len(part), len(self.roots)))
            row = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                node = np.where(part[row, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            out[lo:lo + 4096] = self.start + self.value[node].sum(axis=1)
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -500, 500)))


@dataclass(frozen=True)
class Fit:
    """Bounds and settings of the fit."""

    rows: int = 20_000          # labelled documents that are read at most
    trees: int = 60
    depth: int = 4
    rate: float = 0.2
    bins: int = 64
    ridge: float = 1.0
    least_weight: float = 2.0   # of the second derivatives on either side of a split
    monotone: tuple[int, ...] = field(default_factory=lambda: tuple(MONOTONE.values()))


def fit_trees(x: np.ndarray, y: np.ndarray, fit: Fit = Fit()) -> Trees:
    """Newton boosting of the logistic loss on histograms of the features."""
    n, k = x.shape
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, fit.bins + 1)[1:-1], method="lower")) for f in range(k)]
    width = max(len(c) for c in cuts) + 1
    binned = np.column_stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)]) + np.arange(k) * width
    valid = np.arange(width)[None, :] < np.array([len(c) for c in cuts])[:, None]
    sign = np.array(fit.monotone)[:, None]
    nodes: list[list] = []      # feature, threshold, left, right, value
    roots = []

    def best_value(g, h, low, high):
        return np.clip(-g / (h + fit.ridge), low, high)

    def gain(g, h, w):
        return -(2 * g * w + (h + fit.ridge) * w * w)

    def grow(rows, g, h, low, high, depth):
        at, total_g, total_h = len(nodes), g[rows].sum(), h[rows].sum()
        nodes.append([0, np.inf, at, at, fit.rate * float(best_value(total_g, total_h, low, high))])
        if depth == fit.depth or len(rows) < 2:
            return at
        flat = binned[rows].ravel()
        hist = lambda w: np.bincount(flat, np.repeat(w[rows], k), minlength=k * width).reshape(k, width).cumsum(axis=1)
        gl, hl = hist(g), hist(h)
        gr, hr = total_g - gl, total_h - hl
        wl, wr = best_value(gl, hl, low, high), best_value(gr, hr, low, high)
        better = gain(gl, hl, wl) + gain(gr, hr, wr) - gain(total_g, total_h, best_value(total_g, total_h, low, high))
        allowed = valid & (hl >= fit.least_weight) & (hr >= fit.least_weight) & (sign * (wr - wl) >= 0)
        better = np.where(allowed, better, -np.inf)
        f, b = np.unravel_index(np.argmax(better), better.shape)
        if better[f, b] <= 1e-9:
            return at
        middle = (wl[f, b] + wr[f, b]) / 2
        # Behind a constrained split neither side may cross the middle.
        (ll, lh), (rl, rh) = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)),
                              -1: ((middle, high), (low, middle))}[fit.monotone[f]]
        goes_left = binned[rows, f] - f * width <= b
        left = grow(rows[goes_left], g, h, ll, lh, depth + 1)
        right = grow(rows[~goes_left], g, h, rl, rh, depth + 1)
        nodes[at] = [f, cuts[f][b], left, right, 0.0]
        return at

    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    start = float(np.log(share / (1 - share)))
    score = np.full(n, start)
    for _ in range(fit.trees):
        p = 1 / (1 + np.exp(-np.clip(score, -500, 500)))
        begin = len(nodes)
        roots.append(grow(np.arange(n), p - y, p * (1 - p), -np.inf, np.inf, 0))
        tree = _trees(nodes, roots[-1:], fit.depth, 0.0)
        if len(nodes) == begin + 1:      # no split helps any more
            break
        score += tree.margin(x)
    return _trees(nodes, roots, fit.depth, start)


def _trees(nodes: list[list], roots: list[int], depth: int, start: float) -> Trees:
    columns = list(zip(*nodes))
    kinds = [np.int64, np.float64, np.int64, np.int64, np.float64]
    return Trees(*[np.array(c, t) for c, t in zip(columns, kinds)], np.array(roots, np.int64), depth, start)


# ---------------------------------------------------------------- Spark side
def _counter():
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, texts in text_slices(batch.column(1), SLICE_BYTES):
                x = features(statistics(texts))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(texts)), pa.array(list(x), pa.list_(pa.float64()))],
                                                 ["good", "x"])
    return count


def fit_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit: Fit = Fit()) -> Trees | None:
    """The forest, from labelled documents that aren't held out; None without both classes."""
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    marks = marks.groupBy(F.col("doc_id").alias("_key")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"))
    picked = hash_sample(marks, F.col("_key"), fit.rows, marks.count())
    rows = docs.select(F.col(id_col).alias("_key"), text_or_empty(F.col(text_col)).alias("_text"))
    # At most ``fit.rows`` ids are broadcast.
    rows = rows.join(F.broadcast(picked), "_key").select("good", "_text").mapInArrow(_counter(), "good int, x array<double>").toArrow()
    y = rows.column("good").to_numpy().astype(float)
    if not 0 < y.sum() < len(y):
        return None
    x = np.array(rows.column("x").to_pylist())
    order = np.lexsort([*x.T, y])        # the same forest for the same rows, however they arrive
    return fit_trees(x[order], y[order], fit)


def _scorer(model: Trees | None):
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, texts in text_slices(batch.column(1), SLICE_BYTES):
                s = statistics(texts)
                p = pa.nulls(len(texts), pa.float64()) if model is None else pa.array(model.probability(features(s)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(texts)), *(pa.array(s[c].astype(np.int64)) for c in (*COUNTS, *MORE)), p],
                    ["id", *COUNTS, *MORE, "score"])
    return score


def quality_rules(df: DataFrame, model: Trees | None, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, counts, score, ``base_failed`` and ``kept``."""
    rows = df.select(F.col(id_col).alias("id"), text_or_empty(F.col(text_col)).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in (*COUNTS, *MORE))
    out = rows.mapInArrow(_scorer(model), f"id {kind}, {counts}, score double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PCT * F.col("n_words"))
    good = F.coalesce(F.col("score") >= threshold, F.lit(True))
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & good).withColumnRenamed("id", id_col)


def op11_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Every document's base counts and verdict; labels of held-out rows are never read."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_model(docs, table(spark, sf_dir, "labels"))
    return quality_rules(docs, model).select("doc_id", *COUNTS, "base_failed", "kept", "score")


#: The verdict of a fitted forest can't be said in SQL; tests hold the counts against brute force and the verdict against labels.
QUERIES = {"op11_quality_rules": op11_quality_rules}
ORACLE: dict[str, str] = {}

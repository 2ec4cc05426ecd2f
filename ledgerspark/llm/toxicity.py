"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

The kernel of two strings is the gap-weighted count of common subsequences of
three characters: an occurrence that spans ``g`` characters weighs ``DECAY**g``;
kernels are normalised by the strings' own. Inserted characters and gaps lower
it, they don't break it. Units of a text are its words (lower case, without
punctuation at the ends, with a mark at the beginning and the end), runs of
single letters read as one word, and overlapping windows of very long words.

Training uses a bounded sample of labelled documents (``Fit`` names the bounds;
the ids are drawn from the labels by hash and broadcast, so no text is
shuffled). Spark counts, per word, the neighbours and documents that it has in
toxic and in clean sample documents. Sentences that hold a word typical of
toxic documents are the positive sentences, those of clean documents the
negative ones. A sentence stands for its highest-scoring unit: the machine
(squared hinge, Nyström features of landmark words) is fitted, units are chosen
anew, and it is fitted again. Then the words of clean sample documents that it
scores highest join the negative side and it is fitted once more, twice. The
positive side also has the typical words, some with characters put in. A document's decision value is that of its
highest sentence, cut off at the machine's margin. A sigmoid over it and over
the numbers of words, and of different words, on the toxic side makes it a
probability; it is fitted on the half of the sample that the machine didn't see,
weighted to the labels' share of toxic rows.

Since the score is linear in the landmarks' kernels, it is a weighted sum over
triples of characters. The fitted model is the weights of the landmarks' triples (at
most 192 times 2024; for small alphabets beside them a table of all triples), shipped to the
tasks; scoring needs no shuffle. A text is read whole, very long ones too: by its words, each of
which is scored once per task.

Defined results: null or empty text scores as the empty string; null labels
are not used, a doc_id with several labels counts as toxic if their mean is at
least one half; without labels of both kinds every row scores the share of
toxic labels (0 without any); rows that repeat are scored each; an empty table
gives an empty table; further columns are kept by `score_documents`.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.common import Scratch, hash_sample, held_out, table, text_or_empty

DECAY = 0.8
#: Words longer than this are read through overlapping windows.
WINDOW = 24
CACHE_WORDS = 400_000
#: Triples of so small an alphabet are numbered by a table of all of them, those of a larger one by search.
TABLE_LETTERS = 160
THRESHOLD = 0.7
#: Words with a higher decision value are counted as evidence.
HIT = 0.5
SPELLED = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")
BEGIN, END = "\x02", "\x03"
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»„“”‚‘’…–—¡¿·"


@dataclass(frozen=True)
class Fit:
    """Bounds and settings of the training."""

    toxic_docs: int = 4000          # labelled documents in the sample
    clean_docs: int = 8000
    sentence_words: int = 40        # a longer sentence is cut into pieces of so many words
    toxic_sentences: int = 4000     # sentences in the machine's training set
    clean_sentences: int = 2000
    typical_words: int = 2000       # words typical of toxic documents, by their number of neighbours
    min_neighbours: int = 3
    min_lift: float = 20.0
    disguised_words: int = 60       # typical words that also enter with characters put in
    landmarks: int = 192
    rounds: int = 3
    mined_words: int = 2000         # highest-scoring clean words added in each of the mining rounds
    mining: int = 2
    penalty: float = 1e-4


# ---- the kernel -------------------------------------------------------------------------------------------------

@lru_cache(maxsize=64)
def _triples(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of all triples in a string of n characters, and their weights."""
    ijk = np.array(list(combinations(range(n), 3)), np.int64).reshape(-1, 3)
    return ijk[:, 0], ijk[:, 1], ijk[:, 2], (DECAY ** (ijk[:, 2] - ijk[:, 0] + 1)).astype(np.float64)


def _points(words: list[str], n: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(-1, n).astype(np.int64)


def own_kernel(chars: np.ndarray) -> np.ndarray:
    """k(s, s) of strings of one length (rows of code points)."""
    rows, n = chars.shape
    inner = np.ones((n + 1, n + 1, rows))
    same = [[(chars[:, a] == chars[:, b]).astype(np.float64) if a != b else 1.0 for b in range(n)] for a in range(n)]
    for _ in range(2):
        nxt = np.zeros((n + 1, n + 1, rows))
        for a in range(1, n + 1):
            run = np.zeros(rows)
            for b in range(1, n + 1):
                run = DECAY * run + same[a - 1][b - 1] * (DECAY ** 2) * inner[a - 1, b - 1]
                nxt[a, b] = DECAY * nxt[a - 1, b] + run
        inner = nxt
    total = np.zeros(rows)
    for a in range(n):
        for b in range(n):
            total += same[a][b] * (DECAY ** 2) * inner[a, b]
    return total


class Triples:
    """Characters and triples of the landmarks, numbered; every other triple has number 0."""

    def __init__(self, landmarks: list[str]):
        self.chars = {c: i + 1 for i, c in enumerate(sorted(set("".join(landmarks))))}
        self.size = len(self.chars) + 1
        self.codes = np.zeros(max(map(ord, self.chars), default=0) + 2, np.int64)
        for c, i in self.chars.items():
            self.codes[ord(c)] = i
        found = [self.of(_points([t], len(t)))[0] for t in landmarks]
        self.keys = np.unique(np.concatenate([np.zeros(1, np.int64), *found]))      # the first, 0, is no triple
        self.count = len(self.keys)
        self.table = None
        if self.size <= TABLE_LETTERS:
            self.table = np.zeros(self.size ** 3, np.int32)
            self.table[self.keys] = np.arange(self.count)

    def number(self, codes: np.ndarray) -> np.ndarray:
        """The number of each triple; memory doesn't grow with the alphabet."""
        if self.table is not None:
            return self.table[codes]
        at = np.minimum(np.searchsorted(self.keys, codes), self.count - 1)
        return np.where(self.keys[at] == codes, at, 0)

    def of(self, points: np.ndarray) -> np.ndarray:
        """Triples of strings of one length, as numbers below size ** 3 (0 in a place: no landmark has the character)."""
        code = self.codes[np.minimum(points, len(self.codes) - 1)]
        i, j, k, _ = _triples(points.shape[1])
        out = (code[:, i] * self.size + code[:, j]) * self.size + code[:, k]
        return np.where((code[:, i] > 0) & (code[:, j] > 0) & (code[:, k] > 0), out, 0)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, list[str], int]]:
    lens = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(lens).tolist():
        at = np.flatnonzero(lens == n)
        for lo in range(0, at.size, 4000):
            part = at[lo:lo + 4000]
            yield part, [words[i] for i in part], n


def kernels(words: list[str], landmarks: list[str], triples: Triples) -> np.ndarray:
    """Normalised kernels of words (of three characters at least; shorter: 0) and landmarks."""
    weights = np.zeros((triples.count, len(landmarks)), np.float32)
    for m, t in enumerate(landmarks):
        points = _points([t], len(t))
        np.add.at(weights[:, m], triples.number(triples.of(points)[0]), _triples(len(t))[3])
        weights[0, m] = 0.0
        weights[:, m] /= np.sqrt(own_kernel(points)[0])
    out = np.zeros((len(words), len(landmarks)))
    for at, part, n in _by_length(words):
        if n < 3:
            continue
        step = max(8, 20_000 // max(1, len(_triples(n)[3])))
        for lo in range(0, len(part), step):
            points = _points(part[lo:lo + step], n)
            found = triples.number(triples.of(points))
            row, place = np.nonzero(found)      # most triples are no landmark's
            if row.size:
                each = weights[found[row, place]] * _triples(n)[3][place].astype(np.float32)[:, None]
                first = np.flatnonzero(np.diff(row, prepend=-1))
                got = row[first]
                out[at[lo + got]] = np.add.reduceat(each, first) / np.sqrt(own_kernel(points[got]))[:, None]
    return out


# ---- the model --------------------------------------------------------------------------------------------------

def units_of(word: str) -> list[str]:
    """The strings that a word (between white space, lower case) is read as."""
    word = BEGIN + word.strip(EDGES) + END
    if len(word) <= WINDOW:
        return [word]
    return [word[i:i + WINDOW] for i in range(0, len(word) - WINDOW // 2, WINDOW // 2)]


def words_of(text: str) -> list[str]:
    """Lower-case words between white space, and runs of single characters as a word each."""
    text = text.lower()
    words = text.split()
    if spelled := SPELLED.findall(text):
        words += ["".join(x.split()) for x in spelled]
    return words


class Model:
    """A weight for each triple of characters, the machine's offset, and the sigmoid over a text's evidence."""

    def __init__(self, triples: Triples, weights: np.ndarray, offset: float):
        self.triples, self.offset = triples, offset
        self.sigmoid = np.array([1.0, 0.0, 0.0, 0.0])
        self.weights = weights.astype(np.float32)
        # One look-up where the triples have a table.
        self.table = None if triples.table is None else self.weights[triples.table]
        self.cache: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"cache": {}}

    def decide(self, words: list[str]) -> np.ndarray:
        """Decision values of strings up to the window's length."""
        out = np.full(len(words), self.offset)
        for at, part, n in _by_length(words):
            if n >= 3:
                points = _points(part, n)
                codes = self.triples.of(points)
                each = self.table[codes] if self.table is not None else self.weights[self.triples.number(codes)]
                raw = each @ _triples(n)[3].astype(np.float32)
                hot = np.flatnonzero(raw)
                if hot.size:
                    out[at[hot]] += raw[hot] / np.sqrt(own_kernel(points[hot]))
        return out

    def learn(self, words: set[str]) -> None:
        """Decision values of words into the cache."""
        units = [(w, u) for w in words for u in units_of(w)]
        values = self.decide([u for _, u in units])
        for w in words:
            self.cache[w] = -np.inf
        for (w, _), v in zip(units, values.tolist()):
            if v > self.cache[w]:
                self.cache[w] = v

    def evidence(self, texts: list[str]) -> tuple[np.ndarray, list[str | None]]:
        """Per text its highest decision value (up to the margin), log numbers of words and different words on the
        toxic side, 1; and the word with the highest value."""
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        every = [words_of(t) for t in texts]
        missing = set().union(*every) - self.cache.keys()
        if missing:
            self.learn(missing)
        get = self.cache.__getitem__
        out, worst = np.ones((len(texts), 4)), []
        for row, words in zip(out, every):
            values = list(map(get, words))
            top = max(values, default=self.offset)
            hits = [w for w, v in zip(words, values) if v > HIT] if top > HIT else []
            row[:3] = min(max(top, self.offset, -1.0), 1.0), np.log1p(len(hits)), np.log1p(len(set(hits)))
            worst.append(words[values.index(top)] if words else None)
        return out, worst

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(evidence @ self.sigmoid, -30, 30)))


def _squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float) -> np.ndarray:
    """Linear machine (last weight: offset, not penalised) by Newton steps on the active rows."""
    x = x.astype(np.float64)
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-9
    for _ in range(30):
        on = y * (x @ w) < 1
        xa, wa = x[on], weight[on]
        new = np.linalg.solve((xa * wa[:, None]).T @ xa + np.diag(ridge), (xa * wa[:, None]).T @ y[on])
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w


def _landmarks(words: list[str], n: int) -> list[str]:
    """Up to n words, each the one that those before span least (pivoted Cholesky of the kernel)."""
    words = words[:3 * n]
    if not words:
        return []
    k = kernels(words, words, Triples(words))
    left, rows, chosen = np.ones(len(words)), np.zeros((0, len(words))), []
    for _ in range(min(n, len(words))):
        i = int(np.argmax(left))
        if left[i] < 1e-6:
            break
        row = (k[i] - rows.T @ rows[:, i]) / np.sqrt(left[i])
        rows, left = np.vstack([rows, row]), np.maximum(left - row ** 2, 0)
        chosen.append(words[i])
    return chosen


def disguised(word: str) -> list[str]:
    """A word with one character put in, at each inner place, and with a point between all its letters."""
    inner = word[1:-1] if word.startswith(BEGIN) else word
    fill = ".x*-"
    out = [inner[:i] + fill[i % len(fill)] + inner[i:] for i in range(1, len(inner))] + [".".join(inner)]
    return [BEGIN + u + END for u in out if len(u) + 2 <= WINDOW]


class Training:
    """Labelled sentences (lists of words) and the machine fitted on them."""

    def __init__(self, toxic: list[list[str]], clean: list[list[str]], typical: dict[str, float], fit: Fit):
        """``typical``: the words that begin the choice of units, by weight."""
        unit = lambda words: [u for w in words for u in units_of(w) if len(u) > 3]
        self.fit, self.typical = fit, {u: n for w, n in typical.items() for u in units_of(w)}
        self.pos, self.neg = [s for s in map(unit, toxic) if s], [s for s in map(unit, clean) if s]
        self.hard: list[str] = []
        self.order = sorted(self.typical, key=lambda u: (-self.typical[u], u))
        self.disguised = sorted({v for u in self.order[:fit.disguised_words] for v in disguised(u)})
        self.usable = bool(self.pos and self.neg and self.order)
        if self.usable:
            self.choose_landmarks()

    def choose_landmarks(self) -> None:
        """Half of them typical words, a third hard clean words (once there are any), the others common clean words."""
        n, common = self.fit.landmarks, {}
        for u in (u for s in self.neg for u in s):
            common[u] = common.get(u, 0) + 1
        marks = _landmarks(self.order, n // 2)
        marks += _landmarks(self.hard, n // 3)
        marks += _landmarks(sorted(common, key=lambda u: (-common[u], u)), n - len(marks))
        self.marks = list(dict.fromkeys(marks))
        self.triples = Triples(self.marks)
        values, vectors = np.linalg.eigh(kernels(self.marks, self.marks, self.triples))
        good = values > 1e-6
        self.root = vectors[:, good] / np.sqrt(values[good])
        self.words = sorted({u for s in (*self.pos, *self.neg) for u in s} | set(self.hard) | set(self.order)
                            | set(self.disguised))
        self.features = self._features(self.words)

    def _features(self, words: list[str]) -> np.ndarray:
        out = np.ones((len(words), self.root.shape[1] + 1), np.float32)
        for lo in range(0, len(words), 8192):
            out[lo:lo + 8192, :-1] = kernels(words[lo:lo + 8192], self.marks, self.triples) @ self.root
        return out

    def add_hard(self, words: list[str]) -> None:
        """Clean words that the machine scores highest, highest first."""
        held = set(self.hard)
        self.hard += [u for u in dict.fromkeys(u for w in words for u in units_of(w)) if len(u) > 3 and u not in held]
        known = set(self.words)
        new = [u for u in self.hard if u not in known]
        if new:
            self.words, self.features = self.words + new, np.vstack([self.features, self._features(new)])

    def model(self) -> Model:
        number = {u: i for i, u in enumerate(self.words)}
        ids = lambda units: np.array([number[u] for u in units], np.int64)
        bags = [ids(s) for s in (*self.pos, *self.neg)]
        # A sentence stands for its highest unit; the units of clean sentences are negative, all of them.
        sets = [(np.unique(np.concatenate(bags[len(self.pos):])), -1.0, 1.0), (ids(self.hard), -1.0, 1.0), (ids(self.order), 1.0, 1.0),
                (ids(self.disguised), 1.0, 0.5)]
        y = np.concatenate([np.ones(len(self.pos)), -np.ones(len(self.neg)), *(np.full(x.size, c) for x, c, _ in sets)])
        weight = np.concatenate([np.full(len(self.pos), 1 / len(self.pos)), np.full(len(self.neg), 0.5 / len(self.neg)),
                                 *(np.full(x.size, v / max(1, x.size)) for x, _, v in sets), [1.0]])
        # The empty string, and with it all that shares nothing with a landmark, is clean.
        y, empty = np.append(y, -1.0), np.append(np.zeros(self.features.shape[1] - 1), 1.0)[None, :]
        score = np.array([self.typical.get(u, 0.0) for u in self.words])
        for _ in range(self.fit.rounds):
            chosen = np.array([b[int(np.argmax(score[b]))] for b in bags])
            rows = np.vstack([self.features[np.concatenate([chosen, *(x for x, _, _ in sets)])], empty])
            w = _squared_hinge(rows, y, weight, self.fit.penalty)
            score = self.features @ w
        beta = self.root @ w[:-1]
        table_of = np.zeros(self.triples.count)
        for m, t in enumerate(self.marks):
            points = _points([t], len(t))
            np.add.at(table_of, self.triples.number(self.triples.of(points)[0]),
                      _triples(len(t))[3] * beta[m] / np.sqrt(own_kernel(points)[0]))
        table_of[0] = 0.0
        return Model(self.triples, table_of, float(w[-1]))


def fit_sigmoid(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of the sigmoid (Platt's smoothed goals, a small ridge, Newton steps with halving)."""
    n1, n0 = (weight * y).sum(), (weight * (1 - y)).sum()
    goal = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    ridge = np.array([1e-2] * (x.shape[1] - 1) + [1e-6])
    w = np.zeros(x.shape[1])

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((weight * (np.logaddexp(0, z) - goal * z)).sum() + 0.5 * (ridge * w * w).sum())

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - goal)) + ridge * w
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + np.diag(ridge)
        step, t, now = np.linalg.solve(hess, grad), 1.0, loss(w)
        while loss(w - t * step) > now and t > 1e-6:
            t /= 2
        w = w - t * step
        if np.abs(t * step).max() < 1e-7:
            break
    return w


# ---- in Spark ---------------------------------------------------------------------------------------------------

def _sentence_rows(n_words: int):
    """(doc, toxic, half, text) to one row per sentence: its words; long ones in pieces."""
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, toxic, half, out = [], [], [], []
            for d, t, h, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                for s in re.split(r"(?<=[.!?])\s+|\n", text):
                    words = words_of(s)
                    for i in range(0, len(words), n_words):
                        doc.append(d)
                        toxic.append(t)
                        half.append(h)
                        out.append(words[i:i + n_words])
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(toxic, pa.int32()), pa.array(half, pa.int32()),
                 pa.array(out, pa.list_(pa.string()))], ["doc", "toxic", "half", "words"])
    return cut


def sample_of(docs: DataFrame, labels: DataFrame, fit: Fit, id_col: str, text_col: str, label_col: str) -> tuple[DataFrame, float]:
    """The bounded training sample (doc, toxic, half, text), none of it held out, and the labels' share of toxic rows."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).where(~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("_id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("toxic"))
    count = {row.toxic: row["count"] for row in known.groupBy("toxic").count().collect()}
    share = count.get(1, 0) / max(1, sum(count.values()))
    drawn = [hash_sample(known.where(F.col("toxic") == c), F.col("_id"), n, count.get(c, 0))
             for c, n in ((1, fit.toxic_docs), (0, fit.clean_docs))]
    picked = drawn[0].unionByName(drawn[1])
    rows = docs.select(F.col(id_col).alias("_id"), text_or_empty(F.col(text_col)).alias("text"))
    rows = rows.join(F.broadcast(picked), "_id")
    return rows.select(F.xxhash64("_id").alias("doc"), "toxic", F.pmod(F.xxhash64("_id", F.lit(11)), F.lit(2)).cast("int").alias("half"),
                       "text"), float(share)


def typical_words(sentences: DataFrame, fit: Fit) -> dict[str, float]:
    """Words typical of toxic documents, weighted by their number of different neighbours there.

    Neighbours are counted, not documents, so that the words of one text copied many times don't qualify.
    """
    word = F.explode(F.arrays_zip("words", F.concat(F.array(F.lit("")), "words").alias("before"))).alias("x")
    rows = sentences.select("doc", "toxic", word).select("doc", "toxic", F.trim(F.col("x.words"), F.lit(EDGES)).alias("word"),
                                                         F.col("x.before").alias("before"))
    rows = rows.where(F.length("word").between(3, WINDOW))
    near = rows.where("toxic = 1").select("word", "before").distinct().groupBy("word").agg(F.count(F.lit(1)).alias("near"))
    seen = rows.select("doc", "toxic", "word").distinct().groupBy("word").agg(
        F.sum("toxic").alias("in_toxic"), F.sum(1 - F.col("toxic")).alias("in_clean"))
    total = {r.toxic: r.n for r in sentences.groupBy("toxic").agg(F.countDistinct("doc").alias("n")).collect()}
    lift = ((F.col("in_toxic") + 0.5) / (total.get(1, 0) + 1)) / ((F.col("in_clean") + 0.5) / (total.get(0, 0) + 1))
    top = seen.join(near.where(F.col("near") >= fit.min_neighbours), "word").where(lift >= fit.min_lift)
    top = top.orderBy(F.desc("near"), "word").limit(fit.typical_words)
    return {r.word: float(r.near) for r in top.collect()}


def fit_model(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), id_col: str = "doc_id", text_col: str = "text",
              label_col: str = "toxic") -> tuple[Model | None, float]:
    """The fitted model (None without usable labels) and the labels' share of toxic rows."""
    scratch = Scratch(docs.sparkSession, "toxicity")
    sample, share = sample_of(docs, labels, fit, id_col, text_col, label_col)
    sample = scratch.keep(sample, "sample")
    sentences = scratch.keep(sample.mapInArrow(_sentence_rows(fit.sentence_words),
                                               "doc long, toxic int, half int, words array<string>"), "sentences")
    first = sentences.where("half = 0")
    typical = typical_words(first, fit)
    clear = F.transform("words", lambda w: F.trim(w, F.lit(EDGES)))
    names = F.array(*(F.lit(w) for w in typical)).cast("array<string>")
    order = F.xxhash64("doc", F.concat_ws(" ", "words"))
    toxic = [r.words for r in first.where("toxic = 1").where(F.arrays_overlap(clear, names)).orderBy(order)
             .limit(fit.toxic_sentences).select("words").collect()] if typical else []
    clean = [r.words for r in first.where("toxic = 0").orderBy(order).limit(fit.clean_sentences).select("words").collect()]
    training = Training(toxic, clean, typical, fit)
    model = training.model() if training.usable else None
    if model is not None:
        words = scratch.keep(first.where("toxic = 0").select(F.explode("words").alias("word")).distinct(), "clean-words")
        for i in range(fit.mining):
            hardest = words.select(F.lit(0).alias("toxic"), "word").mapInArrow(_rated(model), "word string, value double")
            training.add_hard([r.word for r in hardest.orderBy(F.desc("value"), "word").limit(fit.mined_words).collect()])
            if i == 0:
                training.choose_landmarks()
            model = training.model()
        seen = sample.where("half = 1").select("toxic", "text").mapInArrow(
            _valued(model), "toxic int, value array<double>").collect()
        y = np.array([r.toxic for r in seen], float)
        if 0 < y.sum() < y.size:
            weight = np.where(y > 0, share / y.mean(), (1 - share) / (1 - y.mean()))
            model.sigmoid = fit_sigmoid(np.array([r.value for r in seen]), y, weight)
    for df in (sample, sentences):
        scratch.drop(df)
    return model, share


def _groups(texts: list[str], most: int = 2_000_000) -> Iterator[list[str]]:
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size >= most:
            yield group
            group, size = [], 0
    if group:
        yield group


def _rated(model: Model):
    def rate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(1).to_pylist()
            model.cache.clear()
            model.learn(set(words))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([model.cache[w] for w in words], pa.float64())],
                                             ["word", "value"])
    return rate


def _valued(model: Model):
    def value(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [v for g in _groups(batch.column(1).to_pylist()) for v in model.evidence(g)[0].tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.float64()))], ["toxic", "value"])
    return value


def _scorer(model: Model, keep: list[str]):
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, worst = [], []
            for group in _groups(batch.column("_text").to_pylist()):
                found, words = model.evidence(group)
                scores.append(model.probability(found))
                worst += words
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(np.concatenate([np.empty(0), *scores])),
                 pa.array(worst, pa.string())],
                [*keep, "_score", "_worst"])
    return score


def score_documents(df: DataFrame, model: Model | None, share: float, text_col: str = "text",
                    score_as: str = "score", worst_as: str = "worst") -> DataFrame:
    """The input's columns, the score (0 to 1) and the word that it comes from."""
    keep = [f"_c{i}" for i in range(len(df.columns))]
    text = text_or_empty(F.col(keep[df.columns.index(text_col)]))
    inner = df.toDF(*keep)
    if model is None:
        out = inner.withColumn("_score", F.lit(share)).withColumn("_worst", F.lit(None).cast("string"))
    else:
        fields = [T.StructField(k, f.dataType) for k, f in zip(keep, df.schema.fields)]
        schema = T.StructType([*fields, T.StructField("_score", T.DoubleType()), T.StructField("_worst", T.StringType())])
        out = inner.withColumn("_text", text).mapInArrow(_scorer(model, keep), schema)
    return out.toDF(*df.columns, score_as, worst_as)


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    """Every document with its score; labels of held-out rows are never read."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model, share = fit_model(docs, table(spark, sf_dir, "labels"))
    out = score_documents(docs, model, share)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "worst")


QUERIES = {"op8_toxicity": op8_toxicity}
ORACLE: dict[str, str] = {}

"""Phrase collocation mining: an FM-index per shard over word ids, summed across shards.

A shard is a bounded run of one language's pieces inside a scan task. Its words get
shard-local ids and two Burrows-Wheeler transforms are built, of the id sequence and
of its reverse, sorted to the depth limit. An n-gram is a pair of synchronised
intervals: extending it by a word on the left narrows the interval of the first
transform, on the right that of the second, and the counts of the symbols inside an
interval are the counts of the extensions. All intervals of one depth are extended
together with numpy. Word ids never leave the shard, so there is no global
dictionary; n-grams leave it as text with their counts and are summed by Spark.

Depth by depth: an n-gram that occurs often enough holds only (n-1)-grams that do.
The first pass over the corpus counts words and pairs. Each further pass extends
only intervals whose parts are in a bit map of the frequent shorter n-grams (false
positives only cost rows, which the sums drop again), so the rare long n-grams, most
of a corpus, are never emitted. The bit map has 16 bits per counted frequent n-gram,
``MOST_BITS`` at most (16 MB); beyond that it fills up, prunes less and the
shuffle grows, the result stays the same.

A piece longer than a shard is cut with an overlap; n-grams inside the overlap are
subtracted again. A text is split whole: the split takes about eight bytes for each
byte of the longest text.

Defined results: null texts hold no words, a null language is ``und``; repeated rows
count each time; a corpus without phrases gives an empty table; further columns are
not read. Counts are exact, scores are whole numbers from decimal(38) arithmetic.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch, table, text_or_empty, text_slices

#: Words of a shard, over which its index is built (some 200 bytes each while it is).
SHARD_WORDS = 1 << 18
#: Bytes of text that are split at once (a longer text is split alone), and rows that leave a shard at once.
SLICE_BYTES = 1 << 20
SLICE_ROWS = 1 << 16
#: The bit map of frequent n-grams has at most so many bits.
MOST_BITS = 1 << 27
MIN_COUNT = 10
MAX_WORDS = 3
TOP = 2000
#: A candidate is dropped for a longer one with at least this share of its count, in hundredths.
COVERED_PCT = 50
#: The last ranking stage gets at most TOP rows from each of so many slices of a language.
SLICES = 32

_WORD, _BLANK, _BREAK = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# ---------------------------------------------------------------- words of a batch
def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased words of the texts in order, and which of them begin a piece."""
    texts = texts.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    if not len(texts) or ends[0] == ends[-1]:
        return pa.array([], pa.large_string()), np.empty(0, bool)
    raw = np.frombuffer(texts.buffers()[2], np.uint8, int(ends[-1] - ends[0]), int(ends[0]))
    kind = _KIND[raw]
    inside = kind == _WORD
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = ends[:-1] - ends[0]
    edges = edges[edges < len(raw)]
    begins[edges] |= inside[edges]                                  # a text's first word doesn't continue the last text's
    begins = np.flatnonzero(begins)
    packed = np.cumsum(inside)[begins] - 1                          # where each word begins among the words' bytes
    data = _LOWER[raw[inside]]
    words = pa.LargeStringArray.from_buffers(
        len(begins), pa.py_buffer(np.append(packed, len(data)).astype(np.int64)), pa.py_buffer(data))
    # The piece of a word: breaks and texts' beginnings up to it.
    stops = np.sort(np.concatenate([np.flatnonzero(kind == _BREAK), edges]))
    piece = np.searchsorted(stops, begins, side="right")
    first = np.ones(len(begins), bool)
    first[1:] = piece[1:] != piece[:-1]
    return words, first


# ---------------------------------------------------------------- the index
class Intervals:
    """n-grams of one length: their words, interval in either transform, and size."""

    def __init__(self, words: list[np.ndarray], lo: np.ndarray, lo_reversed: np.ndarray, size: np.ndarray):
        self.words, self.lo, self.lo_reversed, self.size = words, lo, lo_reversed, size

    def where(self, keep: np.ndarray) -> Intervals:
        return Intervals([w[keep] for w in self.words], self.lo[keep], self.lo_reversed[keep], self.size[keep])


class Transform:
    """Burrows-Wheeler transform of a sequence whose suffixes are sorted by their first ``depth`` symbols."""

    def __init__(self, seq: np.ndarray, sigma: int, depth: int, first: np.ndarray):
        key, top = seq.copy(), sigma
        for d in range(1, depth):
            if top * sigma >= 1 << 62:
                _, key = np.unique(key, return_inverse=True)
                top = len(seq)
            key = key * sigma
            key[:-d] += seq[d:]
            top *= sigma
        self.n, self.sigma, self.first = len(seq), sigma, first
        self.before = seq[np.argsort(key) - 1]
        self._places = None

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often the symbol stands before the row."""
        if self._places is None:                                    # rows of each symbol, ascending
            self._places = np.sort(self.before * self.n + np.arange(self.n))
        return np.searchsorted(self._places, symbol * self.n + row) - self.first[symbol]

    def extensions(self, lo: np.ndarray, size: np.ndarray):
        """(interval, symbol, count, symbols in the interval that are smaller) of every extension by a word."""
        shift = np.cumsum(size) - size
        owner = np.repeat(np.arange(len(lo)), size)
        key = owner * self.sigma + self.before[np.arange(len(owner)) + (lo - shift)[owner]]
        key.sort()
        at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
        count = np.diff(np.append(at, len(key)))
        owner, symbol = np.divmod(key[at], self.sigma)
        smaller = at - shift[owner]
        word = symbol > 0
        return owner[word], symbol[word], count[word], smaller[word]


class Index:
    """Both transforms of a shard; symbol 0 stands between pieces."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray, n_words: int, depth: int):
        at = np.arange(len(codes)) + np.cumsum(starts)              # each piece behind a 0
        seq = np.zeros(len(codes) + int(starts.sum()) + 1, np.int64)
        seq[at] = codes + 1
        self.seq, self.sigma, self.depth = seq, n_words + 1, depth
        counts = np.bincount(seq, minlength=self.sigma)
        self.counts, self.first = counts, np.cumsum(counts) - counts
        self._left = self._right = None

    @property
    def left(self) -> Transform:
        if self._left is None:
            self._left = Transform(self.seq, self.sigma, self.depth, self.first)
        return self._left

    @property
    def right(self) -> Transform:
        if self._right is None:
            self._right = Transform(self.seq[::-1].copy(), self.sigma, self.depth, self.first)
        return self._right

    def words(self) -> Intervals:
        symbol = np.arange(1, self.sigma)
        return Intervals([symbol - 1], self.first[1:], self.first[1:], self.counts[1:])

    def extend_left(self, grams: Intervals, last: bool = False) -> Intervals:
        owner, symbol, count, smaller = self.left.extensions(grams.lo, grams.size)
        lo = count if last else self.first[symbol] + self.left.rank(symbol, grams.lo[owner])
        return Intervals([symbol - 1, *(w[owner] for w in grams.words)], lo, grams.lo_reversed[owner] + smaller, count)

    def extend_right(self, grams: Intervals, last: bool = False) -> Intervals:
        owner, symbol, count, smaller = self.right.extensions(grams.lo_reversed, grams.size)
        lo = count if last else self.first[symbol] + self.right.rank(symbol, grams.lo_reversed[owner])
        return Intervals([*(w[owner] for w in grams.words), symbol - 1], grams.lo[owner] + smaller, lo, count)


# ---------------------------------------------------------------- bit maps of frequent n-grams
def _word_hashes(words: pa.Array) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words.cast(pa.large_binary()).to_pylist()], np.uint64)


def _places(lang: str, hashes: list[np.ndarray], bits: int) -> np.ndarray:
    """The bit (below the power of two ``bits``) of each n-gram, from the hashes of its words."""
    mixed = np.full(len(hashes[0]), xxhash.xxh64_intdigest(lang.encode()), np.uint64)
    for h in hashes:
        mixed = (mixed ^ h) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(65 - bits.bit_length())).astype(np.int64)


def _bits_of(n: int, bits: int):
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, phrases = batch.column(0).to_pylist(), [p.split(" ") for p in batch.column(1).to_pylist()]
            for lang in set(langs):
                own = [p for at, p in zip(langs, phrases) if at == lang]
                place = _places(lang, [_word_hashes(pa.array([p[i] for p in own])) for i in range(n)], bits)
                yield pa.RecordBatch.from_arrays([pa.array(place >> 6), pa.array(np.int64(1) << (place & 63))], ["slot", "bit"])
    return emit


def frequent_bits(frequent: DataFrame, n: int) -> np.ndarray:
    """Bit map of the frequent n-grams, sized by their number."""
    rows = frequent.where(F.col("n") == n).select("lang", "phrase")
    bits = min(MOST_BITS, 1 << max(6, (16 * rows.count()).bit_length()))
    slots = rows.mapInArrow(_bits_of(n, bits), "slot long, bit long").groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow()
    found = np.zeros(bits >> 6, np.int64)          # at most 16 MB
    found[slots.column("slot").to_numpy()] = slots.column("bits").to_numpy()
    return found


def _in(bits: np.ndarray, lang: str, hashes: list[np.ndarray]) -> np.ndarray:
    place = _places(lang, hashes, len(bits) << 6)
    return (bits[place >> 6] >> (place & 63)) & 1 == 1


# ---------------------------------------------------------------- n-grams of a shard
def _rows(lang: str, vocabulary: pa.Array, words: list[np.ndarray], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for lo in range(0, len(counts), SLICE_ROWS):
        some = counts[lo:lo + SLICE_ROWS].astype(np.int64)
        parts = [vocabulary.take(pa.array(w[lo:lo + SLICE_ROWS])) for w in words]
        phrase = parts[0] if len(parts) == 1 else pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang]).take(pa.array(np.zeros(len(some), np.int8))), pa.array(np.full(len(some), len(words), np.int32)),
             phrase.cast(pa.string()), pa.array(some)], ["lang", "n", "phrase", "f"])


def _shard_ngrams(lang: str, words: pa.Array, first: np.ndarray, depth: int,
                  frequent: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Counts of a shard's n-grams of ``depth`` words; in the first pass (depth 2) also those of its words."""
    coded = pc.dictionary_encode(words)
    vocabulary, codes = coded.dictionary, coded.indices.to_numpy()
    index = Index(codes, first, len(vocabulary), depth)
    grams = index.words()
    if not frequent:
        yield from _rows(lang, vocabulary, grams.words, grams.size)
    hashes = _word_hashes(vocabulary) if frequent else None
    for n in range(2, depth + 1):
        # Pairs by a word on the left, longer ones by a word on the right.
        grams = (index.extend_left if n == 2 else index.extend_right)(grams, last=n == depth)
        if frequent:
            parts = grams.words if n < depth else grams.words[1:]
            grams = grams.where(_in(frequent[len(parts)], lang, [hashes[w] for w in parts]))
    yield from _rows(lang, vocabulary, grams.words, grams.size)


class _Shards:
    """Collects words per language and gives full shards out; all languages together hold one shard's words."""

    def __init__(self, depth: int, frequent: dict[int, np.ndarray]):
        self.depth, self.frequent = depth, frequent
        self.words: dict[str, list[pa.Array]] = {}
        self.first: dict[str, list[np.ndarray]] = {}
        self.held: dict[str, int] = {}

    def add(self, lang: str, words: pa.Array, first: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.words.setdefault(lang, []).append(words)
        self.first.setdefault(lang, []).append(first)
        self.held[lang] = self.held.get(lang, 0) + len(words)
        while sum(self.held.values()) >= SHARD_WORDS:
            yield from self.flush(max(self.held, key=self.held.get))

    def flush(self, lang: str) -> Iterator[pa.RecordBatch]:
        words, first = pa.concat_arrays(self.words.pop(lang)), np.concatenate(self.first.pop(lang))
        del self.held[lang]
        for lo in range(0, len(words), SHARD_WORDS):
            hi = min(len(words), lo + SHARD_WORDS)
            # Words behind the cut that n-grams from before it reach into, as far as the piece goes.
            over = hi
            while over < min(len(words), hi + self.depth - 1) and not first[over]:
                over += 1
            starts = first[lo:over].copy()
            starts[0] = True
            yield from _shard_ngrams(lang, words.slice(lo, over - lo), starts, self.depth, self.frequent)
            if not self.frequent:                                   # the words of the overlap are counted again
                for n in range(1, min(self.depth, over - hi) + 1):
                    at = np.arange(hi, over - n + 1)
                    yield from _rows(lang, words, [at + i for i in range(n)], np.full(len(at), -1))
        if not self.frequent:
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([0], pa.int32()), pa.array([""]),
                                              pa.array([len(words)], pa.int64())], ["lang", "n", "phrase", "f"])


def _ngrams(depth: int, frequent):
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = _Shards(depth, {n: b.value for n, b in frequent.items()})
        for batch in batches:
            for lang in pc.unique(batch.column(0)).to_pylist():
                for _, texts in text_slices(batch.column(1).filter(pc.equal(batch.column(0), lang)), SLICE_BYTES):
                    yield from shards.add(lang, *split_words(texts))
        for lang in list(shards.held):
            yield from shards.flush(lang)
    return emit


NGRAM = "lang string, n int, phrase string, f long"


# ---------------------------------------------------------------- Spark side
def ngram_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS,
                 min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, n, phrase, f) of all n-grams of up to ``max_words`` words that occur ``min_count`` times or more.

    The row with ``n`` 0 of a language holds the number of its words.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "phrases")
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       text_or_empty(F.col(text_col)).alias("text"))

    def counted(depth: int, frequent: dict) -> DataFrame:
        # Shards have combined their n-grams: another combine before the shuffle would find few to join and hold many.
        found = rows.mapInArrow(_ngrams(depth, frequent), NGRAM).repartition("lang", "n", "phrase")
        sums = found.groupBy("lang", "n", "phrase").agg(F.sum("f").alias("f"))
        return scratch.keep(sums.where((F.col("f") >= min_count) | (F.col("n") == 0)), f"depth-{depth}")

    out = last = counted(2, {})
    maps: dict = {}
    for depth in range(3, max_words + 1):
        maps[depth - 1] = spark.sparkContext.broadcast(frequent_bits(last, depth - 1))
        last = counted(depth, maps)
        out = out.unionByName(last)
    return out if max_words > 1 else out.where("n < 2")


def extensions(counts: DataFrame) -> DataFrame:
    """(lang, phrase, left_words, right_words): how many frequent n-grams extend a phrase by a word on either side."""
    words = F.split("phrase", " ")
    longer = counts.where("n > 1").select("lang", "n", words.alias("w"))
    part = lambda at, side: F.struct(F.array_join(F.slice("w", at, F.col("n") - 1), " ").alias("phrase"),
                                     F.lit(side).alias("side"))
    each = longer.select("lang", F.explode(F.array(part(2, "left"), part(1, "right"))).alias("p")).select("lang", "p.*")
    one = lambda side: F.sum((F.col("side") == side).cast("long"))
    return each.groupBy("lang", "phrase").agg(one("left").alias("left_words"), one("right").alias("right_words"))


def collocations(counts: DataFrame, max_words: int = MAX_WORDS, top: int | None = TOP, covered_pct: int = COVERED_PCT) -> DataFrame:
    """Ranked phrases of each language: lang, rank, phrase, a, l, r, n, score.

    ``counts`` is the result of ``ngram_counts``. A phrase's score is the least over its cuts, the first of equal ones;
    phrases that a longer candidate covers go; ``top`` None ranks all.
    """
    phrases = counts.where("n >= 1")
    cand = counts.where("n >= 2").select("lang", "n", "phrase", F.col("f").alias("a"))
    words = F.split("phrase", " ")

    # Both parts of every cut, looked up in one join.
    half = lambda k, at, size, side: F.struct(F.array_join(F.slice("w", at, size), " ").alias("part"),
                                              k.alias("k"), F.lit(side).alias("side"))
    halves = cand.select("lang", "n", "phrase", "a", words.alias("w"))
    halves = halves.withColumn("h", F.explode(F.flatten(F.transform(
        F.sequence(F.lit(1), F.col("n") - 1),
        lambda k: F.array(half(k, F.lit(1), k, "l"), half(k, k + 1, F.col("n") - k, "r"))))))
    found = halves.select("lang", "phrase", "n", "a", "h.part", "h.k", "h.side").join(
        phrases.select("lang", F.col("phrase").alias("part"), "f"), ["lang", "part"])
    of = lambda k, side: F.max(F.when((F.col("k") == k) & (F.col("side") == side), F.col("f")))
    cuts = found.groupBy("lang", "phrase", "n", "a").agg(
        *[of(k, side).alias(f"{side}{k}") for k in range(1, max_words) for side in "lr"])
    score = lambda k: F.expr(  # noqa: E731  exact: 28 digits hold counts up to 10^14, the quotient is at most 1000000
        f"cast(cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0)) as decimal(38,0)) "
        f"div cast(cast(l{k} as decimal(15,0)) * cast(r{k} as decimal(15,0)) as decimal(38,0))")
    lowest = F.array_min(F.array(*[
        F.when(F.col("n") > k, F.struct(score(k).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"),
                                        F.col(f"r{k}").alias("r"))) for k in range(1, max_words)]))
    scored = cuts.select("lang", "phrase", "n", "a", lowest.alias("cut")).select("lang", "phrase", "a", "cut.*")

    # The most frequent longer candidate around each phrase.
    around = cand.where("n > 2").select("lang", "a", "n", words.alias("w")).withColumn("s", F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("n") - 1),
        lambda size: F.transform(F.sequence(F.lit(1), F.col("n") - size + 1),
                                 lambda at: F.array_join(F.slice("w", at, size), " "))))))
    around = around.groupBy("lang", F.col("s").alias("phrase")).agg(F.max("a").alias("longer"))
    kept = scored.join(around, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < covered_pct * F.col("a")))

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    if top is not None:
        # A language's best are among the best of its slices, so no task sorts a whole language.
        slice_ = F.pmod(F.xxhash64("phrase"), F.lit(SLICES))
        kept = kept.withColumn("_slice", slice_).withColumn(
            "_r", F.row_number().over(Window.partitionBy("lang", "_slice").orderBy(*order))).where(F.col("_r") <= top)
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    totals = counts.where("n = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_phrases(spark, sf_dir: str) -> DataFrame:
    """Each language's first 2000 collocations of two and three words over all documents."""
    return collocations(ngram_counts(table(spark, sf_dir, "documents")))


ORACLE_SQL = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k))),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
cuts AS (SELECT c.lang, c.k, c.phrase, c.a, cut, l.f AS l, r.f AS r,
    CAST((1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut + 1:c.k], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
kept AS (SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM cand c
    WHERE c.lang = b.lang AND c.k = 3 AND b.k = 2 AND 100 * c.a >= 50 * b.a
      AND b.phrase IN (c.w[1] || ' ' || c.w[2], c.w[2] || ' ' || c.w[3])))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""

QUERIES = {"op12_phrases": op12_phrases}
ORACLE = {"op12_phrases": ORACLE_SQL}

"""Benchmark decontamination by template windows.

Texts are canonicalised word by word: numbers (digits or number words) become
``<NUM>``, units after a number ``<UNIT>``, capitalised words inside a sentence
``<NAME>``; other words are lower case without punctuation at the ends.
Whether a word is a name can't be told from its capital alone: an item's
windows are given for each choice of their capitalised words as names, a
document's as read usually, with capitals at sentences' beginnings as names,
and with no names at all (copies in other letter case). A
template window is a run of five canonical words (an item with fewer is one
window; documents give their sentences and lines of fewer words for these,
which must equal the item word by word). The words that placeholders stand for are the window's slots.

1. Benchmark items give their windows (hash, item, place, slots).
2. Documents are canonicalised in tasks. A window leaves the task only if a
   bit map of the benchmark's window hashes has it (32 bits for each, 4 MB at least and 64 MB at
   most), so what is shuffled follows the matches, not the corpus.
3. A document with a share of at least ``THRESHOLD`` of an item's windows has one of any so many places of the item
   that too few others are left. These are the item's places whose windows are rarest in the corpus: only they
   are joined by hash to find pairs of document and item. The other windows, phrases that many items and documents
   share among them, are looked up for the pairs found. Per pair the different places of
   the item that the document has are counted; pairs with the share go on.
4. Slot check: in the best run of the document, each value of the item's slots
   must stand for one value of the document's slots of the same type, and for
   names vice versa. Equal values: an exact copy; others: a re-parameterised one. Pairs
   that fail are coincidences of form and left out.

Defined results: null texts are empty; empty texts and items match nothing;
null ids are kept as null; rows that repeat id and text are one document;
empty tables give an empty table; further columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import Scratch, table, text_or_empty

WORDS = 5
THRESHOLD = 0.8
#: The map of benchmark windows has 2 to the power of so many bits at least and at most, 32 for each window between.
MAP_BITS, MOST_MAP_BITS = 25, 29
CACHE_WORDS = 150_000

NUMBER_WORDS = frozenset("two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
                         "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred "
                         "thousand million billion dozen".split())
UNITS = frozenset("mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t ton tons tonne tonnes lb lbs "
                  "oz ounce ounces pound pounds ml cl l liter liters litre litres gallon gallons s sec second seconds min "
                  "minute minutes h hr hour hours day days week weeks month months year years % percent ° degree degrees c f "
                  "k w kw kwh mw v a hz khz mhz ghz b kb mb gb tb $ € £ usd eur gbp cent cents dollar dollars euro euros "
                  "mph kmh km/h m/s j kj cal kcal pa bar".split())
SPECIAL = NUMBER_WORDS | UNITS
NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(.*)", re.S)
EDGES = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in "$%<>") + "«»„“”‚‘’…–—¡¿·"
#: Stands for a line end among the words.
LINE = "\ue000"
WORD, NUM, UNIT, NAME, BREAK = range(5)
TYPES = {NUM: "num", UNIT: "unit", NAME: "name"}
#: Different names stay different; different numbers and units can get the same new value.
ONE_TO_ONE = frozenset(["name"])
#: The last slot of a document's window that is a short sentence of a longer text.
SAME = "-1|same|"

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "replace"))


_TYPE_HASH = np.array([0, *(_hash(f"<{x}>") for x in ("NUM", "UNIT", "NAME")), 0], np.uint64)


class Canonical(dict):
    """Canonical words of texts: the number of each different word, and per number what the word is by itself.

    Words are looked at once (``__missing__``); at more than CACHE_WORDS different ones the numbers begin anew.
    """

    def __init__(self):
        super().__init__()
        # New words: hash, kind, may be a unit, ends a sentence, value (of those that can be a slot's, all capitals among them).
        self.rows: list[tuple[int, int, bool, bool, str]] = []
        self.values: dict[int, str] = {}                          # of words that can be a slot's
        self.arrays = tuple(np.empty(0, t) for t in (np.uint64, np.int8, bool, bool))

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        if word.isalpha() and word != LINE and (lower := word.lower()) not in SPECIAL:
            # Most words: letters only. The value is kept where it can be a slot's.
            name = lower != word and not word.isupper() and word[0].isupper()
            value = lower if name or len(word) > 1 and word.isupper() else ""
            self.rows.append((xxhash.xxh64_intdigest(lower.encode()), NAME if name else WORD, False, False, value))
        else:
            self.rows.append(self._row(word))
        return n

    def _row(self, word: str) -> tuple[int, int, bool, bool, str]:
        if word == LINE:
            return 0, BREAK, False, True, ""
        ends = word[-1] in ".!?:" or word.rstrip("\"')]”’")[-1:] in (".", "!", "?")
        core = word.strip(EDGES)
        lower = core.lower()
        if not core:
            return 0, BREAK, False, ends, ""
        if (m := NUMBER.fullmatch(lower)) and (not m[1] or m[1] in UNITS) or lower in NUMBER_WORDS:
            return _hash(lower), NUM, False, ends, lower
        kind = NAME if core[0].isupper() and not core.isupper() else WORD
        return _hash(lower), kind, lower in UNITS, ends, lower if kind == NAME or lower in UNITS or len(core) > 1 and core.isupper() else ""

    def words(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """Per canonical word: text number, hash of the word itself, kind, kind where a capital at a sentence's beginning
        counts as a name's too, number of its value, whether it begins a sentence."""
        if len(self) > CACHE_WORDS:
            self.clear()
            self.__init__()
        split = [t.replace("\n", f" {LINE} ").split() for t in texts]
        n = np.fromiter(map(len, split), np.int64, len(split))
        ids = np.fromiter(map(self.__getitem__, chain.from_iterable(split)), np.int64, int(n.sum()))
        if self.rows:
            first, cols = len(self.arrays[0]), list(zip(*self.rows))
            self.arrays = tuple(np.concatenate([old, np.array(c, old.dtype)]) for old, c in zip(self.arrays, cols))
            self.values |= {first + i: v for i, v in enumerate(cols[4]) if v}
            self.rows.clear()
        doc = np.repeat(np.arange(len(texts)), n)
        hashes, kinds, units, ends = (a[ids] for a in self.arrays)
        first = np.concatenate([[True], (doc[1:] != doc[:-1]) | ends[:-1]])[:len(ids)]
        keep = kinds != BREAK
        # A word after a sentence's end, or after marks alone there, begins a sentence.
        doc, hashes, kinds, units, ids = doc[keep], hashes[keep], kinds[keep].copy(), units[keep], ids[keep]
        begins = np.zeros(len(keep) + 1, np.int64)
        begins[1:] = np.cumsum(first)
        at = np.flatnonzero(keep)
        begin = np.diff(begins[at + 1], prepend=0) > 0
        after = np.concatenate([[False], (kinds[:-1] == NUM) & (doc[1:] == doc[:-1])])[:len(kinds)]
        kinds[units & after] = UNIT
        wide = kinds.copy()
        kinds[(kinds == NAME) & begin] = WORD
        return doc, hashes, kinds, wide, ids, begin

    def value(self, i: int) -> str:
        return self.values.get(i, "")


#: A worker's words, kept from task to task.
_WORDS = Canonical()


def windows(doc: np.ndarray, compared: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of each window (a text with fewer words: one window of all)."""
    with np.errstate(over="ignore"):
        size = max(0, len(compared) - words + 1)
        rolled = np.zeros(size, np.uint64)
        for j in range(words):
            rolled = rolled * _BASE + compared[j:size + j]
        whole = np.flatnonzero(doc[:size] == doc[words - 1:]) if size else np.empty(0, np.int64)
        hashes, at = _mix(rolled[whole]), whole
        starts = np.flatnonzero(np.diff(doc, prepend=-1))
        lengths = np.diff(np.append(starts, len(doc)))
        short = np.flatnonzero(lengths < words)
        if short.size:
            extra = np.zeros(short.size, np.uint64)
            for j in range(words - 1):
                on = lengths[short] > j
                extra[on] = extra[on] * _BASE + compared[starts[short[on]] + j]
            hashes = np.concatenate([hashes, _mix(extra + lengths[short].astype(np.uint64) * _GOLD)])
            at = np.concatenate([at, starts[short]])
            order = np.argsort(at, kind="stable")
            hashes, at = hashes[order], at[order]
    return hashes, at


def compared(hashes: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """What words are compared by: their type, or the word itself."""
    return np.where(kinds == WORD, hashes, _TYPE_HASH[kinds])


def _slot_text(canonical: Canonical, kinds: np.ndarray, usual: np.ndarray, ids: np.ndarray, lo: int, hi: int) -> list[str]:
    """Slots of a window: place in it, type and value. A name that is none by the usual reading is ``wide``."""
    return [f"{j - lo}|{'wide' if k == NAME != usual[j] else TYPES[k]}|{canonical.value(int(ids[j]))}"
            for j in range(lo, hi) if (k := int(kinds[j])) != WORD]


def readings(doc: np.ndarray, hashes: np.ndarray, kinds: np.ndarray, wide: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Kinds, and hash and first word of each window, by the ways to read a document's words: as usual; where it differs, with
    names at sentences' beginnings; where the usual one has names, without any."""
    yield kinds, *windows(doc, compared(hashes, kinds))
    plain = np.where(kinds == NAME, WORD, kinds)
    for other, differs in ((wide, wide != kinds), (plain, plain != kinds)):
        if differs.any():
            values, at = windows(doc, compared(hashes, other))
            count = np.concatenate([[0], np.cumsum(differs), np.full(WORDS, differs.sum())])
            end = np.searchsorted(doc, doc[at], side="right")
            some = count[np.minimum(at + WORDS, end)] > count[at]
            yield other, values[some], at[some]


def short_windows(doc: np.ndarray, words: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first word and number of words of the sentences (or runs of them) of fewer than WORDS words in longer texts."""
    edge = np.append(begin, True)
    edge[:-1] |= np.diff(doc, prepend=-1) != 0
    whole = np.bincount(doc, minlength=1)
    out = []
    with np.errstate(over="ignore"):
        for n in range(1, min(WORDS, len(doc) + 1)):
            at = np.flatnonzero(edge[:len(doc) - n + 1] & edge[n:])
            at = at[(doc[at] == doc[at + n - 1]) & (whole[doc[at]] > n)]
            value = np.zeros(len(at), np.uint64)
            for j in range(n):
                value = value * _BASE + words[at + j]
            out.append((_mix(value + np.uint64(n) * _GOLD), at, np.full(len(at), n)))
    if not out:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))


def variants(canonical: Canonical, doc: np.ndarray, hashes: np.ndarray, kinds: np.ndarray, wide: np.ndarray,
             ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
    """Hash, first word and slots of items' windows, once for each choice of their capitalised words as names (at most 2 ** WORDS
    a window). A word that isn't a name in a choice gives a slot ``lit`` (``wide_lit`` if it is none by the usual reading)."""
    _, at = windows(doc, hashes)
    size = np.minimum(np.searchsorted(doc, doc[at], side="right") - at, WORDS)
    may = np.array([k == NAME or k == WORD and bool(canonical.value(i)) for k, i in zip(wide.tolist(), ids.tolist())], bool)
    plain = np.where(kinds == NAME, WORD, kinds)
    spots = [np.minimum(at + j, max(len(doc) - 1, 0)) for j in range(WORDS)]
    able = sum(((may[x] & (size > j)).astype(np.int64) << j for j, x in enumerate(spots)), np.zeros(len(at), np.int64))
    usual = sum((((kinds[x] == NAME) & (size > j)).astype(np.int64) << j for j, x in enumerate(spots)), np.zeros(len(at), np.int64))
    typed = sum((((plain[x] != WORD) & (size > j)).astype(np.int64) << j for j, x in enumerate(spots)), np.zeros(len(at), np.int64))
    out: list[tuple[int, int, list[str]]] = []
    for names in range(1 << WORDS):
        # Placeholders alone would match any run of names: only as read usually.
        n = np.flatnonzero(((able & names) == names) & (((typed | names) != (1 << size) - 1) | (usual == names)))
        value = np.zeros(len(n), np.uint64)
        with np.errstate(over="ignore"):
            for j, x in enumerate(spots):
                word = _TYPE_HASH[NAME] if names >> j & 1 else compared(hashes[x[n]], plain[x[n]])
                value = np.where(size[n] > j, value * _BASE + word, value)
            value = _mix(np.where(size[n] < WORDS, value + size[n].astype(np.uint64) * _GOLD, value))
        for i, h in zip(n.tolist(), value.tolist()):
            slots = []
            for j in range(int(size[i])):
                x = int(at[i]) + j
                if plain[x] != WORD:
                    kind = TYPES[int(plain[x])]
                elif names >> j & 1:
                    kind = "name" if kinds[x] == NAME else "wide"
                elif may[x]:
                    kind = "lit" if kinds[x] == NAME else "wide_lit"
                else:
                    continue
                slots.append(f"{j}|{kind}|{canonical.value(int(ids[x]))}")
            out.append((h, int(at[i]), slots))
    return np.array([x[0] for x in out], np.uint64), np.array([x[1] for x in out], np.int64), [x[2] for x in out]


WINDOW = "hash long, place int, slots array<string>"


def _emit(keep: list[str], bit_map: bytes | None):
    """Rows of (keep..., text) to rows per window: hash, place in its text, slots. ``bit_map``: a document's readings, only
    windows in it; without: an item's variants."""
    bits = None if bit_map is None else np.frombuffer(bit_map, np.uint8)
    power = 0 if bits is None else (len(bits) * 8).bit_length() - 1

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canonical = _WORDS
        for batch in batches:
            texts = batch.column("text").to_pylist()
            lo = 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and size < 1_000_000:
                    size += len(texts[hi])
                    hi += 1
                doc, own, kinds, wide, ids, begin = canonical.words(texts[lo:hi])
                start = np.searchsorted(doc, np.arange(hi - lo))
                end = np.searchsorted(doc, np.arange(hi - lo), side="right")
                if bits is None:
                    parts = [variants(canonical, doc, own, kinds, wide, ids)]
                else:
                    parts = []
                    plain = np.where(kinds == NAME, WORD, kinds)
                    short, first, size = short_windows(doc, compared(own, plain), begin)
                    reads = [(read, hashes, at, np.minimum(at + WORDS, end[doc[at]]), []) for read, hashes, at in readings(doc, own, kinds, wide)]
                    for read, hashes, at, stop, mark in [*reads, (plain, short, first, first + size, [SAME])]:
                        slot = hashes >> np.uint64(64 - power)
                        found = np.flatnonzero(bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8) & 1)
                        hashes, at, stop = hashes[found], at[found], stop[found]
                        slotted = np.concatenate([[0], np.cumsum(read != WORD)])
                        parts.append((hashes, at, [(_slot_text(canonical, read, kinds, ids, a, b) if n else []) + mark for a, b, n in
                                                   zip(at.tolist(), stop.tolist(), (slotted[stop] - slotted[at]).tolist())]))
                for hashes, at, slots in parts:
                    owner = doc[at]
                    rows = pa.array(owner + lo, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(c).take(rows) for c in keep), pa.array(hashes.astype(np.int64)),
                         pa.array((at - start[owner]).astype(np.int32)), pa.array(slots, pa.list_(pa.string()))],
                        [*keep, "hash", "place", "slots"])
                lo = hi
    return emit


def _bit_map(hashes: DataFrame) -> bytes:
    """The map of the windows' hashes, sized by their number: tasks name the map's bytes, Spark combines them by bitwise or.

    The driver gets at most a row for each of the map's bytes, 2 ** MOST_MAP_BITS / 8, however large the benchmark is.
    """
    power = min(MOST_MAP_BITS, max(MAP_BITS, (32 * hashes.count()).bit_length()))
    slot = f"shiftrightunsigned(hash, {64 - power})"
    set_bytes = hashes.select(F.expr(f"shiftright({slot}, 3)").alias("at"),
                              F.expr(f"shiftleft(1, cast({slot} & 7 AS int))").alias("bit"))
    out = np.zeros(1 << (power - 3), np.uint8)
    for row in set_bytes.groupBy("at").agg(F.bit_or("bit").alias("bits")).toLocalIterator():
        out[row["at"]] = row["bits"]
    return out.tobytes()


PAIR = ["id", "text_hash", "item", "item_hash"]


def candidates(found: DataFrame, item_windows: DataFrame, totals: DataFrame, threshold: float) -> DataFrame:
    """Pairs of document and item that share one of the item's rarest places.

    A pair of the threshold has all but ``total - ceil(threshold * total)`` of the item's places, so one of any more than
    these; which ones are taken changes the work only.
    """
    often = found.groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    places = item_windows.join(often.hint("merge"), "hash", "left").groupBy("item", "item_hash", "place").agg(
        F.sum(F.coalesce("n", F.lit(0))).alias("n"))
    own = F.col("p.item").eqNullSafe(F.col("t.item")) & (F.col("p.item_hash") == F.col("t.item_hash"))
    places = places.alias("p").join(totals.alias("t").hint("merge"), own).select("p.*", "t.total")
    rank = F.row_number().over(Window.partitionBy("item", "item_hash").orderBy("n", "place"))
    most = F.col("total") - F.ceil(F.lit(threshold) * F.col("total") - 1e-9) + 1
    rare = places.withColumn("rank", rank).where(F.col("rank") <= most)
    same = F.col("w.item").eqNullSafe(F.col("r.item")) & (F.col("w.item_hash") == F.col("r.item_hash")) & (F.col("w.place") == F.col("r.place"))
    keys = item_windows.alias("w").join(rare.alias("r").hint("merge"), same, "left_semi").select("hash", "item", "item_hash").distinct()
    return found.select("id", "text_hash", "hash").join(keys.hint("merge"), "hash").select(*PAIR).distinct()


def slots_agree(item: Iterable[tuple[str, str]], doc: Iterable[tuple[str, str]], back_too: frozenset[str] = frozenset(TYPES.values())) -> bool:
    """Whether paired slots (type, value) are of one type each and map each value to one value, and back for the types ``back_too``."""
    there: dict = {}
    back: dict = {}
    for a, b in zip(item, doc):
        if a[0] != b[0] or there.setdefault(a, b) != b or a[0] in back_too and back.setdefault(b, a) != a:
            return False
    return True


def best_run(pairs: list[tuple[int, int]], slack: int) -> list[int]:
    """Of (document place, item place) pairs, numbers of those in the run that has the most of the item: offsets differ
    by at most ``slack`` in it, and each place of the item counts once (at the offset most common in the run)."""
    by_offset: dict[int, list[int]] = {}
    for n, (d, i) in enumerate(pairs):
        by_offset.setdefault(d - i, []).append(n)
    offsets = sorted(by_offset)
    best: dict[int, int] = {}
    for o in offsets:
        have: dict[int, int] = {}
        near = [x for x in range(o - slack, o + slack + 1) if x in by_offset] if slack < len(offsets) else \
            [x for x in offsets if abs(x - o) <= slack]
        for x in sorted(near, key=lambda x: (-len(by_offset[x]), abs(x - o), x)):
            for n in by_offset[x]:
                have.setdefault(pairs[n][1], n)
        if len(have) > len(best):
            best = have
    return sorted(best.values())


def judge(found: list[tuple[int, int, list[str], list[str]]], total: int, threshold: float) -> tuple[int, float, int, str] | None:
    """Matched windows, their share, slots and kind from the (place, item place, slots, item slots) of a pair's windows;
    None if the best run has too few of the item's windows or its slots don't agree. Capitals at sentences' beginnings count
    as names' if the windows with such names are needed, or else are ordinary words."""
    # Values of a sentence in a longer text must be the short item's own: its form alone says too little.
    found = [w for w in found if SAME not in w[2] or w[2][:-1] == [x for x in w[3] if "lit|" not in x]]
    usual = [w for w in found if not any("|wide|" in x for x in (*w[2], *w[3]))]
    wide = [w for w in found if any("|wide|" in x for x in (*w[2], *w[3]))]
    return _judge(usual, total, threshold, False) or (_judge(usual + wide, total, threshold, True) if wide else None)


def _judge(found: list, total: int, threshold: float, wide: bool) -> tuple[int, float, int, str] | None:
    chosen = best_run([(d, i) for d, i, _, _ in found], max(1, total // 4))
    votes: dict[int, Counter] = {}
    for n in chosen:
        _, place, mine, theirs = found[n]
        there = iter(mine)
        for a in theirs:
            at, kind, value = a.split("|", 2)
            if kind == "wide_lit" and not wide:
                continue
            if kind in ("lit", "wide_lit"):     # the word itself is in the document
                other, got = "name", value
            else:
                _, other, got = next(there).split("|", 2)
            names = ("wide", "lit", "wide_lit")
            votes.setdefault(place + int(at), Counter())[
                (("name" if kind in names else kind, value), ("name" if other in names else other, got))] += 1
    slots = [min(c, key=lambda x: (-c[x], x)) for c in votes.values()]
    covered = len(chosen) / total
    if covered < threshold or not slots_agree((a for a, _ in slots), (b for _, b in slots), ONE_TO_ONE):
        return None
    return len(chosen), covered, len(slots), "exact" if all(a == b for a, b in slots) else "reparameterised"


def _judging(keep: list[str], threshold: float):
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, out = [], []
            for n, (found, total) in enumerate(zip(batch.column("found").to_pylist(), batch.column("total").to_pylist())):
                x = judge([(w["place"], w["item_place"], w["slots"], w["item_slots"]) for w in found], total, threshold)
                if x is not None:
                    which.append(n)
                    out.append(x)
            cols = list(zip(*out)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(pa.array(which, pa.int64())) for c in keep),
                 *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.float64(), pa.int64(), pa.string())))],
                [*keep, "matched", "covered", "n_slots", "kind"])
    return rows


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document and benchmark item that it has: id, hash of the document's text, item, matched windows,
    their share of the item's windows, slots, and kind (exact or reparameterised)."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    kinds = {"id": docs.schema[id_col].dataType.simpleString(), "item": benchmark.schema[item_col].dataType.simpleString()}
    items = benchmark.select(F.col(item_col).alias("item"), text_or_empty(F.col(item_text_col)).alias("text")).distinct()
    # An item's number is its id and text (ids can repeat with other texts).
    items = items.withColumn("item_hash", F.unhex(F.md5(F.col("text").cast("binary"))))
    item_windows = scratch.keep(items.mapInArrow(
        _emit(["item", "item_hash"], None), f"item {kinds['item']}, item_hash binary, {WINDOW}"), "items")
    totals = item_windows.groupBy("item", "item_hash").agg(F.countDistinct("place").alias("total"))
    bit_map = _bit_map(item_windows.select("hash").distinct())

    text = text_or_empty(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), F.unhex(F.md5(text.cast("binary"))).alias("text_hash"), text.alias("text"))
    found = scratch.keep(rows.mapInArrow(_emit(["id", "text_hash"], bit_map), f"id {kinds['id']}, text_hash binary, {WINDOW}")
                         .distinct(), "found")
    pair = PAIR
    some = scratch.keep(candidates(found, item_windows, totals, threshold), "candidates")
    theirs = item_windows.select("hash", F.col("item").alias("i"), F.col("item_hash").alias("h"), F.col("place").alias("item_place"),
                                 F.col("slots").alias("item_slots"))
    mine = found.select(F.col("id").alias("d"), F.col("text_hash").alias("t"), "hash", "place", "slots")
    matched = some.join(mine, F.col("id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t"))).drop("d", "t")
    matched = matched.withColumnRenamed("hash", "x").join(
        theirs.hint("merge"), (F.col("x") == F.col("hash")) & F.col("item").eqNullSafe(F.col("i")) & (F.col("item_hash") == F.col("h")))
    matched = scratch.keep(matched.select(*pair, "place", "slots", "item_place", "item_slots"), "matched")
    shares = matched.select(*pair, "item_place").distinct().groupBy(*pair).agg(F.count(F.lit(1)).alias("n"))
    shares = shares.join(totals.select(F.col("item").alias("i"), F.col("item_hash").alias("h"), "total"),
                         F.col("item").eqNullSafe(F.col("i")) & (F.col("item_hash") == F.col("h"))).drop("i", "h")
    likely = scratch.keep(shares.where(F.col("n") >= threshold * F.col("total")), "likely")
    same = [F.col(f"m.{c}").eqNullSafe(F.col(f"k.{c}")) for c in pair]
    both = matched.alias("m").join(likely.alias("k"), same[0] & same[1] & same[2] & same[3]).select(
        *(F.col(f"m.{c}") for c in (*pair, "place", "slots", "item_place", "item_slots")), F.col("k.total"))
    # A pair's windows are at most the document's own.
    each = F.struct("place", "item_place", "slots", "item_slots")
    judged = both.groupBy(*pair).agg(F.first("total").alias("total"), F.sort_array(F.collect_list(each)).alias("found")).mapInArrow(
        _judging(pair, threshold), f"id {kinds['id']}, text_hash binary, item {kinds['item']}, item_hash binary, matched long, "
                                   "covered double, n_slots long, kind string")
    return judged.select(F.col("id").alias(id_col), "text_hash", F.col("item").alias(item_col), "matched", "covered", "n_slots", "kind")


def op3_decontaminate(spark, sf_dir: str) -> DataFrame:
    """The documents that hold a benchmark item, with the item."""
    found = find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


QUERIES = {"op3_decontaminate": op3_decontaminate}
ORACLE: dict[str, str] = {}

"""SentencePiece encoding and decoding as shortest paths in a weighted transducer.

Compiled from a ``.model`` file (vocabulary, scores and normaliser are read
through the public library; its encoder is not used):

* the normaliser: a dummy prefix and spaces written as ``U+2581``;
* the piece transducer: a trie over the pieces' characters, closed over itself,
  so that a path spells the text and emits pieces;
* byte fallback: a character that is no piece emits its UTF-8 bytes' pieces;
* for a BPE vocabulary, the merge acceptor: a bigram automaton over pieces that
  gives weight 0 to neighbours which the merge rules leave apart and infinite
  weight to others. A segmentation is the one that merging gives exactly when
  all its neighbours are such pairs, so the composition has one finite path.
  For a unigram vocabulary the weights are the negated scores instead.

Composing with a text and taking the shortest path in the tropical semiring
goes from left to right over the positions of the text. The text is first cut
where no piece can reach across (computed from the pieces, so it loses
nothing); equal cuts are composed once per batch and kept in a bounded cache,
and the cuts of a batch are composed together, position by position, in NumPy.

Defined results: null text is empty and gives no tokens; ``U+2581`` in a text
counts as a space, as in the library; texts are whole, of any length; rows that
repeat are encoded each; an empty table gives an empty table; further columns
are kept by `encode_documents`.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.common import table, text_or_empty

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Cuts kept in a worker's cache; at more it starts anew.
CACHE_CUTS = 400_000
#: Texts are composed in groups of about so many characters.
GROUP_CHARS = 2_000_000
#: Cuts longer than this are composed one by one.
LONG_CUT = 48


class _Table:
    """Open-addressing map from int64 keys to int32 values, looked up by arrays."""

    def __init__(self, bits: int):
        self.bits, self.used = bits, 0
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values of the keys, -1 where absent."""
        mask = (1 << self.bits) - 1
        slot = self._slot(keys)
        found, out = self.keys[slot], self.values[slot]
        todo = np.flatnonzero((found != keys) & (found != -1))
        out[found == -1] = -1
        while todo.size:
            slot[todo] = (slot[todo] + 1) & mask
            found = self.keys[slot[todo]]
            hit = found == keys[todo]
            out[todo] = np.where(hit, self.values[slot[todo]], -1)
            todo = todo[~hit & (found != -1)]
        return out

    def put(self, keys: Iterable[int], values: Iterable[int]) -> None:
        pairs = list(zip(keys, values))
        if 2 * (self.used + len(pairs)) > 1 << self.bits:
            bits = self.bits
            while 2 * (self.used + len(pairs)) > 1 << bits:
                bits += 1
            held = np.flatnonzero(self.keys != -1)
            pairs = [*zip(self.keys[held].tolist(), self.values[held].tolist()), *pairs]
            self.__init__(bits)
        mask = (1 << self.bits) - 1
        slots = self._slot(np.array([k for k, _ in pairs], np.int64)).tolist() if pairs else []
        for (k, v), s in zip(pairs, slots):
            while self.keys[s] != -1:
                s = (s + 1) & mask
            self.keys[s], self.values[s] = k, v
        self.used += len(pairs)


class PieceFst:
    """The compiled transducer of one model."""

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: dict[int, int], skip: frozenset[int],
                 merges: bool = True, dummy_prefix: bool = True, unk_id: int = 0):
        """``skip``: ids that no text spells (control, unknown and byte pieces). ``merges``: a BPE vocabulary."""
        self.pieces, self.scores, self.byte_ids, self.unk_id = pieces, scores, byte_ids, unk_id
        self.merges, self.dummy_prefix = merges, dummy_prefix
        self.id_of = {p: i for i, p in enumerate(pieces) if i not in skip and p}
        self.rank = {p: scores[i] for p, i in self.id_of.items()}
        joined = {c for p in self.id_of if len(p) > 1 for c in p}
        assert all(SPACE not in p.lstrip(SPACE) for p in self.id_of), "a piece reaches over a space"
        # Characters inside longer pieces that are no piece themselves get numbers after the vocabulary.
        self.extra = sorted(c for c in joined if c not in self.id_of)
        for c in self.extra:
            self.id_of[c] = len(pieces) + 1 + self.extra.index(c)
        letters = "".join(re.escape(c) for c in sorted(joined - {SPACE}))
        self.cuts = re.compile(rf"{SPACE}*[{letters}]+|{SPACE}+|." if letters else rf"{SPACE}+|.", re.S)
        self.begin = len(pieces)
        self.width = len(pieces) + 1 + len(self.extra)
        self._compile_trie(joined | {SPACE})
        self.pairs = _Table(18)
        self.cache: dict[str, bytes] = {}
        self.bytes_of = self._piece_bytes()

    def _piece_bytes(self) -> list[bytes]:
        out = [p.encode() for p in self.pieces]
        for b, i in self.byte_ids.items():
            out[i] = bytes([b])
        return out

    def _compile_trie(self, chars: set[str]) -> None:
        self.char_of = {c: i for i, c in enumerate(sorted(chars))}
        top = max(map(ord, chars), default=0) + 1
        self.char_codes = np.full(top + 1, -1, np.int32)
        for c, i in self.char_of.items():
            self.char_codes[ord(c)] = i
        step: dict[tuple[int, int], int] = {}
        final = [-1]
        for piece, i in self.id_of.items():
            if any(c not in self.char_of for c in piece):
                continue
            node = 0
            for c in piece:
                key = (node, self.char_of[c])
                if key not in step:
                    step[key] = len(final)
                    final.append(-1)
                node = step[key]
            final[node] = i
        self.step, self.final = step, np.array(final, np.int32)
        self.n_chars = len(chars)
        self.trie = _Table(max(4, (2 * len(step)).bit_length() + 1))
        self.trie.put([n * self.n_chars + c for n, c in step], step.values())
        lengths = np.zeros(self.width, np.int32)
        for p, i in self.id_of.items():
            lengths[i] = len(p)
        self.lengths = lengths
        self.longest = int(lengths.max(initial=1))

    def merge(self, text: str, border: int = -1) -> list[str] | None:
        """The pieces that merging leaves: best score first, then leftmost. None if a merge crosses ``border``."""
        parts, at = list(text), list(range(len(text)))
        while len(parts) > 1:
            best, where = None, -1
            for i in range(len(parts) - 1):
                score = self.rank.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, where = score, i
            if where < 0:
                break
            if at[where + 1] == border:
                return None
            parts[where] += parts[where + 1]
            del parts[where + 1], at[where + 1]
        return parts

    def apart(self, a: int, b: int) -> bool:
        """The merge acceptor: whether merging leaves piece ``b`` whole after ``a`` (``begin``: at the start)."""
        if not self.merges:
            return True
        tail = self._name(b)
        if a == self.begin:
            return self.merge(tail) == [tail]
        head = self._name(a)
        return self.merge(head + tail, len(head)) == [head, tail]

    def _name(self, i: int) -> str:
        return self.pieces[i] if i < len(self.pieces) else self.extra[i - len(self.pieces) - 1]

    def _apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a.astype(np.int64) * self.width + b
        out = self.pairs.get(keys)
        new = np.unique(keys[out < 0])
        if new.size:
            made = [int(self.apart(*divmod(k, self.width))) for k in new.tolist()]
            self.pairs.put(new.tolist(), made)
            out = self.pairs.get(keys)
        return out == 1

    def _weight(self, i: int) -> float:
        return 0.0 if self.merges else -(self.scores[i] if i < len(self.scores) else min(self.scores) - 10)

    def path(self, cut: str) -> list[int]:
        """Shortest path of one cut, position by position."""
        n = len(cut)
        cost: list[float] = [0.0] + [float("inf")] * n
        last = [self.begin] + [-1] * n
        for p in range(n):
            if last[p] < 0:
                continue
            node = 0
            for q in range(p + 1, min(n, p + self.longest) + 1):
                node = self.step.get((node, self.char_of.get(cut[q - 1], -1)), -1)
                if node < 0:
                    break
                t = int(self.final[node])
                if t >= 0 and cost[p] + self._weight(t) < cost[q]:
                    key = np.array([last[p]]), np.array([t])
                    if not self.merges or self._apart(*key)[0]:
                        cost[q], last[q] = cost[p] + self._weight(t), t
        out, q = [], n
        while q:
            out.append(last[q])
            q -= int(self.lengths[last[q]])
        return out[::-1]

    def _paths(self, cuts: list[str]) -> None:
        """Shortest paths of many cuts together into the cache."""
        lens = np.fromiter(map(len, cuts), np.int32, len(cuts))
        order = np.argsort(lens, kind="stable")
        cuts, lens = [cuts[i] for i in order], lens[order]
        n, width = len(cuts), int(lens[-1])
        points = np.frombuffer("".join(cuts).encode("utf-32-le"), np.uint32)
        starts = np.concatenate([[0], np.cumsum(lens)])[:-1]
        chars = np.full((width, n), -1, np.int32)
        column = np.repeat(np.arange(n), lens)
        chars[np.arange(points.size) - np.repeat(starts, lens), column] = self.char_codes[points]
        last = np.full((width + 1, n), -1, np.int32)
        last[0] = self.begin
        cost = None if self.merges else np.full((width + 1, n), np.inf)
        if cost is not None:
            cost[0] = 0.0
            weights = np.array([self._weight(i) for i in range(self.width)])
        for p in range(width):
            first = int(np.searchsorted(lens, p, side="right"))
            idx = first + np.flatnonzero(last[p, first:] >= 0)
            node = np.zeros(idx.size, np.int64)
            for q in range(p + 1, min(width, p + self.longest) + 1):
                c = chars[q - 1, idx]
                node = np.where(c >= 0, self.trie.get(node * self.n_chars + np.maximum(c, 0)), -1)
                alive = node >= 0
                idx, node = idx[alive], node[alive].astype(np.int64)
                if not idx.size:
                    break
                t = self.final[node]
                ends = np.flatnonzero(t >= 0)
                w, t = idx[ends], t[ends]
                if self.merges:
                    ok = self._apart(last[p, w], t)
                    last[q, w[ok]] = t[ok]
                else:
                    new = cost[p, w] + weights[t]
                    ok = new < cost[q, w]
                    last[q, w[ok]], cost[q, w[ok]] = t[ok], new[ok]
        back = np.full((width, n), -1, np.int32)
        at, k = lens.astype(np.int64).copy(), width
        live = np.arange(n)
        while live.size:
            k -= 1
            t = last[at[live], live]
            back[k, live] = t
            at[live] -= self.lengths[t]
            live = live[at[live] > 0]
        flat = back.T
        mask = flat >= 0
        data, ends = flat[mask].tobytes(), (np.cumsum(mask.sum(1)) * 4).tolist()
        begin = 0
        for cut, end in zip(cuts, ends):
            self.cache[cut] = data[begin:end]
            begin = end

    def _bytes_path(self, ids: list[int]) -> bytes:
        out: list[int] = []
        for i in ids:
            out += [i] if i < len(self.pieces) else self._fallback(self._name(i))
        return np.array(out, np.int32).tobytes()

    def _fallback(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode()] if self.byte_ids else [self.unk_id]

    def learn(self, cuts: set[str]) -> None:
        """Compose cuts that aren't in the cache."""
        short = []
        for cut in cuts:
            if len(cut) == 1 and cut not in self.char_of:
                self.cache[cut] = np.array([i] if (i := self.id_of.get(cut)) is not None else self._fallback(cut),
                                           np.int32).tobytes()
            elif len(cut) > LONG_CUT or self.extra:
                self.cache[cut] = self._bytes_path(self.path(cut))
            else:
                short.append(cut)
        for i in range(0, len(short), 60_000):
            self._paths(short[i:i + 60_000])

    def normalise(self, text: str) -> str:
        text = text.replace(" ", SPACE)
        return SPACE + text if text and self.dummy_prefix else text

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.cache) > CACHE_CUTS:
            self.cache.clear()
        cut = [self.cuts.findall(self.normalise(t)) for t in texts]
        missing = set().union(*cut) - self.cache.keys()
        if missing:
            self.learn(missing)
        get = self.cache.__getitem__
        return [np.frombuffer(b"".join(map(get, c)), np.int32) for c in cut]

    def decode(self, ids: Iterable[int]) -> str:
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


_LOADED: dict[str, PieceFst] = {}


def load(model_path: str = MODEL_PATH) -> PieceFst:
    """The transducer of a model file, compiled once per worker."""
    if model_path not in _LOADED:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb
        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = sp.vocab_size()
        proto = pb.ModelProto()
        proto.ParseFromString(sp.serialized_model_proto())
        assert proto.normalizer_spec.name == "identity" and not proto.normalizer_spec.remove_extra_whitespaces
        pieces = [sp.id_to_piece(i) for i in range(n)]
        byte_ids = {int(pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        skip = frozenset(i for i in range(n) if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
        _LOADED[model_path] = PieceFst(pieces, [sp.get_score(i) for i in range(n)], byte_ids, skip,
                                       proto.trainer_spec.model_type == 2, proto.normalizer_spec.add_dummy_prefix, sp.unk_id())
    return _LOADED[model_path]


def _groups(texts: list[str]) -> Iterator[list[str]]:
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size >= GROUP_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def _encoder(model_path: str, keep: list[str]):
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = load(model_path)
        for batch in batches:
            at = 0
            for group in _groups(batch.column("_text").to_pylist()):
                ids = fst.encode_many(group)
                ok = [fst.decode(x.tolist()) == t.replace(SPACE, " ") for x, t in zip(ids, group)]
                ends = np.concatenate([[0], np.cumsum([x.size for x in ids])]).astype(np.int32)
                flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
                part = batch.slice(at, len(group))
                at += len(group)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                     pa.array(np.diff(ends).astype(np.int64)), pa.array(ok)], [*keep, "_ids", "_n", "_ok"])
    return encode


def encode_documents(df: DataFrame, text_col: str = "text", model_path: str = MODEL_PATH, ids_as: str = "token_ids",
                     count_as: str = "n_tokens", round_trip_as: str = "round_trip") -> DataFrame:
    """The input's columns and per row the piece ids, their number and whether decoding gives the text again."""
    keep = [f"_c{i}" for i in range(len(df.columns))]
    inner = df.toDF(*keep)
    at = df.columns.index(text_col)
    fields = [T.StructField(k, f.dataType) for k, f in zip(keep, df.schema.fields)]
    schema = T.StructType([*fields, T.StructField("_ids", T.ArrayType(T.IntegerType())), T.StructField("_n", T.LongType()),
                           T.StructField("_ok", T.BooleanType())])
    out = inner.withColumn("_text", text_or_empty(F.col(keep[at]))).mapInArrow(_encoder(model_path, keep), schema)
    return out.toDF(*df.columns, ids_as, count_as, round_trip_as)


def _decoder(model_path: str):
    def decode(ids: pd.Series) -> pd.Series:
        fst = load(model_path)
        return ids.map(lambda x: "" if x is None else fst.decode(x))
    return decode


def decode_ids(df: DataFrame, ids_col: str = "token_ids", text_as: str = "decoded",
               model_path: str = MODEL_PATH) -> DataFrame:
    """Piece ids back to text (null ids: empty)."""
    return df.withColumn(text_as, F.pandas_udf(_decoder(model_path), "string")(F.col(ids_col)))


def op10_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Every document as piece ids, with the outcome of decoding them."""
    return encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


QUERIES = {"op10_sentencepiece": op10_sentencepiece}
ORACLE: dict[str, str] = {}

"""Phrase mining: the index against counted n-grams, cuts of long pieces, and the query against SQL and brute force."""
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from ledgerspark.llm import phrase_mining as PM


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [p for p in (re.findall(r"[^\x20\x09]+", x) for x in re.split(r"[.,;:!?\x0A-\x0D]", low)) if p]


def counted(docs, most):
    out = Counter()
    for text, lang in docs:
        for p in pieces(text):
            out[lang or "und", 0, ""] += len(p)
            for n in range(1, most + 1):
                for i in range(len(p) - n + 1):
                    out[lang or "und", n, " ".join(p[i:i + n])] += 1
    return out


def collocations(docs, most, least, top, covered):
    f = counted(docs, most)
    cand = {k: v for k, v in f.items() if k[1] >= 2 and v >= least}
    rows = {}
    for (lang, n, phrase), a in cand.items():
        w = phrase.split(" ")
        cuts = []
        for k in range(1, n):
            left, right = f[lang, k, " ".join(w[:k])], f[lang, n - k, " ".join(w[k:])]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        if not any(la == lang and m > n and 100 * b >= covered * a and any(q.split(" ")[i:i + n] == w for i in range(m - n + 1))
                   for (la, m, q), b in cand.items()):
            rows.setdefault(lang, []).append((-score, -a, phrase.encode(), left, right))
    out = []
    for lang, found in rows.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, f[lang, 0, ""], -score))
    return sorted(out)


def random_docs(seed, n=60):
    rnd = random.Random(seed)
    words = ["new", "york", "city", "The", "A", "é", "ß", "b#", " x", "of", "🙂"]
    make = lambda k: "".join(rnd.choice(words[:rnd.randint(2, 11)]) + rnd.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ",", "\x0b"])
                             for _ in range(k))
    docs = [(make(rnd.choice([0, 1, 5, 30, 200])), rnd.choice(["en", "en", "de", None])) for _ in range(n)]
    return docs + [(None, "en"), ("", None), (" . , ", "fr"), ("Only", "fr"), docs[1], docs[1]]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("depth", [2, 3, 5])
def test_index_counts_every_ngram(seed, depth):
    docs = [d for d in random_docs(seed) if d[0]]
    words, first = PM.split_words(pa.array([t for t, _ in docs]))
    assert words.to_pylist() == [w for t, _ in docs for p in pieces(t) for w in p]
    coded = words.dictionary_encode()
    index = PM.Index(coded.indices.to_numpy(), first, len(coded.dictionary), depth)
    want = counted([(t, "x") for t, _ in docs], depth)
    grams = index.words()
    names = coded.dictionary.to_pylist()
    for n in range(1, depth + 1):
        got = {" ".join(names[w[i]] for w in grams.words): int(grams.size[i]) for i in range(len(grams.size))}
        assert got == {p: c for (_, k, p), c in want.items() if k == n}
        # left and right by turns, so both intervals have to stay in step
        grams = (index.extend_left if n % 2 else index.extend_right)(grams)


def test_split_of_sliced_arrays_and_edges():
    texts = pa.array(["x y", "", "Aé.b", "b c", " .", "last"])
    words, first = PM.split_words(texts.slice(1, 4))
    assert words.to_pylist() == ["aé", "b", "b", "c"] and first.tolist() == [True, True, True, False]
    assert len(PM.split_words(pa.array([], pa.string()))[0]) == 0 and len(PM.split_words(pa.array(["", ""]))[0]) == 0


@pytest.mark.parametrize("cut", [1, 2, 3, 7, 50, 100_000])
def test_shards_sum_to_the_whole(monkeypatch, cut):
    """Counts don't depend on where shards are cut, also inside pieces."""
    monkeypatch.setattr(PM, "SHARD_WORDS", cut)
    docs = [(t, lang or "und") for t, lang in random_docs(4, 20) if t] + [("long piece " * 150, "en")]
    sums = Counter()
    shards = PM._Shards(2, {})
    rows = [r for t, lang in docs for r in shards.add(lang, *PM.split_words(pa.array([t])))]
    rows += [r for lang in list(shards.held) for r in shards.flush(lang)]
    for r in rows:
        for lang, n, phrase, f in zip(*(c.to_pylist() for c in r.columns)):
            sums[lang, n, phrase] += f
    assert {k: v for k, v in sums.items() if v} == {k: v for k, v in counted(docs, 2).items() if v}


@pytest.mark.parametrize("most,least,covered", [(3, 3, 50), (2, 2, 50), (4, 2, 80)])
def test_query_as_by_hand(spark, most, least, covered):
    docs = random_docs(9) + [("new york city hall. " * 12, "en"), ("new york city hall", "de")]
    df = spark.createDataFrame([(t, lang, i, "x") for i, (t, lang) in enumerate(docs)], "text string, lang string, n int, phrase string")
    got = PM.collocations(PM.ngram_counts(df, max_words=most, min_count=least), max_words=most, top=15, covered_pct=covered)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == collocations(docs, most, least, 15, covered)


def test_filled_bit_map_only_costs_rows(spark, monkeypatch):
    monkeypatch.setattr(PM, "MOST_BITS", 64)
    docs = random_docs(5)
    df = spark.createDataFrame(docs, "text string, lang string")
    got = {(r.lang, r.n, r.phrase): r.f for r in PM.ngram_counts(df, min_count=4).collect()}
    assert got == {k: v for k, v in counted(docs, 3).items() if v >= 4 or (k[1] == 0 and v)}


def test_extensions(spark):
    df = spark.createDataFrame([("a b c. a b d. x b c.", "en")], "text string, lang string")
    got = {r.phrase: (r.left_words, r.right_words) for r in PM.extensions(PM.ngram_counts(df, min_count=1)).collect()}
    assert got["b"] == (2, 2) and got["a b"] == (0, 2) and got["b c"] == (2, 0) and got["a"] == (0, 1)


def test_empty_table(spark):
    df = spark.createDataFrame([], "text string, lang string")
    assert PM.collocations(PM.ngram_counts(df)).count() == 0


def test_large_counts_are_exact(spark):
    big = 30_000_000_000_001          # the product has 33 digits
    counts = spark.createDataFrame([("en", 0, "", 10 ** 14), ("en", 1, "a", big + 7), ("en", 1, "b", big + 9), ("en", 2, "a b", big)],
                                   "lang string, n int, phrase string, f long")
    row = PM.collocations(counts).first()
    assert row.score == 1_000_000 * big * big // ((big + 7) * (big + 9)) and row.n == 10 ** 14


def test_oracle_on_odd_texts(spark):
    docs = random_docs(11, 120)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    want = sorted(con.execute(PM.ORACLE_SQL).fetchall())
    got = PM.collocations(PM.ngram_counts(spark.createDataFrame(docs, "text string, lang string")))
    assert sorted(map(tuple, got.collect())) == want and len(want) > 20
    assert np.all(np.diff([r[1] for r in want if r[0] == "en"]) == 1)

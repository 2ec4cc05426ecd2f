"""The string kernel by its definition, the machine on small data, and held-out accuracy on the given tables."""

import itertools
import random

import numpy as np
import pytest

from ledgerspark.llm import toxicity as tx
from ledgerspark.llm.common import held_out


def phi(s):
    """All triples of a string with their decayed weights."""
    out = {}
    for i, j, k in itertools.combinations(range(len(s)), 3):
        u = s[i] + s[j] + s[k]
        out[u] = out.get(u, 0.0) + tx.DECAY ** (k - i + 1)
    return out


def kernel(s, t):
    a, b = phi(s), phi(t)
    return sum(v * b.get(u, 0.0) for u, v in a.items())


WORDS = ["\x02idiot\x03", "\x02idxiot\x03", "\x02aaa\x03", "abcabcabc", "ñoño", "xyz", "\x02banana\x03", "worthless", "ab", "\x02\x03"]


def test_kernels_by_definition():
    marks = ["\x02idiot\x03", "banana", "abcabc", "ñoñoa"]
    got = tx.kernels(WORDS, marks, tx.Triples(marks))
    for w, row in zip(WORDS, got):
        for t, x in zip(marks, row):
            want = kernel(w, t) / np.sqrt(kernel(w, w) * kernel(t, t)) if len(w) >= 3 and kernel(w, w) else 0.0
            assert x == pytest.approx(want, abs=1e-6)


def test_large_alphabets_need_no_table_of_all_triples():
    rng = random.Random(4)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 3000)]
    marks = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 24))) for _ in range(150)]
    triples = tx.Triples(marks)
    assert triples.size > 1000 and triples.table is None and triples.count < 150 * 2024
    strings = [m[:2] + "x" + m[2:] for m in marks[:6]] + ["\u4e00\u4e01\u4e02", "plain"]
    got = tx.kernels(strings, marks, triples)
    for w, row in zip(strings, got):
        for t, x in list(zip(marks, row))[:20]:
            assert x == pytest.approx(kernel(w, t) / np.sqrt(kernel(w, w) * kernel(t, t)), abs=1e-6)
    # the same numbers with and without a table
    few = ["\x02idiot\x03", "banana"]
    small, other = tx.Triples(few), tx.Triples(few)
    other.table = None
    codes = small.of(tx._points(["banidio", "xaanaxa"], 7))
    assert (small.number(codes) == other.number(codes)).all() and (small.number(codes) > 0).any()


def test_letters_apart_are_read_as_a_word():
    assert "idiot" in tx.words_of("you i  d  i\to t you") and "idiot" in tx.words_of("I D I O T")


def test_own_kernel_by_definition():
    for w in ("abc", "aaaa", "banana", "abcabcabc"):
        assert tx.own_kernel(tx._points([w], len(w)))[0] == pytest.approx(kernel(w, w))


def test_inserted_characters_lower_the_kernel_but_keep_it():
    marks = ["\x02idiot\x03"]
    same, gap, other = tx.kernels(["\x02idiot\x03", "\x02id.iot\x03", "\x02garden\x03"], marks, tx.Triples(marks))[:, 0]
    assert same == pytest.approx(1) and 0.5 < gap < 1 and other < 0.1


def test_model_is_the_sum_over_landmarks():
    clean = [[w] for w in ("garden", "river", "table", "window", "meadow", "house")]
    training = tx.Training([["idiot"], ["you", "idiot"], ["moron"]], clean, {"idiot": 5.0, "moron": 3.0}, tx.Fit(landmarks=16))
    model = training.model()
    words = ["\x02idiot\x03", "\x02idi.ot\x03", "\x02garden\x03", "\x02q\x03"]
    values = model.decide(words)
    assert values[0] > 0.5 > values[2] and values[1] > values[2]
    features = training._features(words)
    # decide() is linear in the same kernels: it must rank and separate as the Nyström features do.
    w, *_ = np.linalg.lstsq(training.features, model.decide(training.words), rcond=None)
    assert np.allclose(features @ w, values, atol=0.05)


def test_units_and_words():
    assert tx.words_of("You  ARE an i d i o t, ok") == ["you", "are", "an", "i", "d", "i", "o", "t,", "ok"] \
        or "idiot" in "".join(tx.words_of("You are an i d i o t ok"))
    assert "idiot" in tx.words_of("you are an i d i o t ok")
    assert tx.words_of("") == []
    long = tx.units_of("x" * 100)
    assert all(len(u) <= tx.WINDOW for u in long) and "".join(long).count("x") >= 100


def corpus(spark, n=400, seed=4):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("bcdfglmnprstv", k=1)[0] + rng.choice("aeiou") for _ in range(rng.randrange(1, 4))) for _ in range(300)]
    bad = ["grumbolt", "vexnard", "snorkwit", "blathump"]
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.randrange(5, 60))
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words), 0.5))
        if i % 2 == 0 or i % 3 == 0:
            labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, score double"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_learns_and_tolerates_disguise(spark):
    docs, labels = corpus(spark)
    model, share = tx.fit_model(docs, labels, tx.Fit(landmarks=64))
    out = {r.doc_id: r.p for r in tx.score_documents(docs, model, share, score_as="p").collect()}
    assert len(out) == 400
    assert np.mean([(out[i] >= 0.7) == (i % 4 == 0) for i in range(400)]) > 0.97
    more = spark.createDataFrame([(1, "bala gru.mbolt nico vex-nard lomo snork*wit tu"), (2, "g r u m b o l t v e x n a r d s n o r k w i t"),
                                  (3, "nico bala lomo"), (4, None), (5, ""), (6, "nico " * 30_000 + "grumbolt vexnard snorkwit"), (7, "??? !!!"),
                                  (3, "nico bala lomo")], "doc_id long, text string")
    got = [(r.doc_id, r.score) for r in tx.score_documents(more, model, share).collect()]
    p = dict(got)
    assert len(got) == 8 and all(0 <= s <= 1 for s in p.values())
    assert min(p[1], p[6]) > 0.5 > max(p[3], p[4], p[5], p[7]) and p[4] == p[5]


def test_without_usable_labels(spark):
    docs, labels = corpus(spark, 40)
    for some in (labels.where("false"), labels.where("toxic = 0")):
        model, share = tx.fit_model(docs, some)
        assert model is None
        assert {r.s for r in tx.score_documents(docs, model, share, score_as="s").collect()} == {share}
    model, share = tx.fit_model(docs.where("false"), labels)
    assert model is None and tx.score_documents(docs.where("false"), model, share, score_as="s").count() == 0


def test_held_out_labels_are_never_read(spark):
    docs, labels = corpus(spark)
    turned = labels.withColumn("toxic", __import__("pyspark").sql.functions.when(held_out(labels.doc_id), 1 - labels.toxic).otherwise(labels.toxic))
    small = tx.Fit(landmarks=32, mining=1)
    a, b = tx.fit_model(docs, labels, small)[0], tx.fit_model(docs, turned, small)[0]
    assert np.array_equal(a.table, b.table) and np.array_equal(a.sigmoid, b.sigmoid)


def test_held_out_accuracy(spark):
    out = tx.op8_toxicity(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = out.join(labels, "doc_id").where("held_out").select("toxic", "predicted").collect()
    hit = sum(r.toxic == r.predicted == 1 for r in rows)
    assert hit >= 0.75 * sum(r.toxic for r in rows)             # some toxic rows there hold no insult at all
    assert hit >= 0.9 * sum(r.predicted for r in rows)

"""Quality rules: counts against brute force, the forest's constraints, its flat form, and held-out labels."""
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerspark.llm import quality_trees as QT
from ledgerspark.llm.common import held_out, table, text_slices


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


def odd_texts():
    rnd = random.Random(3)
    words = ["a", "b", "ä", "xx", "Ünï", "#", "<b>", " ", " x", "🙂", "!!"]
    out = [None, "", " ", "\n\n\n", "\t\x0b\x0c\r", "one", "a b c d e f g h a b c d e f g h", "x " * 16, "x " * 8,
           "line\nline \nline\n\nline", "no end\n", "\nline\nline", "a\x0bb\x0cc\rd"]
    for n in [3, 9, 17, 40, 200, 900] * 12:
        out.append("".join(rnd.choice(words[:rnd.randint(2, 11)]) + rnd.choice(["", " ", " ", "  ", "\n", "\t"]) for _ in range(n)))
    return out + ["w" * 300_000, "many lines\n" * 20_000, " ".join(f"w{i}" for i in range(40_000)) * 2]


def test_counts_as_by_hand():
    texts = odd_texts()
    for size in (1 << 30, 500, 1):        # all together, few, and one at a time
        got = []
        for _, part in text_slices(pa.array([t or "" for t in texts]), size):
            s = QT.statistics(part)
            got += list(zip(*(s[c].tolist() for c in QT.COUNTS)))
        assert got == [brute(t) for t in texts]


def test_letter_cases_and_chars():
    s = QT.statistics(pa.array(["Ab Ç9!\n.", "", "##é"]))
    assert s["n_chars"].tolist() == [8, 0, 3] and s["n_upper"].tolist() == [1, 0, 0] and s["n_lower"].tolist() == [1, 0, 0]
    assert s["n_other_letters"].tolist() == [1, 0, 1] and s["n_digits"].tolist() == [1, 0, 0] and s["n_shouts"].tolist() == [1, 0, 0]


def walk(t, x):
    total = t.start
    for node in t.roots:
        while t.left[node] != node:
            node = t.left[node] if x[t.feature[node]] <= t.threshold[node] else t.right[node]
        total += t.value[node]
    return total


@pytest.fixture(scope="module")
def noisy():
    rnd = np.random.default_rng(5)
    x = rnd.random((3000, 4))
    # the second feature falls, then rises: a monotonic forest must not follow it back up
    y = (np.sin(9 * x[:, 1]) + 2 * x[:, 0] + rnd.normal(0, 0.4, 3000) > 1).astype(float)
    return x, y


def test_flat_trees_equal_a_walk(noisy):
    t = QT.fit_trees(*noisy, QT.Fit(trees=12, monotone=(0, 0, 0, 0)))
    assert np.allclose(t.margin(noisy[0][:200]), [walk(t, row) for row in noisy[0][:200]])
    assert ((t.probability(noisy[0]) > 0.5) == noisy[1]).mean() > 0.85


@pytest.mark.parametrize("sign", [1, -1])
def test_forest_is_monotonic(noisy, sign):
    x, y = noisy
    t = QT.fit_trees(x, y, QT.Fit(trees=25, monotone=(0, sign, 0, 0)))
    grid = np.linspace(-0.1, 1.1, 60)
    for row in x[:80]:
        line = np.tile(row, (60, 1))
        line[:, 1] = grid
        assert (sign * np.diff(t.margin(line)) >= -1e-12).all()
    free = QT.fit_trees(x, y, QT.Fit(trees=25, monotone=(0, 0, 0, 0)))
    line = np.tile(x[0], (60, 1))
    line[:, 1] = grid
    assert (np.diff(free.margin(line)) > 0).any() and (np.diff(free.margin(line)) < 0).any()


def test_constant_features_and_single_rows():
    t = QT.fit_trees(np.ones((6, 2)), np.array([0, 1, 0, 1, 1, 1.0]), QT.Fit(monotone=(0, 0)))
    assert np.allclose(t.probability(np.ones((3, 2))), 4 / 6, atol=0.01)


def test_edges_of_the_query(spark):
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(odd_texts())] + [(None, "x " * 30, 1), (1, "", 2), (1, "", 2)],
                                 "doc_id long, text string, score int")
    none = spark.createDataFrame([(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = QT.fit_model(docs, none)
    assert model is None
    out = QT.quality_rules(docs, model).collect()
    assert len(out) == docs.count()
    for r in out:
        n, _, _, _, repeated = (r[c] for c in QT.COUNTS)
        assert r.base_failed == (n < 20 or 100 * repeated > 30 * n) and r.kept == (not r.base_failed) and r.score is None
    by_id = {r.doc_id: tuple(r[c] for c in QT.COUNTS) for r in out if r.doc_id is not None}
    assert by_id == {i: brute(t) for i, t in enumerate(odd_texts())}
    assert QT.quality_rules(docs.limit(0), model).count() == 0


def test_held_out_labels(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    model = QT.fit_model(docs, labels)
    out = QT.quality_rules(docs, model).join(labels, "doc_id").where(held_out(F.col("doc_id"))).collect()
    long = [r for r in out if not r.base_failed]
    good, bad = [r for r in long if r.quality == 1], [r for r in long if r.quality == 0]
    assert len(good) > 500 and len(bad) > 50
    assert sum(r.kept for r in good) / len(good) >= 0.99
    assert sum(not r.kept for r in bad) / len(bad) >= 0.95

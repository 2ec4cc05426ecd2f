"""Filter audit against a simulation of every order over single documents."""
from itertools import permutations
from math import factorial

import pytest

from ledgerspark.llm import filter_audit as FA

LONG = "word " * 30_000 + "Capital"
TEXTS = [None, "", "a b c", " ".join(f"w{i}" for i in range(60)), "SHOUT " * 60, "x y " * 40, "few # words",
         " ".join(f"W{i}" for i in range(70)) + " $", LONG, " ".join(["one"] * 60), "t\x0bu\x0cv\rw\nx\ty " * 12]


def fails(text):
    """The filters by their definitions, character by character."""
    words, word = [], ""
    for ch in (text or "") + " ":
        if ch == " " or "\t" <= ch <= "\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += ch
    out = ""
    if len(words) < 50:
        out += "A"
    if 100 * len(set(words)) < 65 * len(words):
        out += "B"
    if 100 * sum("A" <= ch <= "Z" for ch in text or "") > 5 * len(text or ""):
        out += "C"
    if any(ch in "#$%&*|" for ch in text or ""):
        out += "D"
    return out


def simulate(docs, labels):
    rows = []
    for doc_id, text, source in docs:
        failed = fails(text)
        if doc_id is not None and any(i is not None and i < doc_id and (t or "") == (text or "") for i, t, _ in docs):
            failed += "E"
        marks = [m for m in labels if m[0] == doc_id and doc_id is not None]
        rows.append((source or "", failed, any(m[1] == 1 for m in marks), any(m[2] == 1 for m in marks)))
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        removed_by = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                failing = sum(f in r[1] for r in own)
                out[part, order, step] = [len(left), len(gone), failing - len(gone), sum(r[1] == f for r in own),
                                          sum(r[2] for r in gone), sum(r[3] for r in gone)]
                removed_by[f] += len(gone)
        for (p, order, step), row in out.items():
            if p == part:
                row.append(removed_by[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def audited(spark, docs, labels):
    # further columns whose names clash with the operator's own
    d = spark.createDataFrame([(*r, 1, "z", b"q") for r in docs],
                              "doc_id long, text string, source string, failed int, part string, digest binary")
    m = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = FA.filter_audit(FA.failed_sets(d, m)).collect()
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got}, len(got)


def test_every_order_as_simulated(spark):
    docs = [(i, TEXTS[i % len(TEXTS)], [None, "s1", "s2", ""][i * 7 % 4]) for i in range(40)]
    docs += [(100, "hot text", "s1")] * 5 + [(i, "hot text", "s2" if i % 3 else "s1") for i in range(90, 140)]
    docs += [(None, "hot text", "s1"), (None, None, None), (3, TEXTS[3], "s1"), (3, TEXTS[3], "s2")]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 130, 2)] + [(4, 1, 1), (4, 0, 0), (6, None, None), (None, 1, 1), (9999, 1, 1)]
    got, n = audited(spark, docs, labels)
    want = simulate(docs, labels)
    assert n == len(want) and got == want


def test_empty_tables(spark):
    assert audited(spark, [], [])[1] == 0
    got, n = audited(spark, [(1, None, None)], [])
    assert n == 600 and got["", "ABCDE", 1][:2] == (0, 1)


@pytest.mark.parametrize("filters", ["A", "ABC", "ABCDE", "ABCDEF"])
def test_path_counts(filters):
    found = FA.edges(filters)
    n = len(filters)
    # every order uses one edge a step, so the counts of the edges that leave states of one size sum to all orders
    for size in range(n):
        assert sum(w for s, _, w in found if s.bit_count() == size) == factorial(n)
    seen = {}
    for _, _, state, f in FA.order_steps(filters):
        seen[state, f] = seen.get((state, f), 0) + 1
    assert seen == {(s, f): w for s, f, w in found}


def test_shapley_sums_to_everything_removed(spark):
    docs = [(i, TEXTS[i % len(TEXTS)], "s") for i in range(33)]
    got, _ = audited(spark, docs, [])
    by_filter = {order[step - 1]: row[-1] for (_, order, step), row in got.items()}
    assert sum(by_filter.values()) == 120 * (33 - got["s", "ABCDE", 5][0])

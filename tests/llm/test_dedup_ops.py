"""Exact dedup, near-duplicates and line dedup against brute force."""

import collections
import hashlib
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerspark.llm import exact_dedup as ed
from ledgerspark.llm import line_dedup as ld
from ledgerspark.llm import prob_minhash as pm
from ledgerspark.llm.common import Scratch

DOCS = "doc_id long, text string, lang string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], DOCS)


# ---- exact dedup ----

EXACT = [(1, "a"), (2, "a"), (3, "b"), (4, None), (5, ""), (None, "b"), (6, "a"), (6, "a"), (7, "A"), (8, "x" * 50_000),
         (9, "x" * 50_000), (None, "only null"), (10, "a ")]


def exact_brute(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        left = 1
        for i in ids:
            out.append((i, keep, len(ids), i == keep and left > 0, hashlib.sha256(t.encode()).hexdigest()))
            left -= i == keep
    return sorted(out, key=repr)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup_edges(spark, weak):
    options = {"hash_of": lambda c: F.unhex(F.lit("00"))} if weak else {}
    out = ed.exact_dedup(docs_of(spark, EXACT), keep="largest", **options)
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r) for r in out.collect()), key=repr) == exact_brute(EXACT)


def test_exact_dedup_empty_table_and_smallest(spark):
    assert ed.exact_dedup(docs_of(spark, [])).count() == 0
    out = ed.exact_dedup(docs_of(spark, [(2, "q"), (1, "q")]))
    assert {r.doc_id: r.kept for r in out.collect()} == {1: True, 2: False}


def test_exact_dedup_clashing_columns(spark):
    df = docs_of(spark, [(1, "q"), (2, "q")]).withColumn("_h", F.lit(1)).withColumn("keep_id", F.lit("z")).withColumn("_text", F.lit(0))
    assert sorted(r.keep_id for r in ed.exact_dedup(df, keep="largest").collect()) == [2, 2]


# ---- near-duplicates ----

def words(rng, n):
    return [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]


def edited(rng, w, n):
    w = list(w)
    for i in rng.sample(range(len(w)), n):
        w[i] = f"e{rng.randrange(10 ** 6)}"
    return w


def near_brute(rows):
    """Class id of every (id, text), by all pairs."""
    texts = sorted({t or "" for _, t in rows})
    with np.errstate(over="ignore"):
        d, s, c = pm.shingles(texts)
    sets = [(s[d == i], c[d == i]) for i in range(len(texts))]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        if pm.probability_jaccard(sets[a], sets[b]) >= 0.8:
            root[find(a)] = find(b)
    low = {}
    for i, t in rows:
        r = find(texts.index(t or ""))
        if i is not None:
            low[r] = min(low.get(r, i), i)
    return {(i, t): low.get(find(texts.index(t or ""))) for i, t in rows}


def test_probability_jaccard_by_definition():
    rng = random.Random(1)
    for _ in range(30):
        a = {rng.randrange(12): rng.randrange(1, 5) for _ in range(6)}
        b = {rng.randrange(12): rng.randrange(1, 5) for _ in range(6)}
        every = set(a) | set(b)
        want = sum(1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in every) for i in a if i in b)
        pack = lambda x: (np.array(sorted(x), np.uint64), np.array([x[k] for k in sorted(x)]))
        assert pm.probability_jaccard(pack(a), pack(b)) == pytest.approx(want)


def test_registers_estimate_probability_jaccard():
    rng = random.Random(2)
    base = words(rng, 400)
    with np.errstate(over="ignore"):
        for n in (3, 8, 25):
            d, s, c = pm.shingles([" ".join(base), " ".join(edited(rng, base, n))])
            r = pm.registers(2, d, s, c, 4096)
            exact = pm.probability_jaccard((s[d == 0], c[d == 0]), (s[d == 1], c[d == 1]))
            assert abs((r[0] == r[1]).mean() - exact) < 0.04


def test_shingles_of_short_and_empty_texts():
    with np.errstate(over="ignore"):
        d, s, c = pm.shingles(["", "one two", "a b c d e", "  \n", "A b\nc  d e", "one two three", "x x x x x x"])
    assert d.tolist() == [1, 2, 4, 5, 6]
    assert s[1] == s[2] and len(set(s.tolist())) == 4
    assert c.tolist() == [1, 1, 1, 1, 2]


@pytest.mark.parametrize("few,direct", [(64, pm.DIRECT), (1, pm.DIRECT), (64, 0), (1, 0)])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, few, direct):
    monkeypatch.setattr(pm, "DIRECT", direct)
    rng = random.Random(3)
    base, other, passage = words(rng, 200), words(rng, 120), words(rng, 60)
    rows = [(i, " ".join(edited(rng, base, 3))) for i in range(40, 70)]             # a hot group of near copies
    rows += [(i, " ".join(base)) for i in range(20, 36)]                            # and of exact ones
    chain = base
    for i in range(100, 108):                                                       # linked only step by step
        chain = edited(rng, chain, 3)
        rows.append((i, " ".join(chain)))
    hub = words(rng, 100)                                                           # linked to one text, not to each other
    rows += [(i, " ".join(edited(rng, hub, 2))) for i in range(120, 150)] + [(151, " ".join(hub))]
    rows += [(200, " ".join(other)), (201, " ".join(edited(rng, other, 1)).upper()), (202, " ".join(edited(rng, other, 60)))]
    rows += [(i, " ".join(words(rng, 60) + passage)) for i in range(300, 312)]      # a shared passage, no duplicates
    rows += [(400, None), (401, ""), (402, "  "), (403, "one two"), (404, "one two"), (None, " ".join(base)), (405, "one three"),
             (20, " ".join(base)), (406, " ".join(words(rng, 20_000)))]
    found = pm.NearDuplicates(docs_of(spark, rows), few=few, pivots=4).members().collect()
    assert len(found) == len(rows)
    want = near_brute(rows)
    got = collections.defaultdict(set)
    for r in found:
        got[(r.id, bytes(r.hash))].add(r.class_id)
    for (i, t), c in want.items():
        assert got[(i, hashlib.md5((t or "").encode()).digest())] == {c}, i
    kept = [r.class_id for r in found if r.kept]
    assert len(kept) == len(set(kept)) == len(set(want.values()))


def test_bound_of_texts_that_share_nothing_beyond_a_star(spark):
    """The refinement leaves out no pair of the threshold: shared shingles beyond the star, or a bound that allows it."""
    rng = random.Random(12)
    rows, star = [], [(k, rng.choice([1, 1, 1, 2, 7])) for k in rng.sample(range(500), 60)]
    for _ in range(150):
        own = [(k, max(1, w + rng.choice([0, 0, 0, 1, -1, 5]))) for k, w in rng.sample(star, rng.randint(0, 60))]
        rows.append(own + [(k, rng.choice([1, 2])) for k in rng.sample(range(1000, 1040), rng.choice([0, 0, 1, 2, 6]))])
    pack = lambda x: (np.array([k for k, _ in sorted(x)], np.uint64), np.array([w for _, w in sorted(x)], np.int64))
    b, texts = pack(star), [pack(r) for r in rows if r]
    found = [pm.measures(t, b) for t in texts]
    cols = [f"{p}_{c}" for p in "uv" for c in ("total", "share", "least", "lacks0", "lacks1")]
    pairs = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2)
             if not set(texts[i][0].tolist()) & set(texts[j][0].tolist()) - set(b[0].tolist())]
    flat = lambda m: (m[0], m[1] / m[0], m[2], m[3], m[3])
    df = spark.createDataFrame([(n, *map(float, (*flat(found[i]), *flat(found[j])))) for n, (i, j) in enumerate(pairs)],
                               "n int, " + ", ".join(f"{c} double" for c in cols))
    every = list(itertools.combinations(range(len(texts)), 2))
    names = [f"{p}{c}" for p in ("", "p") for c in pm.MEASURES]
    both = spark.createDataFrame([(n, *found[i], *found[j]) for n, (i, j) in enumerate(every)], "n int, " + ", ".join(f"{c} double" for c in names))
    for r in both.select("n", pm.pair_bound().alias("bound")).collect():
        assert pm.probability_jaccard(texts[every[r.n][0]], texts[every[r.n][1]]) <= r.bound + 1e-9
    tight = 0
    for r in df.select("n", pm.shared_bound("u", "v").alias("bound")).collect():
        exact = pm.probability_jaccard(texts[pairs[r.n][0]], texts[pairs[r.n][1]])
        assert exact <= r.bound + 1e-9
        tight += r.bound < 0.8
    assert tight > 1000


@pytest.mark.parametrize("few", [64, 2])
def test_dense_groups_around_a_star(spark, monkeypatch, few):
    """Groups just below the threshold, prefixes of one text, shared insertions, repeated words: no link is lost, few pairs are compared."""
    monkeypatch.setattr(pm, "DIRECT", 0)
    rng = random.Random(21)
    base = words(rng, 150)
    rows = [(i, " ".join(edited(rng, base, rng.choice([1, 2, 3, 4, 5])))) for i in range(150)]
    long = words(rng, 120)
    rows += [(200 + i, " ".join(long[:60 + 3 * i])) for i in range(20)]                                   # linked step by step
    extra = [words(rng, 30) for _ in range(3)]
    rows += [(300 + i, " ".join(edited(rng, base[:75], 1) + extra[i % 3] + base[75:])) for i in range(30)]   # three sub-groups
    rows += [(400 + i, " ".join(base + ["again"] * rng.randint(0, 120))) for i in range(15)]
    rows.append((500, " ".join(base)))
    found = pm.NearDuplicates(docs_of(spark, rows), few=few, pivots=4).members().collect()
    want = near_brute(rows)
    texts = dict(rows)
    assert {r.id: r.class_id for r in found} == {i: want[i, texts[i]] for i, _ in rows}


def test_members_with_own_edits_do_not_meet_by_a_common_passage(spark, monkeypatch):
    """Texts around a star that all hold one passage beside many edits of their own are told apart without comparing all
    pairs; the near copies among them are linked."""
    def every(least):
        def pairs(batches):
            for batch in batches:
                v, p = (batch.column(c).to_numpy() for c in ("v", "pv"))
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(v, p)), pa.array(np.minimum(v, p))], ["a", "b"])
        return pairs
    counts, verify = [], pm.NearDuplicates._verify

    def counted(self, pairs, bodies):
        counts.append(pairs.count())
        return verify(self, pairs, bodies)
    monkeypatch.setattr(pm, "_agreeing", every)
    monkeypatch.setattr(pm.NearDuplicates, "_verify", counted)
    rng = random.Random(33)
    base, passage = words(rng, 150), words(rng, 12)
    held = base[:75] + passage + base[75:]
    rows = [(i, " ".join(edited(rng, held, 9))) for i in range(160)]
    rows += [(200 + i, " ".join(edited(rng, rows[i][1].split(), 1))) for i in range(8)]
    rows.append((500, " ".join(base)))
    found = pm.NearDuplicates(docs_of(spark, rows)).members().collect()
    want, texts = near_brute(rows), dict(rows)
    assert {r.id: r.class_id for r in found} == {i: want[i, texts[i]] for i, _ in rows}
    assert sum(counts[1:]) < 5 * len(rows), counts


def test_components_against_union_find(spark):
    rng = random.Random(8)
    edges = [(i + 1, i) for i in range(0, 30)] + [(100, i) for i in range(60, 99, 3)] + [(rng.randrange(200, 300), rng.randrange(200, 300))
                                                                                          for _ in range(60)] + [(5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.v: r.label for r in pm.components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test")).collect()}
    assert got == {v: find(v) for a, b in edges if a != b for v in (a, b)}
    assert pm.components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "test")).count() == 0


def test_near_duplicates_empty_table(spark):
    assert pm.NearDuplicates(docs_of(spark, [])).members().count() == 0


def test_near_duplicate_links_are_named_for_what_they_count(spark):
    text = " ".join(f"word{i}" for i in range(200))
    out = pm.NearDuplicates(docs_of(spark, [(i, f"{text} end{i}") for i in range(5)])).members()
    assert out.columns == ["id", "hash", "class_id", "class_size", "n_star_links", "kept"]
    rows = out.collect()
    assert {r.class_size for r in rows} == {5} and all(1 <= r.n_star_links <= 4 for r in rows)


# ---- line dedup ----

def line_brute(rows, least):
    """Deletes the lines of every run of at least ``least`` words that has an earlier place, by looking at all runs."""
    count = lambda line: len([x for x in line.replace("\t", " ").split(" ") if x])
    docs = sorted({(i is not None, i or 0, t or "") for i, t in rows})
    places = collections.defaultdict(list)
    split = [t.split("\n") for _, _, t in docs]
    for n, lines in enumerate(split):
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                if sum(map(count, lines[a:b])) >= least:
                    places[tuple(lines[a:b])].append((n, a, b))
    gone = {(n, p) for found in places.values() for n, a, b in found[1:] for p in range(a, b)}
    left = {d: "\n".join(x for p, x in enumerate(split[n]) if (n, p) not in gone) for n, d in enumerate(docs)}
    return sorted(((i, left[(i is not None, i or 0, t or "")]) for i, t in rows), key=repr)


def line_rows(seed):
    rng = random.Random(seed)
    lines = ["a b c", "d", "", "e f", "g h i j", "k", "l m"]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 14)))) for i in range(25)]
    return rows + [(50, rows[3][1]), (51, rows[3][1]), (52, "\n".join([rows[4][1], "own", rows[4][1]])), (None, rows[5][1]),
                   (53, None), (54, ""), (55, "\n\n\n"), (56, rows[6][1]), (56, rows[6][1]), (57, "a b c\n" * 30)]


@pytest.mark.parametrize("seed,least", [(1, 4), (2, 7), (3, 12), (4, 1)])
def test_line_dedup_against_all_runs(spark, seed, least):
    # Only ids that give one order: equal ids stand with equal texts here.
    rows = line_rows(seed)
    out = ld.drop_repeated_lines(docs_of(spark, rows), min_words=least)
    assert out.columns == ["doc_id", "text", "lang", "removed_lines"]
    got = sorted(((r.doc_id, r.text or "") for r in out.collect()), key=repr)
    assert got == line_brute(rows, least)


def test_line_dedup_keeps_first_copy_and_clean_documents(spark):
    passage = "\n".join(f"line {i} " + " ".join(f"p{i}x{j}" for j in range(12)) for i in range(6))
    short = "a short common line"
    rows = [(1, f"{short}\nhead\n{passage}\ntail"), (2, f"other\n{passage}\n{short}\nrest"), (3, f"{short}\nclean text"), (4, passage)]
    got = {r.doc_id: r.text for r in ld.drop_repeated_lines(docs_of(spark, rows)).collect()}
    assert got == {1: rows[0][1], 2: f"other\n{short}\nrest", 3: rows[2][1], 4: ""}


def test_line_dedup_empty_table_and_clashing_columns(spark):
    assert ld.drop_repeated_lines(docs_of(spark, [])).count() == 0
    df = docs_of(spark, [(1, "a b c d"), (2, "a b c d")])
    for c in ("cuts", "h_of_text", "id_of_cuts", "pos", "h", "id"):
        df = df.withColumn(c, F.lit(c))
    out = ld.drop_repeated_lines(df, min_words=3)
    assert out.columns == [*df.columns, "removed_lines"]
    assert {r.doc_id: (r.text, r.cuts) for r in out.collect()} == {1: ("a b c d", "cuts"), 2: ("", "cuts")}


def test_line_dedup_plan_has_no_python(spark):
    df = ld.drop_repeated_lines(docs_of(spark, [(1, "a b c d"), (2, "a b c d")]), min_words=3)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan

"""HTML extraction, chat formatting, WARC, SentencePiece, decontamination and licence scan."""

import base64
import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerspark.llm import chat_format as cf
from ledgerspark.llm import decontaminate as dc
from ledgerspark.llm import html_extract as hx
from ledgerspark.llm import license_scan as ls
from ledgerspark.llm import sentencepiece_fst as sp
from ledgerspark.llm import warc
from ledgerspark.llm.common import Scratch

# ---- HTML ----

BLOG = ('<html><head><title>t</title><style>p{{}}</style></head><body><div class="top-menu"><a href="/">Home</a></div>'
        '<header class="site"><p>Site name</p></header><div id="wrap" class="has-sidebar"><div class="post post-{n}"><h1>Head {n}</h1>'
        '<p>First &amp; second &#x41;\n  text of page {n}, long enough to count.<br>After break</p><ul><li>one<li>two</ul>'
        '<div class="ad-box">Buy now</div><script>var x = "</p>";</script><p>Last <b>bo</b>ld.</p></div>'
        '<aside><p>Popular posts with many words that are not the text</p></aside></div>'
        '<div class="comments"><p>A long comment of a reader about this and that and more.</p></div>'
        '<form><p>Subscribe with your address today please</p></form><footer><p>&copy; footer</p></footer></body></html>')
BLOG_TEXT = "Head {n}\n\nFirst & second A text of page {n}, long enough to count. After break\n\none\n\ntwo\n\nLast bold."
ARTICLE = '<body><nav><p>menu</p></nav><article><h1>T</h1><p>One<p>Two</article><div class=notice>We use cookies</div>'


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, 1) for i, u, h in rows], "page_id long, url string, html string, path int")


def test_extract_main_text(spark):
    rows = [(i, f"http://blog.example.org/p/{i}", BLOG.format(n=i)) for i in range(8)]
    rows += [(20, "https://x.example/a", ARTICLE), (21, None, ARTICLE), (22, "http://x.example/b", None), (23, "u", ""),
             (24, "http://blog.example.org/odd", "<body><main><p>Other template</p></main>"), (25, "http://x.example/c", "plain < text & more"),
             (None, "http://x.example/d", "<p>un<b>closed <i>tags"), (26, "http://x.example/a", ARTICLE), (26, "http://x.example/a", ARTICLE),
             (27, "http://x.example/z", "<article><p class='a>broken<p>x</article>"), (28, "http://l.example/", "<article><p>" + "w " * 60_000 + "</article>")]
    out = hx.extract_main_text(pages_of(spark, rows)).collect()
    assert len(out) == len(rows)
    got = {(r.page_id, r.url): r for r in out}
    for i in range(8):
        assert got[(i, f"http://blog.example.org/p/{i}")].text == BLOG_TEXT.format(n=i)
    assert got[(20, "https://x.example/a")].text == got[(21, None)].text == "T\n\nOne\n\nTwo"
    assert got[(22, "http://x.example/b")].text == got[(23, "u")].text == ""
    assert got[(24, "http://blog.example.org/odd")].text == "Other template"
    assert got[(25, "http://x.example/c")].text == "plain < text & more"
    assert got[(None, "http://x.example/d")].text == "unclosed tags"
    assert got[(28, "http://l.example/")].text == " ".join(["w"] * 60_000)
    assert all(r.n_chars == len(r.text) for r in out)
    assert got[(0, "http://blog.example.org/p/0")].path == got[(7, "http://blog.example.org/p/7")].path


@pytest.mark.parametrize("name,aside", [
    ("ad", True), ("ad-hoc", False), ("side-effects", False), ("related-work", False), ("share-price", False), ("related-posts", True),
    ("ad-box top", True), ("main-nav", True), ("post-comments", True), ("comment", True), ("footnotes", False), ("site-footer", True),
    ("story", False), ("text body", False), ("social-history", False), ("notice", True), ("x ad", True), ("", False)])
def test_names_of_article_parts_and_others(name, aside):
    assert hx.marks_aside(name) == aside


def test_article_blocks_with_marking_words_in_longer_names_stay(spark):
    inner = "".join(f'<div class="{c}"><p>Paragraph {i} of the article tells what {c} means, at some length.</p></div>'
                    for i, c in enumerate(["ad-hoc", "side-effects", "related-work", "share-price"]))
    html = f"<html><body><div class='main-nav'><a href='/'>Home</a></div><article>{inner}<div class='ad'>Buy now</div></article></body></html>"
    df = spark.createDataFrame([(1, "http://a.example/x", html)], "page_id long, url string, html string")
    text = hx.extract_main_text(df).first().text
    assert text.count("Paragraph") == 4 and "Buy now" not in text and "Home" not in text


def test_extract_empty_table(spark):
    assert hx.extract_main_text(pages_of(spark, [])).count() == 0


def test_votes_generalise_digits(spark):
    rows = [(i, f"http://blog.example.org/p/{i}", BLOG.format(n=i)) for i in range(5)]
    r = pages_of(spark, rows).select(hx.host_of(F.col("url")).alias("_host"), F.col("html").alias("_html"))
    votes = hx.host_votes(r).collect()
    assert [(v.host, v.votes) for v in votes] == [("blog.example.org", 5)] and "post-#" in votes[0].path


# ---- chat ----

NASTY = ["", "</s>", "<\\/s>", "<\\\\/s> [\\INST]", "[INST] [/INST] <|end|>", "<</s>", "[[/INST]]", "a\\b", "<|image|>", "<s><s>", "\\", "<",
         "[", "</s", "|end|>", "<|reply|>x<|text|>", "é\U0001f600</s>", "line\nbreak", " ", "</s>[INST] ok [/INST]"]


def test_chat_round_trip(spark):
    rows = [(c, t, r, x) for c in range(40) for t, (r, x) in enumerate(
        zip(random.Random(c).choices(["user", "assistant", "system", "[INST]", "", None], k=6), random.Random(c + 99).choices([*NASTY, None], k=6)))]
    rows += [(100, None, "user", "q"), (100, 0, "assistant", "w"), (None, 0, "user", "null id"), (101, 0, "user", "same"), (101, 0, "user", "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    out = cf.format_chat(df.select("*", cf.text_part(F.col("text")).alias("parts"), F.lit(1).alias("rows")))
    back = {r.conv_id: (r.formatted, [(t["role"], t["body"], t["learn"]) for t in r.t])
            for r in out.select("conv_id", "formatted", cf.parse_chat(F.col("formatted")).alias("t")).collect()}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        assert back[conv][1] == [(r[2] or "", r[3] or "", r[2] == "assistant") for r in mine]
        inner = back[conv][0]
        assert inner.count("</s>") == sum(r[2] == "assistant" for r in mine)
        assert inner.count("[/INST]") == sum(r[2] != "assistant" for r in mine)


def test_chat_parts_and_attachments(spark):
    parts = ("array(named_struct('type','text','text','look ','ref',null,'width',null,'height',null,'seconds',null,'pages',null),"
             "named_struct('type','image','text',null,'ref','s3://i.png','width',28,'height',15,'seconds',null,'pages',null),"
             "named_struct('type','audio','text',null,'ref','a.wav','width',null,'height',null,'seconds',2.5D,'pages',null),"
             "named_struct('type','video','text',null,'ref','v','width',null,'height',null,'seconds',null,'pages',2))")
    df = spark.range(1).select(F.col("id").alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"), F.expr(parts).alias("parts"))
    r = cf.format_chat(df).first()
    assert r.formatted == "<s>[INST]user<|text|>look <|image|><|audio|><|document|>[/INST]<|end|>"
    assert [(a.turn_no, a.part_no, a.type, a.ref, a.tokens) for a in r.attachments] == [
        (0, 1, "image", "s3://i.png", 4), (0, 2, "audio", "a.wav", 125), (0, 3, "document", "v", 2048)]
    assert r.expanded_tokens == 4 + 125 + 2048


def test_chat_turns_of_one_number_in_the_order_of_their_texts(spark):
    rows = [(1, 0, "user", t) for t in ("<s> x", "<a x", "[INST] b", "A", "", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("parts", cf.text_part(F.col("text")))
    got = cf.format_chat(df).select(cf.parse_chat(F.col("formatted")).alias("t")).first().t
    assert [x.body for x in got] == sorted(t for *_, t in rows)


def test_chat_null_parts_and_empty_table(spark):
    df = spark.createDataFrame([(1, 0, "user", None)], "conv_id long, turn long, role string, text string")
    assert cf.format_chat(df.select("*", F.lit(None).cast(f"array<{cf.PART.simpleString()}>").alias("parts"))).first().formatted \
        == "<s>[INST]user<|text|>[/INST]<|end|>"
    assert cf.format_chat(df.where("false").select("*", cf.text_part(F.col("text")).alias("parts"))).count() == 0


# ---- WARC ----

def test_warc_record_round_trip():
    body = "<p>é</p>\r\n\r\nWARC/1.0\r\n".encode()
    digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
    r = warc.read_record(warc.make_record(5, "http://a/\r\nX: y", body, digest, 5, False, "2024-01-01T00:00:00Z"))
    assert (r["page_id"], r["payload"], r["intact"], r["record_type"], r["refers_to"]) == (5, body, True, "response", None)
    assert r["url"] == "http://a/%0D%0AX: y"
    r = warc.read_record(warc.make_record(None, "", body, digest, 5, True, "2024-01-01T00:00:00Z"))
    assert (r["page_id"], r["payload"], r["payload_bytes"], r["record_type"], r["refers_to"]) == (None, None, len(body), "revisit", 5)


def test_url_key():
    assert warc.url_key("https://User@Blog.Example.org:8080/a b?q=1#x") == "org,example,blog)/a%20b?q=1"
    assert warc.url_key(None) == ")/"


def test_warc_index_and_lookup(spark):
    rows = [(i, f"http://h{i % 3}.example.org/{i % 7}", f"<p>{i % 11}</p>") for i in range(120)]
    rows += [(500, "http://hot.example/x", "same")] + [(501 + i, "http://hot.example/x", "same") for i in range(60)]
    rows += [(None, None, None), (900, "", ""), (901, "u\tv\nw", "</p>" * 30_000), (902, "http://hot.example/x", "same"), (None, "z", "only null")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    scratch = Scratch(spark, "test-warc")
    folder = scratch.path("files")
    captures = scratch.keep(warc.write_archives(pages, folder, file_bytes=2000), "captures")
    assert captures.count() == len(rows) and captures.select("file").distinct().count() > 3
    shards = scratch.keep(warc.write_index(captures, folder, 3, block_lines=5), "shards")
    key = F.pandas_udf(lambda u: u.map(warc.url_key), "string")
    wanted = pages.select(key(F.coalesce("url", F.lit(""))).alias("key"), "page_id")
    wanted = wanted.unionByName(spark.createDataFrame([("org,none)/", 1), (")/", -5), ("~", 3)], "key string, page_id long"))
    found = warc.fetch(warc.lookup(wanted, shards, folder, 4), folder, 3, with_payload=True, read_bytes=5000).collect()
    assert len(found) == len(rows)
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    by = {r.page_id: r for r in found if r.page_id is not None}
    for i, u, h in rows:
        if i is None:
            continue
        r, body = by[i], (h or "").encode()
        assert (r.payload_bytes, r.payload_digest, r.intact) == (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), True)
        response = first[h or ""] == i
        assert (r.record_type, r.refers_to) == (("response", None) if response else ("revisit", first[h or ""]))
        assert r.payload == (body if response else None)


def test_warc_small_payloads_stay_responses(spark):
    pages = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "xx"), (4, "d", "xx")], "page_id long, url string, html string")
    scratch = Scratch(spark, "test-warc")
    captures, shards, folder = warc.archive_and_index(pages, scratch, min_revisit_bytes=2)
    out = warc.fetch(captures, folder, 2).collect()
    assert {r.page_id: r.refers_to for r in out} == {1: None, 2: None, 3: None, 4: 3}


def test_warc_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    captures, shards, folder = warc.archive_and_index(pages, Scratch(spark, "test-warc"))
    assert warc.fetch(warc.lookup(captures, shards, folder, 2), folder, 2).count() == 0


# ---- SentencePiece ----

TEXTS = ["", " ", "  two  spaces ", "Hello world, it's 3.5%!", "a\tb\nc\r\n\n", "漢字とかな😀", "ñandú ß İ", "x" * 300, " " * 45 + "y",
         "▁real", "<0x0A> <s> </s> <unk>", "\x00\x01", "ababababababab" * 20, "Zu und. Dieüauß der."]


def test_encoding_equals_the_library():
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=sp.MODEL_PATH)
    rng = random.Random(5)
    alphabet = "etaoin shrdluETAOé ß.,\n1234 漢"
    texts = TEXTS + ["".join(rng.choices(alphabet, k=rng.randrange(1, 200))) for _ in range(300)]
    fst = sp.load()
    for t, ids in zip(texts, fst.encode_many(texts)):
        assert ids.tolist() == library.encode(t), t
        assert fst.decode(ids.tolist()) == t.replace("▁", " ")
        cuts = fst.cuts.findall(fst.normalise(t))
        assert [i for c in cuts for i in (fst.path(c) if len(c) > 1 or c in fst.char_of else np.frombuffer(fst.cache[c], np.int32).tolist())] \
            == ids.tolist()


def test_unigram_shortest_path_by_all_segmentations():
    pieces, scores = ["<unk>", "a", "b", "ab", "ba", "aba", "▁", "▁a", "bb"], [0, -2.0, -2.5, -3.0, -2.2, -6.0, -1.0, -2.1, -7.0]
    fst = sp.PieceFst(pieces, scores, {}, frozenset([0]), merges=False)

    def best(cut):
        found = []
        for n in range(1, len(cut) + 1):
            for at in itertools.combinations(range(1, len(cut)), n - 1):
                parts = [cut[i:j] for i, j in zip((0, *at), (*at, len(cut)))]
                if all(p in fst.id_of for p in parts):
                    found.append((-sum(scores[fst.id_of[p]] for p in parts)))
        return min(found)

    for t in ("abab", "bbaab", "a b ab", "ababba", "b" * 9):
        ids = fst.encode_many([t])[0].tolist()
        cuts = fst.cuts.findall(fst.normalise(t))
        assert -sum(scores[i] for i in ids) == pytest.approx(sum(map(best, cuts)))
        assert fst.decode(ids) == t


def test_encode_documents(spark):
    rows = [(i, t, [1]) for i, t in enumerate(TEXTS)] + [(None, None, None), (3, TEXTS[3], [2])]
    df = spark.createDataFrame(rows, "doc_id long, text string, _ids array<int>")
    out = sp.decode_ids(sp.encode_documents(df))
    assert out.columns == ["doc_id", "text", "_ids", "token_ids", "n_tokens", "round_trip", "decoded"]
    for r in out.collect():
        assert r.round_trip and r.n_tokens == len(r.token_ids) and r.decoded == (r.text or "").replace("▁", " ")
    assert sp.encode_documents(df.where("false")).count() == 0


# ---- decontamination ----

ITEM = "A farmer sells 12 crates of apples at 3 dollars each and Peter buys 5 crates for the market, how much does Peter pay in total for them?"


def leaks(spark, docs, items=((1, ITEM),)):
    d = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, item int")
    b = spark.createDataFrame(list(items), "item_id long, text string")
    return sorted((tuple(r) for r in dc.find_leaks(d, b).select("doc_id", "item_id", "kind", "n_slots").collect()), key=repr)


def test_leaks_exact_and_reparameterised(spark):
    filler = " ".join(f"word{i}" for i in range(300))
    other = ITEM.replace("12", "40").replace("3 ", "7 ").replace("5 ", "9 ").replace("Peter", "Maria")
    mixed = ITEM.replace("Peter buys", "Maria buys")            # one name for two: no consistent substitution
    docs = [(1, f"{filler}. {ITEM} {filler}"), (2, f"{filler} {other}\n{filler}"), (3, f"{filler} {mixed}"), (4, filler), (5, None), (6, ""),
            (7, ITEM.upper()), (8, ITEM.replace(" ", "\n")), (None, ITEM), (9, " ".join(ITEM.split()[:12])), (10, ITEM), (10, ITEM),
            (11, (filler + " ") * 40 + ITEM)]
    got = leaks(spark, docs)
    kinds = {(d, k) for d, _, k, _ in got}
    assert {(1, "exact"), (2, "reparameterised"), (None, "exact"), (10, "exact"), (11, "exact")} <= kinds
    assert not {3, 4, 5, 6, 9} & {d for d, *_ in got}
    assert len([1 for d, *_ in got if d == 10]) == 1


def test_leaks_names_at_sentence_beginnings_and_other_letter_case(spark):
    item = "Tom has 3 apples. Mary gives him 4 apples. How many apples does Tom have?"
    filler = " ".join(f"word{i}" for i in range(60))
    other = "Anna has 5 apples. Peter gives him 7 apples. How many apples does Anna have?"
    docs = [(1, f"{filler}. {other} {filler}"), (2, f"{filler} {item.upper()}"), (3, f"{filler} {item.lower()} {filler}"),
            (4, other.replace("does Anna", "does Peter")), (5, f"{filler}\n{item}"), (6, item.title())]
    assert [(d, k) for d, _, k, _ in leaks(spark, docs, [(1, item)])] == \
        [(1, "reparameterised"), (2, "exact"), (3, "exact"), (5, "exact"), (6, "exact")]
    docs = [(1, ITEM.upper()), (2, ITEM.lower()), (3, ITEM.replace(" Peter", "\nPeter")), (4, ITEM.replace("Peter", "PETER")), (5, ITEM)]
    assert [(d, k) for d, _, k, _ in leaks(spark, docs)] == [(d, "exact") for d in range(1, 6)]


def test_leaks_different_numbers_with_one_new_value(spark):
    same = ITEM.replace("12", "5").replace("at 3 ", "at 5 ")
    one_name = ITEM.replace("apples", "Anna").replace("for the", "for Maria the")
    both = one_name.replace("Anna", "Peter")         # two names for one
    assert [(d, k) for d, _, k, _ in leaks(spark, [(1, same), (2, ITEM)])] == [(1, "reparameterised"), (2, "exact")]
    assert [(d, k) for d, _, k, _ in leaks(spark, [(1, both), (2, one_name)], [(1, one_name)])] == [(2, "exact")]


def test_leaks_short_items_in_longer_documents(spark):
    filler = " ".join(f"word{i}" for i in range(30))
    items = [(1, "Who wrote Hamlet?"), (2, "What is 2 + 3?"), (3, "Name the largest moon of Saturn.")]
    docs = [(1, f"{filler}. Who wrote Hamlet? {filler}"), (2, f"{filler}\nwho wrote hamlet\n{filler}"), (3, f"{filler}. Shakespeare wrote Hamlet. {filler}"),
            (4, f"{filler}. What is 2 + 3? {filler}"), (5, f"{filler}. What is 4 + 9? {filler}"), (6, f"{filler} Name the largest moon of Saturn. {filler}"),
            (7, f"{filler}. He asked who wrote Hamlet? {filler}")]
    assert [(d, i, k) for d, i, k, _ in leaks(spark, docs, items)] == [(1, 1, "exact"), (2, 1, "exact"), (4, 2, "exact"), (6, 3, "exact")]


def test_leaks_behind_a_phrase_that_all_items_share(spark):
    """Documents and items that share only a common phrase never meet; those that share an item do."""
    phrase = "which of the following is true about it"
    items = [(i, " ".join(f"item{i}word{j}" for j in range(14)) + f" {phrase}") for i in range(60)]
    docs = [(i, f"filler{i} text before {phrase} and after{i} it goes on") for i in range(500)]
    docs += [(1000 + i, f"a page. {items[i][1]} and more") for i in range(0, 60, 6)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    met = []
    real = dc.candidates

    def counted(*a):
        out = real(*a)
        met.append(out.count())
        return out
    dc.candidates = counted
    try:
        found = {(r.doc_id, r.item_id) for r in dc.find_leaks(d, b).collect()}
    finally:
        dc.candidates = real
    assert found == {(1000 + i, i) for i in range(0, 60, 6)} and met == [len(found)]


def test_leaks_short_null_and_repeated_items(spark):
    items = [(1, "tiny item here"), (2, None), (3, ""), (4, "tiny item here"), (None, "one two three four five six"), (1, ITEM), (1, ITEM)]
    docs = [(1, "a tiny item here"), (2, "tiny item here"), (3, "zero one two three four five six seven"), (4, ITEM)]
    got = {(d, i) for d, i, *_ in leaks(spark, docs, items)}
    assert got == {(2, 1), (2, 4), (3, None), (4, 1)}
    assert leaks(spark, [], items) == []
    assert leaks(spark, docs, []) == []


def test_slot_consistency():
    n = lambda *v: [("num", x) for x in v]
    assert dc.slots_agree(n("3", "4", "3"), n("7", "8", "7"))
    assert not dc.slots_agree(n("3", "3"), n("7", "8"))
    assert not dc.slots_agree(n("3", "4"), n("7", "7"))
    assert not dc.slots_agree([("num", "3")], [("name", "3")])


def test_leaks_against_substring_search(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    plain = {r.doc_id: " ".join(r.text.split()) for r in docs.collect()}
    want = {(d, r.item_id) for r in items.collect() for d, t in plain.items() if " ".join(r.text.split()) in t}
    got = {(r.doc_id, r.item_id) for r in dc.find_leaks(docs, items).collect()}
    assert want and want <= got and len(got - want) <= 2


# ---- licences ----

@pytest.fixture(scope="module")
def licence_model(spark):
    return ls.fit(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_licence_families(spark, licence_model):
    rows = [(1, "text\n# Released under the MIT License.\nmore"), (2, "Licensed under CC BY-NC 4.0."), (3, "licensed under cc by-sa 4.0"),
            (4, "Copyright 2020 X. Licensed under the Apache License, Version 2.0."), (5, "This work is licensed under the GNU General Public License, version 3."),
            (6, "Licensed under the Foo Software License"), (7, "The meadow is green and wide."), (8, None), (9, ""), (None, "All rights reserved."),
            (10, "All rights reserved."), (10, "All rights reserved."), (11, "she has a fishing license"), (12, "x " * 50_000 + "\nAll rights reserved.")]
    df = spark.createDataFrame([(i, t, "p") for i, t in rows], "doc_id long, text string, paragraph string")
    out = ls.scan(df, licence_model).collect()
    got = sorted(((r.doc_id, r.paragraph_no, r.family) for r in out), key=repr)
    sure = [x for x in got if x[0] != 11]
    assert sure == sorted([(1, 1, "mit"), (2, 0, "cc-by-nc"), (3, 0, "cc-by-sa"), (4, 0, "apache-2.0"), (5, 0, "gpl-3.0"), (6, 0, "unknown"),
                           (None, 0, "proprietary"), (10, 0, "proprietary"), (10, 0, "proprietary"), (12, 1, "proprietary")], key=repr)
    assert all(x[2] == "unknown" for x in got if x[0] == 11)


def test_licence_scan_is_whole_against_plain_search(spark, licence_model):
    """Every line with one of the corpus's notices is found, with its family, and nothing else is given a family."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    notices = {"Licensed under CC BY-NC 4.0.": "cc-by-nc", "Released under the MIT License.": "mit", "All rights reserved.": "proprietary",
               "Licensed under the Apache License, Version 2.0.": "apache-2.0",
               "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0"}
    want = sorted((r.doc_id, n, notices[x]) for r in docs.collect() for n, x in enumerate(r.text.split("\n")) if x in notices)
    got = sorted((r.doc_id, r.paragraph_no, r.family) for r in ls.scan(docs, licence_model).collect() if r.family != "unknown")
    assert want and got == want


def test_licence_plan_and_empty_table(spark, licence_model):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert ls.scan(df, licence_model).count() == 0
    plan = ls.scan(df, licence_model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_licence_notices_common_in_the_corpus(spark):
    """Notices without any licence word that a third of the documents hold, each with its own words, are still found."""
    notices = {"mit": ls.NOTICES["mit"][3], "bsd": ls.NOTICES["bsd"][3], "isc": ls.NOTICES["isc"][1]}
    some = sorted(notices)
    rows = [(i, f"The meadow number {i} is green and wide.\nA river {i * 7} runs along the old road to the town."
             + (f"\n{notices[some[i // 3 % 3]]}, holder {i}." if i % 3 == 0 else "")) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.paragraph_no, r.family) for r in ls.scan(docs, ls.fit(docs)).collect())
    assert got == [(i, 2, some[i // 3 % 3]) for i in range(0, 240, 3)]


def test_licence_in_a_text_of_many_lines(spark, licence_model):
    """A text of many short lines costs its size, not a window for each line; a line is split off once."""
    text = "\n".join(f"line {i} of a long text" for i in range(600_000)) + "\nAll rights reserved.\nthe end"
    df = spark.createDataFrame([(1, text), (2, "")], "doc_id long, text string")
    assert [(r.doc_id, r.paragraph_no, r.family) for r in ls.scan(df, licence_model).collect()] == [(1, 600_000, "proprietary")]


def test_licence_wrapped_notices(spark, licence_model):
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:"
    gpl = ("# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation, either version 3 of the License, or\n"
           "# (at your option) any later version.")
    mit = ("Permission is hereby granted, free of charge,\n * to any person obtaining a copy\n * of this software and associated\n"
           " * documentation files (the \"Software\"), to deal")
    rows = [(1, bsd), (2, f"A green meadow.\n\n# This program is free software: you can redistribute it and/or modify\n{gpl}\nThe river is wide."),
            (3, f"The sky\n * {mit}\n\nThe end."), (4, bsd.replace("\n", "\n\n")), (5, f"{bsd}\n\n{mit}"), (5, f"{bsd}\n\n{mit}"), (None, bsd),
            (6, "All rights reserved.\nThe river."), (7, "Released under\nthe MIT License.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.paragraph_no, r.family) for r in ls.scan(df, licence_model).collect() if r.family != "unknown"), key=repr)
    assert got == sorted([(1, 0, "bsd"), (2, 3, "gpl-3.0"), (3, 1, "mit"), (5, 0, "bsd"), (5, 0, "bsd"), (5, 3, "mit"), (5, 3, "mit"),
                          (None, 0, "bsd"), (6, 0, "proprietary"), (7, 0, "mit")], key=repr)

"""The registered queries and the pipeline's stages."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from ledgerspark.llm import registry

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered_once():
    names = [k for k in __spark_entry__.queries() if k.startswith("op")]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14))
    assert set(registry.ORACLE) <= set(registry.QUERIES) and "pipeline" in __spark_entry__.queries()
    assert [s for s, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "sentencepiece"]


def odd_documents(spark):
    """Nulls, empty texts, a very long one, repeated rows, and columns with the operators' own names."""
    rows = [(1, "a b c d e f g", "en", "s", 13), (2, None, None, None, None), (3, "", "en", "s", 0), (None, "null id text here now", "en", "s", 22),
            (4, "long " * 40_000, "en", "s", 200_000), (1, "a b c d e f g", "en", "s", 13), (5, "a b c d e f g", "fr", "t", 13),
            (1, "same id, other text", "en", "s", 19)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("score", "worst", "id", "hash", "h", "v", "label", "token_ids", "cuts", "kept_id", "hash_of_text", "toxicity_score", "Leak_Id", "_id", "item"):
        df = df.withColumn(c, F.lit("mine"))
    return df


def test_stages_on_odd_documents(spark):
    docs = odd_documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        rows = out.collect()
        assert len(rows) == {"near_dedup": 5}.get(name, 8), name
        assert all(r.score == r.hash == r.Leak_Id == "mine" for r in rows)
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert out.columns == [*docs.columns, "token_ids_", "n_tokens", "round_trip"] and out.count() == 8
    assert out.where("round_trip").count() == 8


def test_stages_on_an_empty_table(spark):
    docs = odd_documents(spark).where("false")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name


def test_run_equals_the_stages_one_by_one(spark):
    got = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(os.path.join(SF, "documents.parquet"))
    raw = {r.doc_id: r.text for r in docs.collect()}
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = stage(spark, docs, SF)
        if i < 4:
            docs = spark.createDataFrame(docs.collect(), before.schema)
    assert sorted((r.doc_id, r.text, r.token_ids) for r in docs.collect()) == sorted((r.doc_id, r.text, r.token_ids) for r in got)
    assert len({r.doc_id for r in got}) == len(got) and all(r.n_chars == len(r.text) for r in got)
    items = [" ".join(r.text.split()) for r in spark.read.parquet(os.path.join(SF, "benchmark.parquet")).collect()]
    assert not [r.doc_id for r in got for x in items if x in " ".join(r.text.split())]
    # What is kept unchanged is most of the corpus.
    assert sum(raw[r.doc_id] == r.text for r in got) > 0.6 * len(raw)


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op2_html_extract", "op3_decontaminate", "op4_chat_format", "op6_line_dedup",
                                  "op7_prob_minhash", "op9_warc_index", "op10_sentencepiece"])
def test_queries_run_over_whole_tables(spark, name):
    rows = __spark_entry__.queries()[name](spark, SF).collect()
    sizes = {"op2_html_extract": "pages", "op9_warc_index": "pages"}
    if name == "op4_chat_format":
        turns = spark.read.parquet(f"{SF}/conversations.parquet")
        assert len(rows) == turns.select("conv_id").distinct().count() + 1
    elif name != "op3_decontaminate":
        assert len(rows) == spark.read.parquet(f"{SF}/{sizes.get(name, 'documents')}.parquet").count()

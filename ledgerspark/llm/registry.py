"""The queries and SQL twins of the training-data operators."""

from __future__ import annotations

from ledgerspark.llm import chat_format, decontaminate, exact_dedup, filter_audit, html_extract, license_scan, line_dedup, phrase_mining, prob_minhash, quality_trees, sentencepiece_fst, toxicity, warc

MODULES = [exact_dedup, html_extract, decontaminate, chat_format, license_scan, line_dedup, prob_minhash, toxicity, warc, sentencepiece_fst,
           quality_trees, phrase_mining, filter_audit]

QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
ORACLE = {k: s for m in MODULES for k, s in m.ORACLE.items()}

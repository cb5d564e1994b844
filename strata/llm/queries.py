"""Registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import (
    chat, compress_lang, decontaminate, line_dedup, merkle, near_dup, ordinal_toxicity, quality_rules,
    secrets_grammar, sentencepiece_trie, spelling, subword_quality, warc,
)
from strata.llm.textvec import document_batches

Query = Callable[[SparkSession, str], DataFrame]


def _with_settings(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        document_batches(spark)
        return query(spark, sf_dir)
    return run


REGISTRY: dict[str, Query] = {name: _with_settings(query) for name, query in {
    "op1_js_divergence": quality_rules.op1_js_divergence,
    "op2_shared_prefix_viterbi": sentencepiece_trie.op2_shared_prefix_viterbi,
    "op3_probminhash": near_dup.op3_probminhash,
    "op4_zstd_dictionaries": compress_lang.op4_zstd_dictionaries,
    "op5_chunked_records": warc.op5_chunked_records,
    "op6_suffix_automaton": decontaminate.op6_suffix_automaton,
    "op7_subword_embeddings": subword_quality.op7_subword_embeddings,
    "op8_prefix_target": chat.op8_prefix_target,
    "op9_line_minhash": line_dedup.op9_line_minhash,
    "op10_cumulative_link": ordinal_toxicity.op10_cumulative_link,
    "op11_blocked_gram": spelling.op11_blocked_gram,
    "op12_grammar_inference": secrets_grammar.op12_grammar_inference,
    "op13_pointer_jumping": merkle.op13_pointer_jumping,
}.items()}
SQL = {
    "op5_chunked_records": warc.OP5_SQL,
    "op6_suffix_automaton": decontaminate.OP6_SQL,
    "op8_prefix_target": chat.OP8_SQL,
    "op11_blocked_gram": spelling.OP11_SQL,
    "op13_pointer_jumping": merkle.OP13_SQL,
}

"""The registered queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reelspark.llm import bpe, decontaminate, hamming_topk, html_text, language_id, order_minhash, phrase_mining, pii, quality_fm, ranked_search, sharding, token_store, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hamming_topk": hamming_topk.op1_hamming_topk,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_byte_bpe": bpe.op3_byte_bpe,
    "op4_quality_fm": quality_fm.op4_quality_fm,
    "op5_shard_lookup": sharding.op5_shard_lookup,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_token_store": token_store.op7_token_store,
    "op8_order_minhash": order_minhash.op8_order_minhash,
    "op9_language_id": language_id.op9_language_id,
    "op10_pii": pii.op10_pii,
    "op11_html_extraction": html_text.op11_html_extraction,
    "op12_phrase_collocations": phrase_mining.op12_phrase_collocations,
    "op13_ranked_search": ranked_search.op13_ranked_search,
}

ORACLE_SQL: dict[str, str] = {
    "op1_hamming_topk": hamming_topk.OP1_SQL,
    "op2_decontaminate": decontaminate.OP2_SQL,
    "op5_shard_lookup": sharding.OP5_SQL,
    "op12_phrase_collocations": phrase_mining.OP12_SQL,
    "op13_ranked_search": ranked_search.OP13_SQL,
}

"""The registered queries of the numbered operators and the pipeline, with their SQL."""

from __future__ import annotations

from vigilo.llm import (
    bpe, chat, embedding_dedup, hnsw, language_model, lexical, minhash_dedup, mixing, quality, spelling, suffix_dedup, toxicity, url_filter,
)

QUERIES = {
    "op1_embedding_dedup": embedding_dedup.op1_embedding_dedup,
    "op10_nearest": hnsw.op10_nearest,
    "op11_quality": quality.op11_quality,
    "op12_spelling": spelling.op12_spelling,
    "op13_lexical": lexical.op13_lexical,
    "op2_minhash_dedup": minhash_dedup.op2_minhash_dedup,
    "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
    "op4_mix_sources": mixing.op4_mix_sources,
    "op5_bpe": bpe.op5_bpe,
    "op6_chat_format": chat.op6_chat_format,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_language_model": language_model.op8_language_model,
    "op9_url_filter": url_filter.op9_url_filter,
}
ORACLE = {
    "op1_embedding_dedup": embedding_dedup.OP1_SQL,
    "op12_spelling": spelling.OP12_SQL,
    "op13_lexical": lexical.OP13_SQL,
    "op6_chat_format": chat.OP6_SQL,
    "op9_url_filter": url_filter.OP9_SQL,
}

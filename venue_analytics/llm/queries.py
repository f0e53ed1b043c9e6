"""Registered queries of this subpackage and their DuckDB oracles (where SQL expresses them)."""

from __future__ import annotations

from venue_analytics.llm import bpe, chat, decontaminate, divergence, embeddings, licenses, mixing, pii, prefixes, quality, simhash, tokenstore, warc

QUERIES = {
    "op1_warc": warc.op1_warc,
    "op2_chat": chat.op2_chat,
    "op3_mixing": mixing.op3_mixing,
    "op4_bpe": bpe.op4_bpe,
    "op5_pii": pii.op5_pii,
    "op6_licenses": licenses.op6_licenses,
    "op7_simhash": simhash.op7_simhash,
    "op8_tokens": tokenstore.op8_tokens,
    "op9_embeddings": embeddings.op9_embeddings,
    "op10_quality": quality.op10_quality,
    "op11_divergence": divergence.op11_divergence,
    "op12_decontamination": decontaminate.op12_decontamination,
    "op13_trie": prefixes.op13_trie,
}

ORACLE_SQL = {
    "op1_warc": warc.OP1_SQL,
    "op2_chat": chat.OP2_SQL,
    "op10_quality": quality.OP10_SQL,
    "op11_divergence": divergence.OP11_SQL,
    "op12_decontamination": decontaminate.OP12_SQL,
    "op13_trie": prefixes.OP13_SQL,
}

"""Queries of the numbered operators, and the SQL of those that SQL can express."""

from functools import wraps

from labelweave.llm import (
    chat, hnsw, langid, mixing, order_minhash, packing, quality, token_counts, toxicity, trie_join, turn_trie,
    vector_codes, warc)
from labelweave.session import ship_package


def _shipped(query):
    @wraps(query)
    def run(spark, sf_dir):
        ship_package(spark)
        return query(spark, sf_dir)
    return run


QUERIES = {
    "op1_token_counts": token_counts.op1_token_counts,
    "op2_warc_salvage": warc.op2_warc_salvage,
    "op3_preference_formatting": chat.op3_preference_formatting,
    "op4_best_fit_packing": packing.op4_best_fit_packing,
    "op5_order_minhash": order_minhash.op5_order_minhash,
    "op6_quality_rules": quality.op6_quality_rules,
    "op7_mixing": mixing.op7_mixing,
    "op8_hnsw": hnsw.op8_hnsw,
    "op9_language_id": langid.op9_language_id,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_trie_join": trie_join.op11_trie_join,
    "op12_vector_codes": vector_codes.op12_vector_codes,
    "op13_turn_trie": turn_trie.op13_turn_trie,
}
QUERIES = {name: _shipped(query) for name, query in QUERIES.items()}

ORACLES = {
    "op2_warc_salvage": warc.ORACLE,
    "op3_preference_formatting": chat.ORACLE,
    "op6_quality_rules": quality.ORACLE,
    "op7_mixing": mixing.ORACLE,
    "op11_trie_join": trie_join.ORACLE,
    "op12_vector_codes": vector_codes.ORACLE,
    "op13_turn_trie": turn_trie.ORACLE,
}

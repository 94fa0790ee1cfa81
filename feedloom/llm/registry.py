"""Corpus queries by name, and their SQL."""

from __future__ import annotations

from feedloom.llm import forest, language, minhash, mixing, negatives, packing, phrases, quality, repeats, topk, toxicity, warc, wordpiece

QUERIES = {
    "op1_warc": warc.op1,
    "op2_token_counts": wordpiece.op2,
    "op3_quality": quality.op3,
    "op4_mixing": mixing.op4,
    "op5_toxicity": toxicity.op5,
    "op6_near_vectors": forest.op6,
    "op7_language": language.op7,
    "op8_near_duplicates": minhash.op8,
    "op9_top_k": topk.op9,
    "op10_packing": packing.op10,
    "op11_collocations": phrases.op11,
    "op12_repeats": repeats.op12,
    "op13_hard_negatives": negatives.op13,
}

ORACLES: dict[str, str] = {
    "op1_warc": warc.SQL,
    "op4_mixing": mixing.SQL,
    "op6_near_vectors": forest.SQL,
    "op8_near_duplicates": minhash.SQL,
    "op9_top_k": topk.SQL,
    "op11_collocations": phrases.SQL,
    "op13_hard_negatives": negatives.SQL,
}

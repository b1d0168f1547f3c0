"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from corpusops.llm import (
    boilerplate, byte_bpe, dedup_minmax, merkle, mixing, parsing, quality, recompress, secrets, sentencepieces, sharding, toxicity, whitening,
)

QUERIES = {
    "op1_secret_scans": secrets.op1,
    "op2_substring_dedup": recompress.op2,
    "op3_minhash_near_dedup": dedup_minmax.op3,
    "op4_document_fingerprints": parsing.op4,
    "op5_sharding": sharding.op5,
    "op6_html_extraction": boilerplate.op6,
    "op7_toxicity": toxicity.op7,
    "op8_sentencepiece": sentencepieces.op8,
    "op9_mixing": mixing.op9,
    "op10_quality_rules": quality.op10,
    "op11_embedding_whitening": whitening.op11,
    "op12_merkle_manifest": merkle.op12,
    "op13_byte_bpe": byte_bpe.op13,
}
SQL = {"op1_secret_scans": secrets.SQL, "op10_quality_rules": quality.SQL, "op12_merkle_manifest": merkle.SQL}

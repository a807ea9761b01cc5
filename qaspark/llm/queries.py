"""The contract queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from qaspark.llm import (
    bpe,
    conversations,
    decontaminate,
    language_model,
    licenses,
    lines,
    merkle,
    minhash,
    permutation_index,
    quality,
    simhash,
    suffix,
    toxicity,
)

QUERIES = {
    "op1_suffix_dedup": suffix.op1_suffix_dedup,
    "op2_permutation_index": permutation_index.op2_permutation_index,
    "op3_benchmark_decontamination": decontaminate.op3_benchmark_decontamination,
    "op4_license_scan": licenses.op4_license_scan,
    "op5_line_dedup": lines.op5_line_dedup,
    "op6_byte_bpe": bpe.op6_byte_bpe,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_quality_cnn": quality.op8_quality_cnn,
    "op9_simhash_golay": simhash.op9_simhash_golay,
    "op10_language_model": language_model.op10_language_model,
    "op11_minhash": minhash.op11_minhash,
    "op12_conversation_repair": conversations.op12_conversation_repair,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}

SQL: dict[str, str] = {
    "op1_suffix_dedup": suffix.OP1_SQL,
    "op3_benchmark_decontamination": decontaminate.OP3_SQL,
    "op5_line_dedup": lines.OP5_SQL,
    "op12_conversation_repair": conversations.OP12_SQL,
    "op13_merkle_manifest": merkle.OP13_SQL,
}

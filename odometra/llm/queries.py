"""Registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, decontam, exactdup, hardneg, html_text, langid, linedup, merkle, mixing, neardup, pii, quality, tokens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": pii.op1_pii,
    "op2_minhash_neardup": neardup.op2_minhash_neardup,
    "op3_token_counts": tokens.op3_token_counts,
    "op4_benchmark_decontamination": decontam.op4_benchmark_decontamination,
    "op5_language_id": langid.op5_language_id,
    "op6_html_text": html_text.op6_html_text,
    "op7_mix_sources": mixing.op7_mix_sources,
    "op8_exact_dedup": exactdup.op8_exact_dedup,
    "op9_line_dedup": linedup.op9_line_dedup,
    "op10_chat_format": chat.op10_chat_format,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_quality_classifier": quality.op12_quality_classifier,
    "op13_hard_negatives": hardneg.op13_hard_negatives,
}

ORACLES: dict[str, str] = {
    "op2_minhash_neardup": neardup.ORACLE,
    "op7_mix_sources": mixing.ORACLE,
    "op8_exact_dedup": exactdup.ORACLE,
    "op10_chat_format": chat.ORACLE,
    "op11_merkle_manifest": merkle.ORACLE,
    "op13_hard_negatives": hardneg.ORACLE,
}

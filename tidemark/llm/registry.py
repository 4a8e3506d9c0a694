"""Queries of this subpackage: ``QUERIES`` (name -> callable) and ``ORACLE_SQL``."""

from __future__ import annotations

from tidemark.llm import (
    decontam,
    divergence,
    exact_dedup,
    hard_negatives,
    licenses,
    ngram_join,
    packing,
    quality,
    repeats,
    secrets,
    sharding,
    tokenfiles,
    toxicity,
)

QUERIES = {
    "op1_license_scan": licenses.op1_license_scan,
    "op2_packing": packing.op2_packing,
    "op3_token_files": tokenfiles.op3_token_files,
    "op4_ngram_join": ngram_join.op4_ngram_join,
    "op6_decontamination": decontam.op6_decontamination,
    "op5_secret_scan": secrets.op5_secret_scan,
    "op7_repeats": repeats.op7_repeats,
    "op8_sharding": sharding.op8_sharding,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_source_divergence": divergence.op12_source_divergence,
    "op13_quality": quality.op13_quality,
}

ORACLE_SQL = {
    "op4_ngram_join": ngram_join.ORACLE,
    "op10_exact_dedup": exact_dedup.ORACLE,
    "op11_hard_negatives": hard_negatives.ORACLE,
    "op12_source_divergence": divergence.ORACLE,
}

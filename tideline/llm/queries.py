"""Queries of this folder, for the driver's entry module."""

from tideline.llm import (divergence_rules, importance_resampling, language_id, license_scan, parity_join, pii_sanitise, quality_classifier,
                          sentencepiece_codec, substring_dedup, url_filter, vector_codes, warc)
from tideline.llm.decontaminate import op1_benchmark_decontamination

QUERIES = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_url_filter": url_filter.op2_url_filter,
    "op3_ngram_jaccard_join": parity_join.op3_ngram_jaccard_join,
    "op4_pii_sanitisation": pii_sanitise.op4_pii_sanitisation,
    "op5_quality_rules": divergence_rules.op5_quality_rules,
    "op6_quality_classifier": quality_classifier.op6_quality_classifier,
    "op7_warc": warc.op7_warc,
    "op8_language_id": language_id.op8_language_id,
    "op9_sentencepiece": sentencepiece_codec.op9_sentencepiece,
    "op10_license_scan": license_scan.op10_license_scan,
    "op11_importance_resampling": importance_resampling.op11_importance_resampling,
    "op12_vector_codes": vector_codes.op12_vector_codes,
    "op13_substring_dedup": substring_dedup.op13_substring_dedup,
    "pages_language_id": language_id.pages_language_id,
}

ORACLE_SQL: dict[str, str] = {
    "op2_url_filter": url_filter.ORACLE_SQL,
    "op3_ngram_jaccard_join": parity_join.ORACLE_SQL,
    "op11_importance_resampling": importance_resampling.ORACLE_SQL,
    "op12_vector_codes": vector_codes.ORACLE_SQL,
    "op13_substring_dedup": substring_dedup.ORACLE_SQL,
}

"""The registered query of each operator and, where SQL can express it, its check."""

from millrace.llm import conversation, decontamination, language_id, lexical_search, lm_scoring, near_dedup, quality, secret_scan, sentencepiece_codec, sharding, substring_dedup, toxicity, warc

QUERIES = {
    "op1_substring_dedup": substring_dedup.query,
    "op2_toxicity": toxicity.query,
    "op3_decontamination": decontamination.query,
    "op4_warc": warc.query,
    "op5_near_dedup": near_dedup.query,
    "op6_sentencepiece": sentencepiece_codec.query,
    "op7_lm_scoring": lm_scoring.query,
    "op8_quality_rules": quality.query,
    "op9_secret_scans": secret_scan.query,
    "op10_language_id": language_id.query,
    "op11_conversation_repair": conversation.query,
    "op12_lexical_search": lexical_search.query,
    "op13_sharding": sharding.query,
}
ORACLES = {
    "op1_substring_dedup": substring_dedup.SQL,
    "op3_decontamination": decontamination.SQL,
    "op4_warc": warc.SQL,
    "op8_quality_rules": quality.SQL,
    "op9_secret_scans": secret_scan.SQL,
    "op11_conversation_repair": conversation.SQL,
    "op12_lexical_search": lexical_search.SQL,
    "op13_sharding": sharding.SQL,
}

"""The queries of this subpackage by name, and the SQL counterparts of those that have one."""

from __future__ import annotations

from hourtally.llm import (
    decontamination,
    embedding_whitening,
    language_id,
    licenses,
    mixing,
    near_duplicates,
    quality_classifier,
    quality_rules,
    secret_ledger,
    source_divergence,
    substring_dedup,
    toxicity,
    url_filter,
)

QUERIES = {
    query.__name__: query
    for query in (
        near_duplicates.op1_near_duplicates,
        quality_rules.op2_quality_rules,
        url_filter.op3_url_filter,
        quality_classifier.op4_quality_classifier,
        mixing.op5_mixing,
        language_id.op6_language_id,
        decontamination.op7_decontamination,
        licenses.op8_license_scan,
        substring_dedup.op9_substring_dedup,
        toxicity.op10_toxicity,
        embedding_whitening.op11_embedding_whitening,
        source_divergence.op12_source_divergence,
        secret_ledger.op13_secret_scan,
    )
}

ORACLE_SQL = {
    "op3_url_filter": url_filter.OP3_SQL,
    "op8_license_scan": licenses.OP8_SQL,
    "op12_source_divergence": source_divergence.OP12_SQL,
    "op13_secret_scan": secret_ledger.OP13_SQL,
}

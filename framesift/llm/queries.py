"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from framesift.llm import (
    centroids, decontaminate, divergence, jaccard, language, mixture, quality, rollup, scoring, search, secrets,
    sketches, slots,
)

QUERIES = {
    query.__name__: query
    for query in (
        scoring.op1_lm_scoring,
        secrets.op2_secret_scan,
        decontaminate.op3_benchmark_decontamination,
        language.op4_language_id,
        mixture.op5_source_mixture,
        slots.op6_token_slots,
        search.op7_top_k_search,
        rollup.op8_token_rollup,
        jaccard.op9_jaccard_join,
        quality.op10_quality_classifier,
        sketches.op11_near_duplicates,
        centroids.op12_centroid_clustering,
        divergence.op13_source_divergence,
    )
}

ORACLE_SQL = {
    "op1_lm_scoring": scoring.OP1_SQL,
    "op3_benchmark_decontamination": decontaminate.OP3_SQL,
    "op7_top_k_search": search.OP7_SQL,
    "op8_token_rollup": rollup.OP8_SQL,
    "op9_jaccard_join": jaccard.OP9_SQL,
    "op11_near_duplicates": sketches.OP11_SQL,
    "op12_centroid_clustering": centroids.OP12_SQL,
    "op13_source_divergence": divergence.OP13_SQL,
}

#: Queries of the same operators beside the numbered ones.
MORE = {"lm_scoring_all_words": scoring.lm_scoring_all_words}
MORE_SQL = {"lm_scoring_all_words": scoring.ALL_WORDS_SQL}

"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from recflow.llm import (decontaminate, hard_negatives, inner_products, maxent_lm, merkle_log,
                         mixing, ngram_join, quality_rules, secret_scan, sentence_spans, sharding, toxicity, url_filter)

QUERIES = {
    "op1_url_filter": url_filter.op1_url_filter,
    "op2_secret_scan": secret_scan.op2_secret_scan,
    "op3_mixing": mixing.op3_mixing,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_sentence_spans": sentence_spans.op5_sentence_spans,
    "op6_ngram_jaccard_join": ngram_join.op6_ngram_jaccard_join,
    "op7_decontamination": decontaminate.op7_decontamination,
    "op8_maxent_lm": maxent_lm.op8_maxent_lm,
    "op9_quality_rules": quality_rules.op9_quality_rules,
    "op10_sharding": sharding.op10_sharding,
    "op11_merkle_manifest": merkle_log.op11_merkle_manifest,
    "op12_topk_search": inner_products.op12_topk_search,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}

#: Only where SQL expresses the whole query; the others are tested against
#: brute force in tests/llm.
ORACLE = {"op1_url_filter": url_filter.ORACLE, "op7_decontamination": decontaminate.ORACLE,
          "op11_merkle_manifest": merkle_log.ORACLE,
          "op12_topk_search": inner_products.ORACLE,
          "op13_hard_negatives": hard_negatives.ORACLE}

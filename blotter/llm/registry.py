"""Query name -> Spark query, and -> oracle SQL where SQL expresses it."""

from __future__ import annotations

from blotter.llm import (
    block_anchors, bpe, edit_fingerprint, hard_negatives, mixing, periodic_runs, quality_rules, rule_ensemble, sharding,
    simhash, suffix_array, token_store, url_filter)

QUERIES = {
    "op1_byte_bpe": bpe.query,
    "op2_edit_fingerprint": edit_fingerprint.query,
    "op3_token_files": token_store.query,
    "op4_simhash": simhash.query,
    "op5_quality_rules": quality_rules.query,
    "op6_source_mixing": mixing.query,
    "op7_url_filter": url_filter.query,
    "op8_block_anchors": block_anchors.query,
    "op9_slot_sharding": sharding.query,
    "op10_suffix_array": suffix_array.query,
    "op11_rule_ensemble": rule_ensemble.query,
    "op12_periodic_runs": periodic_runs.query,
    "op13_hard_negatives": hard_negatives.query,
}
ORACLE = {
    "op5_quality_rules": quality_rules.SQL,
    "op7_url_filter": url_filter.SQL,
    "op8_block_anchors": block_anchors.SQL,
    "op13_hard_negatives": hard_negatives.SQL,
}

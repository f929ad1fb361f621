"""The queries of this subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from ortholake.llm import (bpe, cotrain, lattice, lexical_search, license_rules, mixing, odd_sketch, preferences, quality_rules, quotient_filter, site_style,
                           turn_repair, warc)

QUERIES = {
    "op1_cotrain": cotrain.op1_cotrain,
    "op2_odd_sketch": odd_sketch.op2_odd_sketch,
    "op3_lattice": lattice.op3_lattice,
    "op4_license_rules": license_rules.op4_license_rules,
    "op5_preferences": preferences.op5_preferences,
    "op6_quality_rules": quality_rules.op6_quality_rules,
    "op7_byte_bpe": bpe.op7_byte_bpe,
    "op8_site_style": site_style.op8_site_style,
    "op9_mixing": mixing.op9_mixing,
    "op10_warc": warc.op10_warc,
    "op11_hybrid_search": lexical_search.op11_hybrid_search,
    "op12_turn_repair": turn_repair.op12_turn_repair,
    "op13_quotient_filter": quotient_filter.op13_quotient_filter,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op2_odd_sketch": odd_sketch.ORACLE_SQL,
    "op3_lattice": lattice.ORACLE_SQL,
    "op5_preferences": preferences.ORACLE_SQL,
    "op9_mixing": mixing.ORACLE_SQL,
    "op11_hybrid_search": lexical_search.ORACLE_SQL,
    "op13_quotient_filter": quotient_filter.ORACLE_SQL,
}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL

"""Registered queries of the subpackage: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from martwright.llm import fim, licenses, mixing, oracles, urls
from martwright.llm.dac import op3_directly_addressable_codes
from martwright.llm.fingerprints import op10_order_minhash
from martwright.llm.jaccard import op5_ngram_jaccard_join
from martwright.llm.packing import op7_packing
from martwright.llm.quality import op9_quality_rules
from martwright.llm.secrets import op6_secret_scans
from martwright.llm.sharding import op8_sharding
from martwright.llm.spelling import op11_spelling_variants
from martwright.llm.toxicity import op1_toxicity_gru

QUERIES = {
    "op1_toxicity_gru": op1_toxicity_gru,
    "op2_mixing_sources": mixing.op2_mixing_sources,
    "op3_directly_addressable_codes": op3_directly_addressable_codes,
    "op4_license_scans": licenses.op4_license_scans,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_secret_scans": op6_secret_scans,
    "op7_packing": op7_packing,
    "op8_sharding": op8_sharding,
    "op9_quality_rules": op9_quality_rules,
    "op10_order_minhash": op10_order_minhash,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_fill_in_middle": fim.op12_fill_in_middle,
    "op13_url_filters": urls.op13_url_filters,
}

#: DuckDB SQL of those that SQL can express on whole tables.
ORACLES: dict[str, str] = {
    "op2_mixing_sources": mixing.ORACLE,
    "op4_license_scans": licenses.ORACLE,
    "op5_ngram_jaccard_join": oracles.JACCARD,
    "op9_quality_rules": oracles.QUALITY,
    "op12_fill_in_middle": fim.ORACLE,
    "op13_url_filters": urls.ORACLE,
}

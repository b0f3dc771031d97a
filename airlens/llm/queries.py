"""Registered queries of the corpus operators and their DuckDB twins."""
from __future__ import annotations

from airlens.llm.alignment import op13_tokenizer_alignment
from airlens.llm.exact_dedup import OP7_SQL, op7_exact_dedup
from airlens.llm.html_text import op2_html_extract
from airlens.llm.licenses import op1_license_scan
from airlens.llm.mixing import OP9_SQL, op9_source_mix
from airlens.llm.near_dedup import OP6_SQL, op6_minhash_dedup
from airlens.llm.neighbours import op12_nearest_neighbours
from airlens.llm.orchard import OP11_SQL, op11_centroid_clusters
from airlens.llm.packing import op10_packing
from airlens.llm.quality import OP5_SQL, op5_quality_rules
from airlens.llm.token_edits import op3_token_edits
from airlens.llm.toxicity import op4_toxicity
from airlens.llm.urls import op8_url_filter

QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_html_extract": op2_html_extract,
    "op3_token_edits": op3_token_edits,
    "op4_toxicity": op4_toxicity,
    "op5_quality_rules": op5_quality_rules,
    "op6_minhash_dedup": op6_minhash_dedup,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_url_filter": op8_url_filter,
    "op9_source_mix": op9_source_mix,
    "op10_packing": op10_packing,
    "op11_centroid_clusters": op11_centroid_clusters,
    "op12_nearest_neighbours": op12_nearest_neighbours,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}
ORACLES = {
    "op5_quality_rules": OP5_SQL,
    "op6_minhash_dedup": OP6_SQL,
    "op7_exact_dedup": OP7_SQL,
    "op9_source_mix": OP9_SQL,
    "op11_centroid_clusters": OP11_SQL,
}

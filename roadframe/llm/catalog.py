"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from roadframe.llm import dialogues, licenses, phrases
from roadframe.llm.coding import op5_tokens
from roadframe.llm.dedup import op2_minhash
from roadframe.llm.dialogues import op13_prefixes
from roadframe.llm.extraction import op7_extraction
from roadframe.llm.licenses import op9_licenses
from roadframe.llm.mixing import op4_mixing
from roadframe.llm.neighbours import op8_neighbours
from roadframe.llm.packing import op1_packing
from roadframe.llm.phrases import op11_phrases
from roadframe.llm.privacy import op12_private
from roadframe.llm.quality import op10_quality
from roadframe.llm.sharding import op3_sharding
from roadframe.llm.spots import op6_fingerprints

QUERIES = {
    "op1_packing": op1_packing,
    "op2_minhash": op2_minhash,
    "op3_sharding": op3_sharding,
    "op4_mixing": op4_mixing,
    "op5_tokens": op5_tokens,
    "op6_fingerprints": op6_fingerprints,
    "op7_extraction": op7_extraction,
    "op8_neighbours": op8_neighbours,
    "op9_licenses": op9_licenses,
    "op10_quality": op10_quality,
    "op11_phrases": op11_phrases,
    "op12_private": op12_private,
    "op13_prefixes": op13_prefixes,
}

#: the other queries rest on hashes, fits or token ids, which SQL does not have
ORACLES: dict[str, str] = {"op9_licenses": licenses.oracle_sql(), "op11_phrases": phrases.oracle_sql(),
                           "op13_prefixes": dialogues.oracle_sql()}

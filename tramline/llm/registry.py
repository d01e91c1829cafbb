"""The training-data queries, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from tramline.llm.alignment import op12_token_alignment
from tramline.llm.bpe import op10_bpe
from tramline.llm.byte_bpe import op11_byte_bpe
from tramline.llm.mixing_model import op1_language_scores
from tramline.llm.mixture import op6_temperature_mixture
from tramline.llm.neighbours import op7_nearest_neighbours
from tramline.llm.phrases import op5_repeated_phrases
from tramline.llm.simhash import op3_simhash_near_dedup
from tramline.llm.substrings import op8_suffix_dedup
from tramline.llm.telephony import op2_telephony_media
from tramline.llm.token_files import OP4_SQL, op4_token_counts
from tramline.llm.toxicity import op9_toxicity
from tramline.llm.vector_codes import OP13_SQL, op13_vector_codes

QUERIES = {
    f.__name__: f
    for f in (
        op1_language_scores,
        op2_telephony_media,
        op3_simhash_near_dedup,
        op4_token_counts,
        op5_repeated_phrases,
        op6_temperature_mixture,
        op7_nearest_neighbours,
        op8_suffix_dedup,
        op9_toxicity,
        op10_bpe,
        op11_byte_bpe,
        op12_token_alignment,
        op13_vector_codes,
    )
}

ORACLES = {"op4_token_counts": OP4_SQL, "op13_vector_codes": OP13_SQL}

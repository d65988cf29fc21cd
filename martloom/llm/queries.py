"""The queries of this package and the SQL beside them."""

from __future__ import annotations

from martloom.llm.decontaminate import OP3_SQL, op3_decontaminate
from martloom.llm.exact_dedup import OP4_SQL, op4_exact_dedup
from martloom.llm.infill import OP11_SQL, op11_fill_in_middle
from martloom.llm.langid import op2_language_id
from martloom.llm.language_model import op8_language_model
from martloom.llm.licenses import op7_licenses
from martloom.llm.mixing import OP6_SQL, op6_mix_sources
from martloom.llm.quality import op13_quality
from martloom.llm.secrets import op1_secrets
from martloom.llm.simhash import op10_simhash
from martloom.llm.spelling import op12_spelling_variants
from martloom.llm.substring_dedup import op5_substring_dedup
from martloom.llm.toxicity import op9_toxicity

QUERIES = {
    f.__name__: f
    for f in (
        op1_secrets, op2_language_id, op3_decontaminate, op4_exact_dedup, op5_substring_dedup, op6_mix_sources, op7_licenses,
        op8_language_model, op9_toxicity, op10_simhash, op11_fill_in_middle,
        op12_spelling_variants, op13_quality,
    )
}

ORACLE = {
    "op3_decontaminate": OP3_SQL,
    "op4_exact_dedup": OP4_SQL,
    "op6_mix_sources": OP6_SQL,
    "op11_fill_in_middle": OP11_SQL,
}

"""The operators' queries and their DuckDB SQL."""

from __future__ import annotations

from faresight.llm import alignment, bpe, chat, decontamination, language, lm, neardup, packing, quality, resampling, search, secrets, substring

QUERIES = {
    "op1_search": search.op1_search,
    "op2_packing": packing.op2_packing,
    "op3_language": language.op3_language,
    "op4_quality": quality.op4_quality,
    "op5_near_duplicates": neardup.op5_near_duplicates,
    "op6_substring": substring.op6_substring,
    "op7_secrets": secrets.op7_secrets,
    "op8_bpe": bpe.op8_bpe,
    "op9_lm": lm.op9_lm,
    "op10_chat_formatting": chat.op10_chat_formatting,
    "op11_decontamination": decontamination.op11_decontamination,
    "op12_alignment": alignment.op12_alignment,
    "op13_resampling": resampling.op13_resampling,
}

ORACLE = {"op1_search": search.ORACLE_SQL, "op10_chat_formatting": chat.ORACLE_SQL, "op11_decontamination": decontamination.ORACLE_SQL,
          "op13_resampling": resampling.ORACLE_SQL}

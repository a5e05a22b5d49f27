"""The contract queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from basketry.llm import op01_bpe, op02_langid, op03_near, op04_pii, op05_toxic, op06_exact, op07_contain, op08_warc, op09_quality, op10_license, op11_bpa, op12_repair, op13_lines

QUERIES: dict[str, Callable] = {
    "op1_byte_bpe": op01_bpe.op1_byte_bpe,
    "op2_language_id": op02_langid.op2_language_id,
    "op3_minhash_near": op03_near.op3_minhash_near,
    "op4_pii_pseudonyms": op04_pii.op4_pii_pseudonyms,
    "op5_toxicity": op05_toxic.op5_toxicity,
    "op6_exact_dedup": op06_exact.op6_exact_dedup,
    "op7_decontaminate": op07_contain.op7_decontaminate,
    "op8_warc": op08_warc.op8_warc,
    "op9_quality": op09_quality.op9_quality,
    "op10_license_scan": op10_license.op10_license_scan,
    "op11_ranked_search": op11_bpa.op11_ranked_search,
    "op12_conversation_repair": op12_repair.op12_conversation_repair,
    "op13_line_dedup": op13_lines.op13_line_dedup,
}

SQL: dict[str, str] = {
    "op3_minhash_near": op03_near.ORACLE,
    "op6_exact_dedup": op06_exact.ORACLE,
    "op7_decontaminate": op07_contain.ORACLE,
    "op8_warc": op08_warc.ORACLE,
    "op11_ranked_search": op11_bpa.ORACLE,
    "op12_conversation_repair": op12_repair.ORACLE,
    "op13_line_dedup": op13_lines.ORACLE,
}


def llm_queries() -> dict[str, Callable]:
    return dict(QUERIES)


def llm_sql() -> dict[str, str]:
    return dict(SQL)

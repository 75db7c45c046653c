"""The queries of the numbered operators, by name."""

from importlib import import_module

MODULES = ("op1_suffix_dedup", "op2_sharding", "op3_language", "op4_quality", "op5_decontamination", "op6_bpe", "op7_jaccard", "op8_lm", "op9_ann", "op10_toxicity", "op11_spelling", "op12_token_files", "op13_fim")


def queries() -> dict:
    return {k: f for name in MODULES for k, f in import_module(f"cinderline.llm.{name}").QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for name in MODULES for k, sql in import_module(f"cinderline.llm.{name}").ORACLE.items()}

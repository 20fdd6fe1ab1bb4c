"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

import importlib

from . import fields

#: Query name: module with query(spark, sf_dir) and perhaps ORACLE_SQL.
MODULES = {
    "op1_mixing": "mixing",
    "op2_fingerprints": "fingerprints",
    "op3_token_counts": "token_counts",
    "op4_near_dedup": "near_dedup",
    "op5_toxicity": "toxicity",
    "op6_topk": "topk",
    "op7_packing": "packing",
    "op8_lm_scoring": "lm",
    "op9_pii": "pii",
    "op10_line_dedup": "line_dedup",
    "op11_lexical_search": "lexical",
    "op12_vector_codes": "codebooks",
    "op13_ngram_join": "ngram_join",
}


def _modules():
    return {name: importlib.import_module(f"{__package__}.{module}") for name, module in MODULES.items()}


def queries() -> dict:
    return {name: module.query for name, module in _modules().items()} | {q.__name__: q for q in fields.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {name: module.ORACLE_SQL for name, module in _modules().items() if getattr(module, "ORACLE_SQL", None)} | fields.SQL

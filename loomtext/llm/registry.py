"""Queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from importlib import import_module

#: Query name: module that defines a function of that name.
QUERIES = {
    "op1_sharding": "sharding",
    "op10_mixing": "mixing",
    "op6_prefix_free_parsing": "repeats",
    "op9_superminhash": "superminhash",
    "op2_quality": "quality",
    "op4_packing": "packing",
    "op3_token_files": "tokenfiles",
    "op8_media": "media",
    "op7_licenses": "licenses",
    "op5_fingerprints": "fingerprints",
    "op11_conversation_repair": "conversations",
    "op12_toxicity": "toxicity",
    "op13_filter_audit": "filteraudit",
}


def queries() -> dict:
    return {name: getattr(import_module(f"{__package__}.{module}"), name) for name, module in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    from .oracles import ORACLES

    return {name: sql for name, sql in ORACLES.items() if name in QUERIES}

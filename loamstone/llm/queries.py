"""The queries of the llm subpackage, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from importlib import import_module

MODULES = ("residue", "lines", "language", "pii", "batches", "furniture", "repetition", "packing", "leakage", "structure")


def queries() -> dict:
    """Every function named pN_... of the operator modules."""
    out = {}
    for name in MODULES:
        try:
            module = import_module(f"loamstone.llm.{name}")
        except ModuleNotFoundError as e:
            if e.name != f"loamstone.llm.{name}":
                raise
            continue
        out |= {k: v for k, v in vars(module).items() if k[0] == "p" and k[1:].split("_")[0].isdigit() and callable(v)}
    return out


def oracle_sql() -> dict[str, str]:
    """DuckDB statements of the queries that plain SQL can state over whole tables."""
    from loamstone.llm.sql import SQL

    return SQL

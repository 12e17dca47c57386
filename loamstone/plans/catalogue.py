"""All core queries by name, with the SQL that states the same for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MODULES: tuple[str, ...] = ("loamstone.plans.texts", "loamstone.plans.features", "loamstone.plans.similar", "loamstone.plans.mixture", "loamstone.plans.safety", "loamstone.plans.evaluate", "loamstone.plans.cleaning", "loamstone.plans.signals", "loamstone.plans.sections", "loamstone.plans.pipeline", "loamstone.plans.evidence", "loamstone.plans.decisions", "loamstone.plans.rights", "loamstone.plans.languages", "loamstone.plans.gates", "loamstone.plans.curation", "loamstone.plans.intel", "loamstone.plans.units")


def queries() -> dict:
    from importlib import import_module

    out: dict = {}
    for m in MODULES:
        out |= import_module(m).QUERIES
    return out


def oracle_sql() -> dict[str, str]:
    from importlib import import_module

    out: dict = {}
    for m in MODULES:
        out |= import_module(m).ORACLE
    return out


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loamstone.plans.pipeline import flagship as f

    return f(spark, sf_dir)

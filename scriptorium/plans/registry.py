"""One registry of named queries (Spark) and their DuckDB oracle SQL."""

from __future__ import annotations

import importlib

from pyspark.sql import DataFrame, SparkSession

_MODULES = (
    "corpus_queries",
    "catalog_queries",
    "merge_queries",
    "quality_queries",
    "tool_queries",
    "stream_queries",
)


def _mods():
    return [importlib.import_module(f"{__package__}.{m}") for m in _MODULES]


def all_queries() -> dict:
    out: dict = {}
    for m in _mods():
        out.update(m.QUERIES)
    return out


def all_oracles() -> dict:
    out: dict = {}
    for m in _mods():
        out.update(getattr(m, "ORACLES", {}))
    return out


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .corpus_queries import corpus_deciles

    return corpus_deciles(spark, sf_dir)

"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame that reads the driver's
tables (through the fixtures) in full. Oracles are independent SQL over the same tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Registered:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None
    operators: str  # SURVEY ids covered


REGISTRY: dict[str, Registered] = {}


def register(name: str, oracle: str | None, operators: str):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Registered(name, fn, oracle, operators)
        return fn
    return deco


def load_all() -> dict[str, Registered]:
    # Importing the modules registers their queries.
    from delaylens.plans import queries_core  # noqa: F401
    from delaylens.plans import queries_incremental  # noqa: F401
    from delaylens.plans import queries_ingest  # noqa: F401
    from delaylens.plans import queries_model  # noqa: F401
    from delaylens.plans import queries_quality  # noqa: F401
    from delaylens.plans import queries_stream  # noqa: F401
    return REGISTRY

"""Registry of named queries: each is (spark, sf_dir) -> DataFrame, with an
optional DuckDB oracle statement over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    name: str
    fn: QueryFn
    sql: str | None
    headline: bool = False


CATALOG: dict[str, Entry] = {}


def register(name: str, sql: str | None = None, headline: bool = False):
    def deco(fn: QueryFn) -> QueryFn:
        if name in CATALOG:
            raise ValueError(f"duplicate query {name}")
        CATALOG[name] = Entry(name, fn, sql, headline)
        return fn
    return deco


def load_all() -> dict[str, Entry]:
    # importing the modules fills CATALOG
    from . import (q_eval, q_features, q_ml, q_profile, q_stats,  # noqa: F401
                   q_stream, q_validate)
    return CATALOG

"""Registry of named queries and their ANSI SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from harmlens.plans import oracle
from harmlens.plans.tables import Tables, tables_for


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, same_as: str | None = None, **extra: str):
    """Register ``fn(tables) -> DataFrame`` under ``name``.

    ``sql`` is the equivalent query; ``extra`` names further tables it uses. ``same_as`` names a
    query that gives the same rows another way.
    """

    def register(fn: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(
            run=lambda spark, sf_dir: fn(tables_for(spark, sf_dir)),
            sql=REGISTRY[same_as].sql if same_as else oracle.complete(sql, extra) if sql else None,
        )
        return fn

    return register

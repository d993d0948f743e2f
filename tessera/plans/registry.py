"""Registry of driver queries: name -> (Spark callable, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql)
        return fn
    return deco

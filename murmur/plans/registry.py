"""Registry of the named queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from murmur.plans.views import DUCK_VIEWS, Tables
from murmur.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def duck(views: str, body: str) -> str:
    """Put the needed entity views in front of an oracle query."""
    parts, seen = [], set()

    def need(name: str) -> None:
        if name in seen:
            return
        requires, sql = DUCK_VIEWS[name]
        for other in requires.split():
            need(other)
        seen.add(name)
        parts.append(f"{name} AS (\n{sql.strip()}\n)")

    for view in views.split():
        need(view)
    body = body.strip()
    if body[:5].upper() == "WITH ":
        parts.append(body[5:])
        return "WITH " + ",\n".join(parts)
    return "WITH " + ",\n".join(parts) + "\n" + body if parts else body


def query(name: str, views: str = "", sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(configure(spark), sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = duck(views, sql)
        return fn

    return register

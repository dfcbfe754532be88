"""Collects the queries as their modules are imported."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from workload.roles import with_roles

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Build
    sql: str


QUERIES: dict[str, Query] = {}


def query(name: str, roles: tuple[str, ...], sql: str) -> Callable[[Build], Build]:
    """Register a query with the SQL that must give the same rows."""

    def add(build: Build) -> Build:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = Query(name, build, with_roles(roles, sql))
        return build

    return add

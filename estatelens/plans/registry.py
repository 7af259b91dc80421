"""Key -> (Spark query, oracle SQL) registry.

A Spark query is ``fn(spark, sf_dir) -> DataFrame`` over catalog roles
derived from the driver tables. The oracle is independent ANSI SQL over
``cat_<role>`` names; the role CTEs are prepended automatically.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from estatelens.sources.roles import ROLE_SQL, Roles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

_ROLE_REF = re.compile(r"\bcat_([a-z_]+)\b")


def with_roles(sql: str) -> str:
    """Prefix ``sql`` with CTEs for every ``cat_<role>`` it names."""
    names = []
    for n in _ROLE_REF.findall(sql):
        if n in ROLE_SQL and n not in names:
            names.append(n)
    ctes = [f"cat_{n} AS ({ROLE_SQL[n]})" for n in names]
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        rest = body[5:].lstrip()
        recursive = "RECURSIVE " if rest[:10].upper() == "RECURSIVE " else ""
        ctes.append(rest[len(recursive):])
        return f"WITH {recursive}" + ",\n".join(ctes)
    if not ctes:
        return body
    return "WITH " + ",\n".join(ctes) + "\n" + body


def register(key: str, oracle: str | None = None):
    """Decorator: ``fn(R: Roles) -> DataFrame`` registered under ``key``."""
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate key {key}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Roles(spark, sf_dir))
        run.__name__ = key
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if oracle is not None:
            ORACLE[key] = with_roles(oracle)
        return fn
    return deco


def load_all() -> None:
    """Import every query module so that its keys register."""
    from estatelens.plans import (  # noqa: F401
        q_capacity,
        q_health,
        q_security,
        health_report,
        q_features,
        q_partitions,
        q_objects,
        q_inventory,
        q_sources,
        q_editions,
        q_temporal,
        q_deltas,
        q_rollups,
    )

"""Registry of named queries (Spark side) and their DuckDB oracle SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.fixture_sql import FIXTURE_SQL

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with its oracle SQL.

    ``sql`` may name fixture tables (``trades``, ``sens_ir`` ...); their
    definitions are prepended as CTEs. Omit ``sql`` only for operators that
    SQL cannot express.
    """
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_fixtures(sql)
        return fn
    return deco


def with_fixtures(sql: str) -> str:
    """Prefix ``sql`` with the CTEs of every fixture table it names."""
    used = [n for n in FIXTURE_SQL if re.search(rf"\b{n}\b", sql)]
    if not used:
        return sql.strip()
    ctes = ",\n".join(f"{n} AS ({FIXTURE_SQL[n]})" for n in used)
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def r4(c) -> Column:
    """Amounts leave as ``round(x, 4)`` doubles (same rule in the oracle SQL)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 4).cast("double")


def ymd(c) -> Column:
    """Dates leave as ``yyyy-MM-dd`` text (oracle: ``strftime(x, '%Y-%m-%d')``)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd")


def ymdhms(c) -> Column:
    """Timestamps leave as ``yyyy-MM-dd HH:mm:ss`` text (oracle: ``strftime(x, '%Y-%m-%d %H:%M:%S')``)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")

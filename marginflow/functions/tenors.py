"""Tenor text -> days (D4, D5, D6) and label recoding.

All native expressions (regexp_extract / when / datediff): they stay inside
whole-stage codegen and never leave the JVM.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Days per tenor unit for pillar codes such as ``6M`` / ``M6``
# (d = day; w, s = week; m = month; y, a = year; either case).
PILLAR_UNIT_DAYS = {"d": 1, "w": 7, "s": 7, "m": 30, "y": 365, "a": 365}

# Days per unit for compound tenor codes such as ``1Y6M`` / ``2W``.
CODE_UNIT_DAYS = {"D": 1, "W": 7, "M": 30, "Y": 365}

# The surface label recoding applied before lookups.
DEFAULT_TENOR_RECODE = {"12M": "1Y"}


def _unit_days(unit: Column, table: dict[str, int]) -> Column:
    expr = None
    for u, days in table.items():
        expr = (F.when(unit == u, F.lit(days)) if expr is None
                else expr.when(unit == u, F.lit(days)))
    return expr


def pillar_days(c) -> Column:
    """``<n><unit>`` or ``<unit><n>`` (whole text) -> n * unit days; else null."""
    s = as_col(c)
    num_first = F.regexp_extract(s, r"^(\d+)([dwsmyaDWSMYA])$", 1)
    unit_first = F.regexp_extract(s, r"^([dwsmyaDWSMYA])(\d+)$", 2)
    number = F.when(num_first != "", num_first).when(unit_first != "", unit_first)
    unit = F.lower(F.when(num_first != "", F.regexp_extract(s, r"^(\d+)([dwsmyaDWSMYA])$", 2))
                   .when(unit_first != "", F.regexp_extract(s, r"^([dwsmyaDWSMYA])(\d+)$", 1)))
    return (number.try_cast("int") * _unit_days(unit, PILLAR_UNIT_DAYS)).cast("int")


def tenor_days(c, as_of, on_bad: int | None = -1) -> Column:
    """Maturity text -> days from ``as_of``.

    * 6 characters -> ``MMM yy`` (first of that month), absolute day gap
    * contains ``/`` -> ``dd/MM/yyyy``, absolute day gap
    * 2 or 3 characters -> pillar code (D6)
    * anything else -> ``on_bad`` (-1 by default: the first bucket downstream)

    Calendar ``datediff`` is used, so clock changes cannot lose a day.
    Unparseable text inside a recognised shape gives null (the reference fails).
    """
    s = as_col(c)
    if isinstance(as_of, (dt.date, str)):
        as_of_col = F.to_date(F.lit(str(as_of)))
    else:
        as_of_col = as_col(as_of)
    n = F.length(s)
    month_year = F.try_to_date(F.concat(F.lit("01 "), s), "dd MMM yy")
    full_date = F.try_to_date(s, "dd/MM/yyyy")
    bad = F.lit(on_bad).cast("int")
    return (
        F.when(n == 6, F.abs(F.datediff(month_year, as_of_col)))
        .when(s.contains("/"), F.abs(F.datediff(full_date, as_of_col)))
        .when((n == 2) | (n == 3), pillar_days(s))
        .when(s.isNotNull(), bad)
    ).cast("int")


def tenor_code_days(c) -> Column:
    """``nYmM`` -> 365 n + 30 m; otherwise ``<n><D|W|M|Y>`` -> n * unit days; else null."""
    s = as_col(c)
    years = F.regexp_extract(s, r"^(\d+)Y(\d+)M", 1)
    months = F.regexp_extract(s, r"^(\d+)Y(\d+)M", 2)
    compound = (s.contains("Y") & s.contains("M") & (F.length(s) >= 4))
    simple_n = F.regexp_extract(s, r"^(\d+)[DWMY]$", 1)
    simple_u = F.regexp_extract(s, r"^\d+([DWMY])$", 1)
    return (
        F.when(compound, F.when(years != "", years.cast("int") * 365 + months.cast("int") * 30))
        .when(simple_n != "", simple_n.cast("int") * _unit_days(simple_u, CODE_UNIT_DAYS))
    ).cast("int")


def recode(c, mapping: dict[str, str]) -> Column:
    """replace exact values per ``mapping`` (e.g. ``UDI -> MXV``, ``12M -> 1Y``)."""
    s = as_col(c)
    out = None
    for src, dst in mapping.items():
        out = F.when(s == src, F.lit(dst)) if out is None else out.when(s == src, F.lit(dst))
    return s if out is None else out.otherwise(s)

"""Row filters and predicates.

Single-pass predicates: where the reference split a frame, filtered twice and
re-unioned (F5), we keep one filter so the input is scanned once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._util import as_col



def in_scope(df: DataFrame, entity: str = "0182", source: str = "front3",
             entity_col: str = "entity", source_col: str = "source_system") -> DataFrame:
    """entity + source-system perimeter (a pushable equality pair)."""
    return df.where((F.col(entity_col) == entity) & (F.col(source_col) == source))


def trade_snapshot(df: DataFrame, app_col: str = "source_app", app: str = "FRONT",
                   flag_col: str | None = None, flag: str | None = None) -> DataFrame:
    """trades of the front-office application (optionally also a flag column)."""
    cond = F.col(app_col) == app
    if flag_col:
        cond = cond & (F.col(flag_col) == flag)
    return df.where(cond)


def pl_snapshot(df: DataFrame, value_col: str = "market_value") -> DataFrame:
    """P&L rows with a non-zero market value (null is dropped too)."""
    return df.where(F.col(value_col) != 0)


def nonzero(df: DataFrame, *cols: str, mode: str = "sum") -> DataFrame:
    """non-zero sensitivity.

    ``mode='sum'``: the sum of ``cols`` is non-zero (a null sum drops the row);
    ``mode='any'``: at least one of ``cols`` is non-zero.
    """
    if mode == "sum":
        total = None
        for c in cols:
            total = F.col(c) if total is None else total + F.col(c)
        return df.where(total != 0)
    if mode == "any":
        cond = None
        for c in cols:
            cond = (F.col(c) != 0) if cond is None else (cond | (F.col(c) != 0))
        return df.where(cond)
    raise ValueError(f"unknown mode {mode!r}")


def version_rule(df: DataFrame, key: Column | str, version_col: str = "version",
                 key_value: str = "IRD-CS-", required: str = "07") -> DataFrame:
    """rows whose product key equals ``key_value`` must carry version ``required``;
    other keys pass; a null key is dropped. One filter, one scan."""
    k = as_col(key)
    keep = (k.eqNullSafe(F.lit(key_value)) & F.col(version_col).eqNullSafe(F.lit(required))) \
        | (k != key_value)
    return df.where(keep)


def split_strategy(df: DataFrame, col: str = "strategy", pattern: str = "ST-%"):
    """(rows with a strategy like ``pattern``, rows without). Null is in neither."""
    s = F.col(col)
    return df.where(s.like(pattern)), df.where(~s.like(pattern))


def portfolio_perimeter(df: DataFrame, portfolio_col: str = "portfolio",
                        flag_col: str = "excluded", keep: str = "0",
                        out_col: str = "portfolio") -> DataFrame:
    """the distinct portfolios whose exclusion flag is ``keep``."""
    return df.where(F.col(flag_col) == keep).select(F.col(portfolio_col).alias(out_col)).distinct()


def split_model(df: DataFrame, col: str = "im_model", simm: str = "SIMM", schedule: str = "Schedule"):
    """(SIMM rows, Schedule rows) by null-safe equality."""
    m = F.col(col)
    return df.where(m.eqNullSafe(F.lit(simm))), df.where(m.eqNullSafe(F.lit(schedule)))


def in_period(df: DataFrame, ts_col: str, start, end, inclusive_end: bool = False) -> DataFrame:
    """load timestamps within a period; half-open by default (inclusive option)."""
    ts = F.col(ts_col)
    s = start if isinstance(start, Column) else F.lit(start)
    e = end if isinstance(end, Column) else F.lit(end)
    return df.where((ts >= s) & ((ts <= e) if inclusive_end else (ts < e)))


def has_rows(df: DataFrame) -> bool:
    """non-empty test (a single-row probe, not a count)."""
    return not df.isEmpty()

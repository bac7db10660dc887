from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def col_or(df, name: str | None, default) -> Column:
    """``df[name]`` when the frame has it, else a literal default (typed by caller)."""
    if name and name in df.columns:
        return F.col(name)
    return default if isinstance(default, Column) else F.lit(default)

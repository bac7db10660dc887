"""Duplicate removal and arg-max.

Survivors are chosen with ``min``/``max`` over a struct inside a ``groupBy``:
Spark aggregates partially on every map task before the shuffle, so a key
that holds a third of all rows is reduced to one row per task first and never
lands whole in one task (a ``row_number`` window would sort it in one task).
The struct order makes the survivor deterministic (a total order).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType


def dedup_by(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None,
             keep: str = "first") -> DataFrame:
    """One row per ``keys``; the survivor is the smallest (``keep='first'``)
    or largest (``'last'``) by ``order`` then every remaining column."""
    rest = [c for c in df.columns if c not in keys]
    order = list(order or [])
    tail = [c for c in rest if c not in order]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      *[F.col(c) for c in tail])
    agg = F.min(packed) if keep == "first" else F.max(packed)
    out = df.groupBy(*keys).agg(agg.alias("_row"))
    return out.select(*keys, *[F.col(f"_row.{c}") for c in tail],
                      *[F.col(f"_row._o{i}").alias(c) for i, c in enumerate(order)]).select(*df.columns)


def dedup_canonical(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Drop duplicate rows over every non-map column (maps cannot be compared).

    The reference keeps an arbitrary duplicate's map; we keep the one whose
    JSON form sorts first, so reruns give the same table. Partial aggregation
    collapses duplicates on each task before the shuffle.
    """
    maps = [f.name for f in df.schema.fields if isinstance(f.dataType, MapType)]
    keys = [c for c in df.columns if c not in maps and c not in exclude]
    if not maps:
        return df.dropDuplicates(keys)
    aggs = [F.min_by(F.col(m), F.to_json(F.col(m))).alias(m) for m in maps]
    return df.groupBy(*keys).agg(*aggs).select(*df.columns)


def dominant_row(df: DataFrame, key: str | Sequence[str], order_cols: Sequence[str],
                 value_cols: Sequence[str] = ()) -> DataFrame:
    """G1: per key, the row with the largest ``order_cols`` tuple (struct order,
    nulls lowest), returning the order and value columns."""
    keys = [key] if isinstance(key, str) else list(key)
    packed = F.struct(*[F.col(c) for c in order_cols], *[F.col(c) for c in value_cols])
    best = df.groupBy(*keys).agg(F.max(packed).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in [*order_cols, *value_cols]])

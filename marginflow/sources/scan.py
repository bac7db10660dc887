"""Scans (S1-S4): declarative table reads that leave pushdown and pruning to Catalyst."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITION_KEYS = ("year", "month", "day")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data directory; identical scans of a plan are reused by its exchanges."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scan(spark: SparkSession, source: str, fields=None, day: dt.date | None = None,
         where: str | Column | None = None, fmt: str = "parquet") -> DataFrame:
    """Table id or path, optional column list, optional day partition, optional predicate.

    ``source`` is a catalog table name when it has no ``/``, otherwise a path.
    Filters and the projection are declared lazily, so the parquet scan shows
    them as ``PushedFilters`` / ``PartitionFilters`` / ``ReadSchema``.
    """
    df = spark.table(source) if "/" not in source else spark.read.format(fmt).load(source)
    if day is not None:
        df = load_day(df, day)
    if where is not None:
        df = df.where(where)
    if fields:
        df = df.select(*fields)
    return df


def load_day(df: DataFrame, day: dt.date, keys=PARTITION_KEYS) -> DataFrame:
    """One ``year/month/day`` partition (partition pruning on integer keys)."""
    y, m, d = keys
    return df.where((F.col(y) == day.year) & (F.col(m) == day.month) & (F.col(d) == day.day))


def newest_partition(spark: SparkSession, path: str, keys=PARTITION_KEYS) -> tuple | None:
    """The greatest ``key=value`` folder under ``path``, level by level: a listing of one folder per key, no data.

    Values compare as numbers where all of a level are, else as text. Folders without files below are passed over;
    None: no partition.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path
    fs = folder(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def below(at, names) -> tuple | None:
        if not names:
            return () if any(not f.getPath().getName().startswith(("_", ".")) for f in fs.listStatus(at)) else None
        mark = names[0] + "="
        found = [(f.getPath().getName()[len(mark):], f.getPath()) for f in fs.listStatus(at)
                 if f.isDirectory() and f.getPath().getName().startswith(mark)]
        numbers = all(v.lstrip("-").isdigit() for v, _ in found)
        for value, child in sorted(found, key=lambda x: int(x[0]) if numbers else x[0], reverse=True):
            rest = below(child, names[1:])
            if rest is not None:
                return (int(value) if numbers else value, *rest)
        return None

    return below(folder(path), list(keys))


def _is_key(values: dict) -> Column:
    return reduce(Column.__and__, [F.col(k).eqNullSafe(F.lit(v)) for k, v in values.items()])


def load_latest(df: DataFrame, keys=PARTITION_KEYS, path: str | None = None) -> DataFrame:
    """S3: rows of the newest ``(year, month, day)`` partition.

    When the frame has no partition triple the table is returned whole. With
    ``path``, the folder that ``df`` was read from, the newest key comes from its
    listing (``newest_partition``); otherwise from the key columns, which reads them. The filter
    is three literals, which prune partitions. An empty table stays empty.
    """
    if not all(k in df.columns for k in keys):
        return df
    if path is not None:
        newest = newest_partition(df.sparkSession, path, keys)
        newest = None if newest is None else dict(zip(keys, newest))
    else:
        row = df.select(*keys).agg(F.max(F.struct(*keys)).alias("newest")).first()["newest"]
        newest = None if row is None else row.asDict()
    return df.limit(0) if newest is None else df.where(_is_key(newest))


def load_xml(df: DataFrame, xml_col: str = "doc", must_contain: str = "<GLOBAL>") -> DataFrame:
    """Keep XML payload rows that contain a marker."""
    return df.where(F.col(xml_col).contains(must_contain))

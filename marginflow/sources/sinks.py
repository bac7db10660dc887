"""Sinks (S5, S6, S8): append log and rerun-safe partitioned margin table, and their staged forms.

A staged write computes and writes a folder of its own; ``publish`` then moves its finished files to the target,
so that several sinks of a run can be written completely before any of them is changed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

PARTITION_KEYS = ("year", "month", "day")


def _spread(df: DataFrame, files: int | None) -> DataFrame:
    # None: adaptive execution deals rows to partitions of its advisory size; a number: so many even files
    return df.repartition(files) if files else df.hint("rebalance")


def write_append(df: DataFrame, path: str, files: int | None = None, fmt: str = "parquet",
                 partition_by: Sequence[str] = ()) -> None:
    """S5 + S8: append rows (the processed-file log) ; ``files`` fixes the number of output files."""
    w = _spread(df, files).write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_partitions(df: DataFrame, path: str, by: Sequence[str] = PARTITION_KEYS,
                     files: int | None = None, fmt: str = "parquet") -> None:
    """S6 + S8: overwrite only the partitions present in ``df`` (dynamic overwrite),
    so rerunning a day replaces that day and leaves the others alone."""
    (_spread(df, files).write.mode("overwrite").format(fmt)
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).save(path))


def stage_partitions(df: DataFrame, staging: str, by: Sequence[str] = PARTITION_KEYS, files: int | None = None) -> str:
    """Write ``df`` in partition folders under ``staging``; returns it."""
    _spread(df, files).write.mode("errorifexists").partitionBy(*by).parquet(staging)
    return staging


def stage_append(df: DataFrame, staging: str, files: int | None = None) -> str:
    """Write ``df`` under ``staging``; returns it."""
    _spread(df, files).write.mode("errorifexists").parquet(staging)
    return staging


def publish(spark: SparkSession, staging: str, target: str, replace_partitions: bool) -> int:
    """Move the data files of ``staging`` to ``target``, folder by folder; the number of files moved.

    With ``replace_partitions`` a partition folder's former files go once the new ones stand beside them; the other
    partitions stay. File names are unique per write, so nothing is overwritten. Metadata work only: the driver lists
    and renames, no data passes it.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    source, goal = path(staging), path(target)
    fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.listFiles(source, True)
    moves: dict[str, list] = {}
    prefix = len(fs.makeQualified(source).toString()) + 1
    while found.hasNext():
        file = found.next().getPath()
        if not file.getName().startswith(("_", ".")):
            folder = file.getParent().toString()[prefix:]
            moves.setdefault(folder, []).append(file)
    done = 0
    for folder, files in sorted(moves.items()):
        place = path(goal, folder) if folder else goal
        former = [f.getPath() for f in fs.listStatus(place)] if replace_partitions and fs.exists(place) else []
        fs.mkdirs(place)
        for file in files:
            if not fs.rename(file, path(place, file.getName())):
                raise OSError(f"cannot move {file.toString()} to {place.toString()}")
            done += 1
        for old in former:
            fs.delete(old, True)
    return done

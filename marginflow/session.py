"""Session helpers: build a session for tests / bench, read cluster settings."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "marginflow") -> SparkSession:
    """Local/test session. On a cluster, use the session the platform gives you."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there. Only a local session, which has one
    machine, gets a fresh scratch directory where it is unset.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="marginflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    try:
        spark.sparkContext.setCheckpointDir(current)   # classic sessions; Connect reads the conf
    except Exception:  # noqa: BLE001
        pass
    return current


def materialize(df: DataFrame, how: str = "table", files: int | None = None) -> DataFrame:
    """Cut the lineage of an intermediate that several branches read.

    ``table`` (default) writes it once as parquet under the shared folder
    named by ``spark.checkpoint.dir`` and reads it back: one pass, columnar,
    prunable, and a lost executor re-reads it instead of recomputing
    everything upstream. ``checkpoint`` uses Spark's reliable RDD checkpoint
    in the same folder (it evaluates the input twice unless cached).
    ``none`` keeps one lazy plan. ``files`` bounds the files of a table that is known to be small
    (and the tasks that write it), whatever the number of shuffle partitions.
    """
    if how == "none":
        return df
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark)
    if how == "checkpoint":
        return df.checkpoint(eager=True)
    if how == "table":
        path = shared_path(spark)
        _write(df.coalesce(files) if files else df, path)
        return spark.read.parquet(path)
    raise ValueError(f"unknown materialize mode {how!r}")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _write(df: DataFrame, path: str) -> None:
    """``df`` as parquet; its shuffle files go when it is written, not when the driver next collects its garbage."""
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def settle(spark: SparkSession, build: Callable[[], DataFrame], how: str = "table", path: str | None = None) -> DataFrame:
    """What ``build`` returns, materialized; tables it made on the way are removed as soon as this one is written.

    A job cut into such steps holds one step's shuffle files and the tables still to be read, not all of them to its end.
    ``path`` (a ``shared_path`` made before) keeps the result beyond a ``scratch_tables`` block opened since.
    """
    if how != "table":
        return materialize(build(), how)
    path = path or shared_path(spark)
    with scratch_tables(spark):
        _write(build(), path)
    return spark.read.parquet(path)


INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
ROWS_PER_PARTITION = 250_000


def fit_shuffles(df: DataFrame) -> DataFrame:
    """``df``, an input table, after the session's shuffles got a partition per ``ROWS_PER_PARTITION`` of its rows.

    With a fixed number of partitions a task's sorts and hash tables grow with the input until they spill. Adaptive
    execution merges partitions that turn out small; the number is only ever raised, and not at all for small tables.
    """
    spark = df.sparkSession
    need = -(-df.count() // ROWS_PER_PARTITION)   # a parquet table's count reads its footers alone
    have = spark.conf.get(INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions")
    if need > int(have):
        spark.conf.set(INITIAL, str(need))
    return df


SCRATCH = "marginflow-tables"
_scratch: list[list[str]] = []   # paths made within each open ``scratch_tables`` block


def shared_path(spark: SparkSession, kind: str = SCRATCH) -> str:
    """A new path under the shared folder; removed with the innermost open ``scratch_tables`` block."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}/{uuid.uuid4().hex}"
    if _scratch:
        _scratch[-1].append(path)
    return path


@contextlib.contextmanager
def scratch_tables(spark: SparkSession):
    """Remove the tables that were materialised within the block when it ends, failed or not.

    For jobs: open it around building and writing a result. Frames built inside must not be read after it.
    """
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
            fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(fs_path, True)

"""Session helpers: a local session for tests/bench, the shared work folder, owned intermediates.

Everything that a job keeps (persisted copies, reliable checkpoints, work files)
belongs to a :class:`Scope`. Lazy results read such intermediates, so they cannot
be freed when a function returns; the scope is closed by whoever consumes the
result::

    with Scope(spark):
        queries()["csv_points"](spark, sf_dir).write.parquet(out)

On leaving the block, by an error as well, all of it is gone. Work files made
outside any scope are removed by ``release(spark)`` or when the driver ends.
"""

from __future__ import annotations

import atexit
import math
import os
import tempfile
import threading
import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "orbitfit") -> SparkSession:
    """Build (or reuse) a session with AQE on and the web UI off.

    On a cluster the deployment sets master, memory and partition counts;
    this helper is for local runs, tests and the bench.
    """
    master = master or os.environ.get("ORBITFIT_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("ORBITFIT_DRIVER_MEMORY", "16g"))
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    # Stage and task timings without any UI or server: the event log, written
    # to a folder named by ORBITFIT_EVENT_LOG_DIR (off by default).
    event_dir = os.environ.get("ORBITFIT_EVENT_LOG_DIR")
    if event_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_dir))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session. Only when it is unset *and* the master is local
    (local runs, tests) a fresh local folder is created and registered; on a
    cluster an unset folder is an error, never a machine-local path.
    """
    sc = spark.sparkContext
    current = None
    try:
        current = sc.getCheckpointDir()
    except Exception:  # pragma: no cover - older API
        current = None
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current:
            sc.setCheckpointDir(current)
    if not current:
        if not str(sc.master).startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir (a shared folder) for this cluster session")
        current = tempfile.mkdtemp(prefix="orbitfit-ckpt-")
        sc.setCheckpointDir(current)
    return current


class Scope:
    """Owner of intermediates: frees them, the latest first, when it is closed."""

    _open = threading.local()

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._frees: dict[str, Callable[[], object]] = {}

    @classmethod
    def current(cls) -> Scope | None:
        """The innermost scope that this thread is in."""
        return (getattr(cls._open, "stack", None) or [None])[-1]

    def own(self, name: str, free: Callable[[], object]) -> None:
        self._frees[name] = free

    def disown(self, name: str) -> None:
        self._frees.pop(name, None)

    def close(self) -> None:
        """Free everything; one that fails does not keep the others, the first failure is raised."""
        failed = None
        while self._frees:
            _, free = self._frees.popitem()
            try:
                free()
            except Exception as e:
                failed = failed or e
        if failed is not None:
            raise failed

    def __enter__(self) -> Scope:
        if not hasattr(Scope._open, "stack"):
            Scope._open.stack = []
        Scope._open.stack.append(self)
        return self

    def __exit__(self, kind, error, trace) -> None:
        Scope._open.stack.remove(self)
        try:
            self.close()
        except Exception:
            if error is None:     # a failing body is the more important error
                raise


# Work files made outside any scope.
_LOOSE: dict[str, SparkSession] = {}


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder or file of any file system that Spark knows."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True))


def own_path(spark: SparkSession, path: str) -> str:
    """The scope, or without one the end of the driver, removes ``path``."""
    scope = Scope.current()
    if scope is not None:
        scope.own(path, lambda: delete_path(spark, path))
    else:
        _LOOSE[path] = spark
    return path


def free_path(spark: SparkSession, path: str) -> None:
    """Remove an owned path now."""
    delete_path(spark, path)
    _LOOSE.pop(path, None)
    scope = Scope.current()
    if scope is not None:
        scope.disown(path)


def work_path(spark: SparkSession, name: str) -> str:
    """A new owned folder of the shared folder."""
    return own_path(spark, f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")


def release(spark: SparkSession) -> int:
    """Remove the work files made outside any scope (results that read them end with them)."""
    n = 0
    while _LOOSE:
        path, _ = _LOOSE.popitem()
        n += delete_path(spark, path)
    return n


@atexit.register
def _release_at_exit() -> None:
    for path, spark in list(_LOOSE.items()):
        try:
            if spark.sparkContext._jsc is not None:
                delete_path(spark, path)
        except Exception:      # the session has ended before the driver
            return


def materialize(df: DataFrame, mode: str = "persist") -> DataFrame:
    """Materialise a hot intermediate.

    ``persist``: MEMORY_AND_DISK cache; a lost executor's blocks are rebuilt
    from the (short) lineage. ``checkpoint``: reliable checkpoint into the
    shared checkpoint folder, cutting lineage. Never a local checkpoint.
    The scope, if there is one, owns the copy; ``dematerialize`` frees it at once.
    """
    if mode == "persist":
        kept = df.persist(StorageLevel.MEMORY_AND_DISK)
        if Scope.current() is not None:
            Scope.current().own(f"persisted {id(kept)}", kept.unpersist)
        return kept
    if mode == "checkpoint":
        shared_dir(df.sparkSession)
        kept = df.checkpoint(eager=True)
        own_path(df.sparkSession, checkpoint_file(kept))
        return kept
    if mode == "none":
        return df
    raise ValueError(f"unknown materialize mode {mode!r}")


def checkpoint_file(df: DataFrame) -> str:
    """Where the rows of a checkpointed DataFrame lie."""
    return df._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get()


def dematerialize(df: DataFrame, mode: str = "persist") -> None:
    """Free a copy that ``materialize`` made."""
    if mode == "persist":
        df.unpersist()
        if Scope.current() is not None:
            Scope.current().disown(f"persisted {id(df)}")
    elif mode == "checkpoint":
        free_path(df.sparkSession, checkpoint_file(df))


# Fewest rows a task of a row-sized layout gets when small data is spread
# over the cores (below this, task overhead outweighs the parallelism).
MIN_ROWS_PER_TASK = 10_000


def partitions_for(spark: SparkSession, rows: int, rows_per_partition: int) -> int:
    """Partition count for ``rows`` rows: about ``rows_per_partition`` each,
    and spread over the cores only while every task keeps at least
    ``MIN_ROWS_PER_TASK`` rows (a tiny table on a 1,000-executor cluster
    gets a few partitions, not one per core)."""
    cores = spark.sparkContext.defaultParallelism
    return max(1, math.ceil(rows / rows_per_partition),
               min(cores, math.ceil(rows / MIN_ROWS_PER_TASK)))


def spread(df: DataFrame) -> DataFrame:
    """Round-robin an input that has fewer splits than cores over all cores.

    Small files (one parquet row group) scan in a single task; CPU-heavy
    passes that follow (hashing, sorting) then run on one core. Inputs with
    at least as many splits as cores, as at cluster scale, are returned as is.

    Meant for plain file scans: counting the partitions of a DataFrame that
    contains a shuffle would run that shuffle (adaptive execution plans it
    stage by stage), so callers opt in where the input is a scan. An
    under-split input is counted once and gets ``min(cores, rows /
    MIN_ROWS_PER_TASK)`` partitions, so a tiny file stays in one task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = df.rdd.getNumPartitions()
    if parts >= cores:
        return df
    target = min(cores, math.ceil(df.count() / MIN_ROWS_PER_TASK))
    return df.repartition(target) if target > parts else df

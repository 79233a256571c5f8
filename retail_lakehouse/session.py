"""Session helpers: UTC business times, AQE on, a shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import shutil
import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "retail_lakehouse", checkpoint_dir: str | None = None) -> SparkSession:
    """A session for tests and local runs. On a cluster, pass no master and let
    the submitter's configuration decide."""
    builder = SparkSession.builder.appName(app_name)
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # In local mode the driver JVM also runs every task; Spark's 1 GB
            # default heap makes it spend its time in GC. Only applies when
            # this call starts the JVM.
            builder = builder.config("spark.driver.memory", local_driver_memory())
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions or (master or "").startswith("local"):
        # Otherwise the submitter's count stands, or is sized from the input.
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or os.cpu_count() or 8))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def local_driver_memory() -> str:
    """Half of the machine's memory (at least 1 GB, at most 16 GB), or
    ``RETAIL_LAKEHOUSE_DRIVER_MEMORY``."""
    configured = os.environ.get("RETAIL_LAKEHOUSE_DRIVER_MEMORY")
    if configured:
        return configured
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    return f"{max(1, min(16, total // 2 // 2**30))}g"


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings every table operator relies on (idempotent).

    Business timestamps carry no zone in the source, so the session zone is
    UTC; AQE re-plans joins and coalesces partitions from runtime sizes; ANSI
    mode makes a failing plain cast an error (tolerant casts are ``try_cast``).
    """
    for key, value in (("spark.sql.session.timeZone", "UTC"), ("spark.sql.adaptive.enabled", "true"),
                       ("spark.sql.ansi.enabled", "true")):
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    return spark


# Initial shuffle partitions: one per this many input bytes (AQE then merges
# small partitions and splits skewed ones from the measured sizes).
SHUFFLE_BYTES_PER_PARTITION = 256 * 1024 * 1024


def initial_shuffle_partitions(input_bytes: int, parallelism: int) -> int:
    """Partitions for ``input_bytes`` of input: one per
    ``SHUFFLE_BYTES_PER_PARTITION``, at least the cluster's parallelism."""
    return max(parallelism, -(-max(input_bytes, 0) // SHUFFLE_BYTES_PER_PARTITION))


# Rows of numbers and dates that are stored as columns become text rows in a shuffle,
# and sorts and hash tables hold them unpacked: about this many times the file's bytes.
ROWS_PER_FILE_BYTE = 32
# The sizes that go with it, in place of Spark's defaults: what AQE merges partitions to (compressed
# map output; some 0.5 GB in the joins of a mart) and what one task reads of files.
TASK_BYTES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": (16 * 1024 * 1024, "67108864b"),
              "spark.sql.files.maxPartitionBytes": (32 * 1024 * 1024, "134217728b")}


def size_shuffles_of_columns(spark: SparkSession, file_bytes: int) -> int | None:
    """``size_shuffle_partitions`` for rows made of ``file_bytes`` of column files, and ``TASK_BYTES``
    where the submitter chose nothing: so the memory of a task follows neither the input
    nor the number of cores. Returns the count set, if any."""
    n = size_shuffle_partitions(spark, file_bytes * ROWS_PER_FILE_BYTE)
    if n is not None:
        at_launch = spark.sparkContext.getConf()
        for key, (size, default) in TASK_BYTES.items():
            if not at_launch.contains(key) and spark.conf.get(key, default) == default:
                spark.conf.set(key, str(size))
    return n


def size_shuffle_partitions(spark: SparkSession, input_bytes: int) -> int | None:
    """Start AQE from enough shuffle partitions for the input, unless the
    submitter chose a count. Spark's default of 200 would put ~500 GB into
    each partition of a 100 TB job; here each starts near 256 MB and AQE
    coalesces from the measured map output. Returns the count set, if any."""
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    at_launch = spark.sparkContext.getConf()
    if at_launch.contains("spark.sql.shuffle.partitions") or at_launch.contains(key):
        return None
    # Chosen at run time: a non-default count, or an initial count we did not set.
    if spark.conf.get("spark.sql.shuffle.partitions", "200") != "200":
        return None
    current = spark.conf.get(key, None)
    if current is not None and current != _SIZED.get(id(spark.sparkContext)):
        return None
    n = initial_shuffle_partitions(input_bytes, spark.sparkContext.defaultParallelism)
    spark.conf.set(key, str(n))
    _SIZED[id(spark.sparkContext)] = str(n)
    return n


_SIZED: dict[int, str] = {}  # the initial count this module set, per context


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the files under ``paths`` (one file-system metadata call
    per path, no data read). A path that cannot be measured (a glob, a
    listing error) counts as 0: sizing is an optimization, the read itself
    reports real errors."""
    jvm, hconf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        try:
            path = jvm.org.apache.hadoop.fs.Path(p)
            total += path.getFileSystem(hconf).getContentSummary(path).getLength()
        except Exception:  # noqa: BLE001 - py4j wraps every JVM error
            continue
    return total


# Files of more bytes than this make jobs that fill a cluster by themselves: two at once
# end no earlier, but keep two jobs' shuffles on the disks.
LARGE = 64 * 1024 * 1024

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_INSIDE: dict[int, list] = {}  # by session: how many blocks are open, and the setting before them
_INSIDE_LOCK = threading.Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is run inside the block go when it has run, not when the driver
    next collects its garbage. For work whose results are written or collected: a frame that
    is made inside and run a second time would make its shuffles again."""
    session = spark._jsparkSession.hashCode()
    with _INSIDE_LOCK:
        state = _INSIDE.setdefault(session, [0, spark.conf.get(_CLEANUP, "false")])
        state[0] += 1
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _INSIDE_LOCK:
            state[0] -= 1
            if not state[0]:
                spark.conf.set(_CLEANUP, state[1])
                del _INSIDE[session]


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``. Only in local mode (tests, local runs) and only
    where none is named, a folder of our own under the session's warehouse
    takes its place and is removed when the process ends. On a cluster an unset
    folder is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    target = sc.getConf().get("spark.checkpoint.dir", None)
    if not target:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
        target = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints-{uuid.uuid4().hex}"
        atexit.register(shutil.rmtree, target.removeprefix("file:"), ignore_errors=True)
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target


_WRITTEN: list[str] = []  # tables this process has materialized
_SCOPE: ContextVar[list[str] | None] = ContextVar("tables", default=None)


@contextmanager
def table_scope() -> Iterator[list[str]]:
    """The tables that the code inside the block materializes, in this thread: those of
    another query that runs meanwhile are not among them."""
    mine: list[str] = []
    token = _SCOPE.set(mine)
    try:
        yield mine
    finally:
        _SCOPE.reset(token)


def new_table_path(spark: SparkSession, label: str = "table") -> str:
    """A new folder for a table of this process under the shared checkpoint
    folder; ``drop_materialized`` deletes it."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/materialized/{label}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    if (mine := _SCOPE.get()) is not None:
        mine.append(path)
    return path


def materialize(df: DataFrame, label: str = "table", compression: str | None = None, path: str | None = None) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder (in another codec than
    the session's, if ``compression`` names one; at ``path``, a ``new_table_path``, if given) and
    return the written table.

    Cuts the lineage (a lost executor recomputes nothing before this point)
    like ``checkpoint()``, but the copy is columnar: later readers prune to
    the columns they use. Each call writes a new folder, so a rerun never
    overwrites what another reader may be reading.
    """
    spark = df.sparkSession
    path = path or new_table_path(spark, label)
    df.write.mode("errorifexists").parquet(path, compression=compression)
    return spark.read.parquet(path)


def materialized() -> list[str]:
    """The tables that this process has materialized and not dropped, oldest first."""
    return list(_WRITTEN)


def drop_materialized(spark: SparkSession, tables: Iterable[str] | None = None) -> int:
    """Delete tables that this process has materialized (all of them, if not
    named); call it when no result that reads them is needed any more. Returns how
    many went."""
    jvm, hconf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    for name in materialized() if tables is None else list(tables):
        if name in _WRITTEN:
            _WRITTEN.remove(name)
            path = jvm.org.apache.hadoop.fs.Path(name)
            removed += bool(path.getFileSystem(hconf).delete(path, True))
    return removed


def purge_materialized(spark: SparkSession, older_than_seconds: float = 24 * 3600) -> int:
    """Delete tables written by ``materialize`` that are older than
    ``older_than_seconds``; returns how many were removed. Every run writes
    new folders, so a table that a running query still reads is younger than
    any sensible threshold. Meant for a periodic clean-up job."""
    import time

    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/materialized"
    jvm, hconf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(hconf)
    if not fs.exists(path):
        return 0
    cutoff_ms = (time.time() - older_than_seconds) * 1000
    removed = 0
    for status in fs.listStatus(path):
        if status.isDirectory() and status.getModificationTime() < cutoff_ms:
            removed += bool(fs.delete(status.getPath(), True))
    return removed

"""Tables written to the cluster's shared folder, to cut lineage between steps."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from threading import Lock

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedlens.session import shared_dir


#: narrow rows that one task writes
ROWS_PER_TASK = 50_000


#: texts that go to a Python worker at a time
TEXT_ROWS = 500
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: (threads inside ``text_batches``, the setting before the first of them) by session
_BATCHES: dict[SparkSession, tuple[int, str]] = {}
_BATCHES_LOCK = Lock()

#: the tables written since each open ``scratch``, outermost first; every thread has its own
_OPEN: ContextVar[tuple[list[str], ...]] = ContextVar("open scratches", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the tables stored inside, but for those stored with ``keep``, when it ends.

    What outlives it must not read a removed table: store it with ``keep`` first.
    """
    written: list[str] = []
    token = _OPEN.set((*_OPEN.get(), written))
    try:
        yield
    finally:
        _OPEN.reset(token)
        for path in written:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def text_batches(spark: SparkSession) -> Iterator[None]:
    """What runs inside sends at most ``TEXT_ROWS`` rows to a Python worker at a time.

    An Arrow batch of texts lies in buffers of the executor's JVM, which double as they grow, and in
    the worker as well; Spark's 10,000 rows of a few KB each let the JVM grow by hundreds of MB.  A
    smaller setting of the session's own stays; the setting is restored when the last thread leaves.
    """
    with _BATCHES_LOCK:
        inside, before = _BATCHES.get(spark, (0, ""))
        if not inside:
            before = spark.conf.get(_BATCH_ROWS)
            if not 0 < int(before) <= TEXT_ROWS:
                spark.conf.set(_BATCH_ROWS, str(TEXT_ROWS))
        _BATCHES[spark] = inside + 1, before
    try:
        yield
    finally:
        with _BATCHES_LOCK:
            inside, before = _BATCHES.pop(spark)
            if inside > 1:
                _BATCHES[spark] = inside - 1, before
            else:
                spark.conf.set(_BATCH_ROWS, before)


def stored(df: DataFrame, name: str, rows: int | None = None, keep: bool = False) -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir`` and read it back.

    The copy survives lost executors, and a join on it starts from a plain
    exchange, which adaptive execution can split when a key is hot.  ``rows`` is a bound
    on the rows, if one is known: few rows are then written by few tasks.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "llm", name)
    for scope in _OPEN.get()[-2:-1] if keep else _OPEN.get()[-1:]:  # what is kept belongs to the scratch around this one
        scope.append(path)
    if rows is not None:
        df = df.coalesce(min(partitions(spark), rows // ROWS_PER_TASK + 1))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_parts(df: DataFrame, name: str, part: str) -> str:
    """Write ``df`` under ``spark.checkpoint.dir`` with a folder per value of the column ``part``; returns the path."""
    path = shared_dir(df.sparkSession, "llm", name)
    for scope in _OPEN.get()[-1:]:
        scope.append(path)
    df.write.partitionBy(part).parquet(path)
    return path


def stored_rows(df: DataFrame, name: str, rows: int | None = None, keep: bool = False) -> tuple[DataFrame, int]:
    """``stored``, and the number of rows (counted while they are written)."""
    seen = Observation()
    out = stored(df.observe(seen, F.count(F.lit(1)).alias("n")), name, rows, keep)
    return out, int(seen.get["n"])


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions (the unit the bucketed steps scale with)."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    """Each name, or the first ``name_2``, ``name_3`` ... that no column of ``df`` and no name before it has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        fresh, k = name, 2
        while fresh.lower() in taken:
            fresh, k = f"{name}_{k}", k + 1
        taken.add(fresh.lower())
        out.append(fresh)
    return out


def only(df: DataFrame, **columns: str) -> DataFrame:
    """Just the named columns (new name=old name), whatever else ``df`` carries."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])

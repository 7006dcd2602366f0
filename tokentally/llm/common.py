"""Helpers shared by the operators: tables, scratch tables, text blocks."""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokentally.session import fresh_path

#: Texts longer than this are worked on in blocks of about this many bytes.
BLOCK_BYTES = 1 << 20

try:
    _libc = ctypes.CDLL(None)
except (OSError, TypeError):  # no C library to ask
    _libc = None

#: Bytes of an Arrow batch (one row may be more).
BATCH_BYTES = 8 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
_ROWS_CONF = "spark.sql.parquet.columnarReaderBatchSize"

WHITE = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")


ARCHIVE = "tokentally_code.zip"


def ship_code(spark: SparkSession) -> None:
    """Send this package's source to the executors, once for each context, and bound what they get at once.

    Spark's default hands a Python worker Arrow batches of 64 MB, which stand in the JVM and in the worker,
    beside what is made of them. Unless the session sets its own bound, it is ``BATCH_BYTES``.
    """
    if spark.conf.get(_BATCH_CONF, None) is None:  # not set: the default counts
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))
    sc = spark.sparkContext
    if ARCHIVE in sc._python_includes:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    base = os.path.join(tempfile.mkdtemp(prefix="tokentally-code-"), ARCHIVE.removesuffix(".zip"))
    sc.addPyFile(shutil.make_archive(base, "zip", root, "tokentally"))


@contextmanager
def small_batches(spark: SparkSession, batch_bytes: int = 2 << 20, rows: int = 512) -> Iterator[None]:
    """Smaller Arrow batches and fewer Parquet rows at once for the actions inside, unless the session sets its own bounds.

    The 4,096 texts that Spark reads at once by default stand in arrays of many MB, which make the heap grow.
    """
    wanted = {_BATCH_CONF: (str(BATCH_BYTES), batch_bytes), _ROWS_CONF: (None, rows)}
    before = {key: spark.conf.get(key, None) for key in wanted}
    ours = {key: n for key, (default, n) in wanted.items() if before[key] in (None, default)}
    try:
        for key, n in ours.items():
            spark.conf.set(key, str(n))
        yield
    finally:
        for key in ours:
            spark.conf.unset(key) if before[key] is None else spark.conf.set(key, before[key])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and return the written table.

    Cuts the lineage: a lost executor costs a re-read of a shared file, not the
    steps before it. A join of two settled tables shuffles both sides, so
    adaptive execution may split a hot key.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(columns: list[str], wish: str) -> str:
    """``wish``, with underscores until no column has that name (in any case)."""
    taken = {c.lower() for c in columns}
    while wish.lower() in taken:
        wish = "_" + wish
    return wish


def every_column(df: DataFrame) -> list[Column]:
    """The columns of ``df``, whatever characters their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of a string column, a few at a time; null is empty.

    At the end of the column the process gives memory back that it has freed: Python workers
    stay alive between tasks beside a full heap.
    """
    data = column.cast(pa.binary())
    try:
        for start in range(0, len(data), 256):
            for text in data.slice(start, 256).to_pylist():
                yield b"" if text is None else text
    finally:
        give_back()


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    if _libc is not None and hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def blocks(data: bytes, size: int = BLOCK_BYTES) -> Iterator[bytes]:
    """``data`` in pieces of about ``size`` bytes that end before white space.

    A run without white space is never cut, so a piece may be longer.
    """
    start, n = 0, len(data)
    while n - start > size:
        cut = max(data.rfind(c, start + 1, start + size) for c in WHITE)
        if cut <= start:
            later = [p for c in WHITE if (p := data.find(c, start + size)) >= 0]
            if not later:
                break
            cut = min(later)
        yield data[start:cut]
        start = cut
    yield data[start:] if start else data

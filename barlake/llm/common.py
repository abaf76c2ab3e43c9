"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.session import scratch_path

# White space of the word definitions below (ASCII space and TAB..CR).
WORD = r"[^\x20\x09-\x0D]+"
# Code points handled at once inside a task; a longer text is a block of its own.
BLOCK_CHARS = 2_000_000


def ship(module_name: str) -> None:
    """Send a module's functions to executors by value: they need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


ship(__name__)


def blocks(rows: list, length: Callable[[object], int], limit: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Cut ``rows`` into consecutive [start, stop) blocks of about ``limit`` length."""
    start, size = 0, 0
    for i, row in enumerate(rows):
        n = length(row)
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(rows):
        yield start, len(rows)


def text_blocks(texts: pa.Array, limit: int = BLOCK_CHARS) -> Iterator[tuple[int, int, list]]:
    """[start, stop) blocks of about ``limit`` code points of an Arrow column, each with its texts as
    strings: a task never holds a whole batch (10,000 rows) as strings."""
    for i, j in blocks(pc.fill_null(pc.utf8_length(texts), 0).to_pylist(), int, limit):
        yield i, j, texts.slice(i, j - i).to_pylist()


def release() -> None:
    """Give freed memory back to the system; the C library would keep it for the process."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):
        pass  # not glibc


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over a task's batches, then :func:`release`: Spark keeps a Python worker for a minute, with
    all it has allocated, beside the next stage's."""

    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release()

    return task


def text_key(text: str | Column = "text") -> Column:
    """128-bit identity of a text as 32 hex characters; null for null."""
    return F.md5(F.col(text) if isinstance(text, str) else text)


def require(df: DataFrame, *names: str) -> None:
    """Fail early with a clear message when an input column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the input has {df.columns}")


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop input columns that the operator is about to write (case-insensitive)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def append(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a last column ``name``, in place of an input column of that name (in any case)."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() != name.lower()], value.alias(name))


def unused(df: DataFrame, name: str) -> str:
    """A column name that begins with ``name`` and that ``df`` does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while f"_{name}".lower() in taken:
        name += "_"
    return f"_{name}"


class Scratch:
    """Tables written once to the cluster's shared folder (``spark.checkpoint.dir``) and read back:
    they cut lineage and outlive a lost executor."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def write(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, "llm")
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that nothing reads any more."""
        for table in tables:
            _, path = self.paths.pop(id(table), (None, None))
            if path:
                jvm = self.spark.sparkContext._jvm
                target = jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)

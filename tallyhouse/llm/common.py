"""What the operators of this subpackage share: a folder all executors see, row keys, Arrow helpers."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder name under the session's ``spark.checkpoint.dir``.

    Only a local master without the setting gets a temporary folder (tests); a cluster without it is an error,
    because executors do not see each other's local folders.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tallyhouse-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base}/llm/{uuid.uuid4().hex}"


def stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write an intermediate as Parquet into the shared folder and read it back: later uses survive lost executors."""
    spark, schema, path = df.sparkSession, df.schema, f"{folder}/{name}"
    df.write.mode("errorifexists").parquet(path)
    del df
    # Shuffle files of the finished job stay on disk until the driver collects its garbage; ask for that now.
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def row_key(*columns: str) -> list[Column]:
    """128 bits that name a row by its content (``k1``, ``k2``); equal rows share them."""
    named = [F.col(c) for c in columns]
    marks = [c.isNull() for c in named]
    return [F.xxhash64(*named, *marks).alias("k1"), F.xxhash64(F.lit("second"), *marks, *named).alias("k2")]


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """Each text's UTF-8 bytes; null gives none."""
    for value in column:
        yield b"" if (text := value.as_py()) is None else text.encode("utf-8", "surrogatepass")


def give_back() -> None:
    """Hand memory that this process has freed back to the system: Python workers outlive their tasks and stages."""
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError, TypeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


_KEPT: dict[str, object] = {}
_ASKED: set[str] = set()


def kept(tag: str, make: Callable):
    """What ``make`` returns, made once a worker process; it outlives a task, but not a ``giving_back`` one that never asks for it."""
    if tag not in _KEPT:
        _KEPT[tag] = make()
    _ASKED.add(tag)
    return _KEPT[tag]


def drop_others(*tags: str) -> None:
    """Forget what is not named here and was not asked for since the last call."""
    for tag in set(_KEPT) - _ASKED - set(tags):
        del _KEPT[tag]
    _ASKED.clear()


def giving_back(run: Callable, tags: tuple[str, ...] | None = None) -> Callable:
    """The function for ``mapInArrow``; when a task ends, what it did not use and what it has freed go back to the system.

    With ``tags``, all that ``run`` asks for, what an earlier stage kept goes before the task begins: a worker never
    holds the objects of two stages.
    """
    def until_end(batches):
        if tags is not None and set(_KEPT) - set(tags):
            drop_others(*tags)
            give_back()
        yield from run(batches)
        drop_others()
        give_back()
    return until_end


@contextmanager
def small_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """Write batches of about ``size`` bytes, not of 10,000 rows, to the Python workers of what runs meanwhile."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, unless their search path has it already."""
    root = Path(__file__).resolve().parents[2]
    known = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p] + [Path.cwd().resolve()]
    context = spark.sparkContext
    if root in known or any("tallyhouse" in f for f in context._python_includes):
        return
    target = Path(tempfile.mkdtemp()) / "tallyhouse.zip"  # Spark serves it from the driver to the workers
    with zipfile.ZipFile(target, "w") as z:
        for f in (root / "tallyhouse").rglob("*.py"):
            z.write(f, f.relative_to(root))
    context.addPyFile(str(target))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

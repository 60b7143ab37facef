"""What the operators share: tables, batch settings and Arrow helpers."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rollspan.session import cut_lineage, shared_folder, ship_package

#: Bounds of one Arrow batch, so that very long texts don't add up in a Python worker.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Ship the package to the workers and bound the Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder of the cluster."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def in_written_order(stored: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of a Parquet table just read, in the order of its writer's partitions and rows.

    A scan takes the largest files first, whatever their names; part numbers and rows in the file restore the order.
    """
    part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).try_cast("long")
    placed = stored.select(*columns, part.alias("_part"), F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row_index"))
    return placed.orderBy("_part", "_file", "_row_index").select(*columns)


def with_row_ids(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a number for each row in column ``name``, the same in every scan.

    Rows of stored files are known by their file and place in it, whatever splits a scan makes of the files; file numbers come from one row
    per file. Other tables are numbered once and materialised.
    """
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias(f"{name}_file"), F.col("_metadata.row_index").alias(f"{name}_row"))
    except AnalysisException:
        return cut_lineage(docs.withColumn(name, F.monotonically_increasing_id()))
    files = placed.select(f"{name}_file").distinct()
    numbers = cut_lineage(files.withColumn(f"{name}_number", F.row_number().over(Window.orderBy(f"{name}_file")).cast("long")))
    row = F.shiftleft(F.col(f"{name}_number"), 38).bitwiseOR(F.col(f"{name}_row"))
    return placed.join(F.broadcast(numbers), f"{name}_file").select(*[placed[c] for c in docs.columns], row.alias(name))


_HELD: dict = {}


def held(key, make: Callable):
    """What a worker keeps between tasks: the object made last, and no other."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return memory that isn't used any more to the system; the C library and Arrow otherwise keep a task's most for a worker's life."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def release() -> None:
    """Drop what a worker keeps; called where a task begins that needs none of it, since workers outlive stages."""
    _HELD.clear()
    give_back()


def giving_back(work: Callable) -> Callable:
    """``work`` on a task's batches; its memory is given back when it ends, since idle workers live on beside busy ones."""
    @wraps(work)
    def run(*args, **settings):
        try:
            yield from work(*args, **settings)
        finally:
            give_back()
    return run


def task(work: Callable) -> Callable:
    """As :func:`giving_back`, for work that needs nothing a worker keeps: that is dropped first."""
    @wraps(work)
    def run(*args, **settings):
        release()
        yield from giving_back(work)(*args, **settings)
    return run


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; a null text is empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def slices(texts: list, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``limit`` characters; a longer text is alone."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)

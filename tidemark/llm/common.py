"""What the operators share: reading, stored steps, Arrow batches."""

import ctypes

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.storage import delete_folder, shared_folder

#: A word, as all word-based operators take it (fixed value of the contracts).
WORD = r"[^\x20\x09-\x0D]+"
#: Rows and bytes handed to Python at a time; a longer text comes by itself.
BATCH_ROWS, BATCH_BYTES = 8192, "8m"

_LIBC = ctypes.CDLL(None)
#: What this worker keeps from task to task, by the operator it is for: how to drop it.
_KEPT = {}


def read(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a step to the shared folder and go on from there.

    Cuts the lineage: a lost executor costs a read, not the step again.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def dropped(*steps: DataFrame):
    """Delete stored steps that nothing will read again: all that was made of them is stored itself."""
    for step in steps:
        delete_folder(step.sparkSession, step.stored_at)


def whole_text(column="text"):
    """The text, NULL as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def slices(batches, column, limit):
    """Cut Arrow batches to about ``limit`` bytes of a text column each.

    A longer text is a batch by itself; no text is ever cut.
    """
    for batch in batches:
        start = total = 0
        for row, size in enumerate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()):
            if row > start and total + size > limit:
                yield batch.slice(start, row - start)
                start, total = row, 0
            total += size
        if start < batch.num_rows:
            yield batch.slice(start)


def texts(batch, column="text"):
    """A text column as Python strings, NULL as the empty text."""
    return pc.fill_null(batch.column(column), "").to_pylist()


def give_back():
    """Hand what Arrow and numpy have freed back to the system."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):  # glibc
        _LIBC.malloc_trim(0)


def kept(owner, drop):
    """Tell that this worker holds something for the next task of ``owner``."""
    _KEPT[owner] = drop


def drop_others(owner):
    """Drop what this worker holds for operators other than ``owner``."""
    others = [other for other in _KEPT if other != owner]
    for other in others:
        _KEPT.pop(other)()
    if others:
        give_back()


def tidy(step, owner=None):
    """An Arrow step of ``owner`` that leaves a worker with no more than ``owner`` keeps in it.

    Spark keeps the worker for later steps, and allocators keep what was freed: beside the
    executor's heap it would stay taken through all steps that follow, those without Python too.
    """

    def run(batches):
        drop_others(owner)
        yield from step(batches)
        give_back()

    return run


def record(schema, **columns):
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)

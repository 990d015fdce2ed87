"""Small helpers that the text operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.sources.scratch import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

#: A side of a join is broadcast up to this many rows of a few dozen bytes; beyond it, Spark shuffles.
BROADCAST_ROWS = 200_000


def lower_ascii(text: Column) -> Column:
    """A-Z become a-z and nothing else changes. Plain ASCII takes the faster built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def id_crc32(doc_id: str) -> Column:
    """The checksum of the id's text, which splits rows into folds; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string"))


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: later steps read this table instead of repeating the work."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint behind a count; without it the join shuffles, and skewed keys are split adaptively.

    Meant for staged tables of short rows, whose count reads no column.
    """
    return F.broadcast(df) if df.count() <= rows else df


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = f"_{name}"
    return name


def give_back() -> None:
    """Return what this process has freed to the machine; the allocators of Arrow and C would keep it for themselves."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


def lean(function: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """The function for ``mapInArrow``, whose worker gives memory back after each batch it reads and at the end of a task.

    Workers outlive their tasks: what they keep is missing in the same executor's later stages, also those without Python.
    """

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            del batch
            give_back()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(read(batches))
        give_back()

    return run


def text_groups(
    batches: Iterable[pa.RecordBatch], text: str, most_chars: int
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of each batch with about ``most_chars`` characters of text (one longer text stays whole)."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        start = 0
        while start < batch.num_rows:
            texts, size, end = [], 0, start
            while end < batch.num_rows and (size < most_chars or end == start):
                texts.append(column[end].as_py() or "")
                size += len(texts[-1])
                end += 1
            yield batch.slice(start, end - start), texts
            start = end

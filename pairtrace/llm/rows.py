"""Rows told apart by their id and their text, as ids may be null or repeat; streams of sorted groups and of small batches."""

from __future__ import annotations

import ctypes
from functools import lru_cache, wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Rows of a text batch that are worked on, and sent back, at a time.
SLICE_ROWS = 500


@lru_cache(1)
def _trim():
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def frugal(run):
    """``run`` for mapInArrow, which hands freed memory back when a partition ends: idle workers stay alive beside later stages."""

    @wraps(run)
    def wrapped(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        _trim()(0)

    return wrapped


def slices(batches):
    """The batches in pieces of at most SLICE_ROWS rows."""
    for batch in batches:
        for lo in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(lo, SLICE_ROWS)


def text_mark(text_col: str) -> Column:
    """64-bit hash of the text; null and empty texts share one."""
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def without(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` less the rows whose id and text are those of a row of ``gone`` (id, text_mark); null ids are equal."""
    gone = gone.select(F.col(id_col).alias("__gone_id"), F.col("text_mark").alias("__gone_mark")).distinct()
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__gone_id")) & (text_mark(text_col) == F.col("__gone_mark"))
    return docs.join(gone, same, "left_anti")


def tables(batches, *keys: str, least: int = 1):
    """Tables of whole groups of equal ``keys`` of a stream that is sorted by them, of ``least`` rows or more but for the last.

    No more than a batch, ``least`` rows and one group are held.
    """
    held: list[pa.RecordBatch] = []
    rows, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        starts = [0, *(np.flatnonzero(change) + 1).tolist()]
        at = 0  # rows of the batch before it are given out
        for lo in starts:
            key = tuple(c[lo] for c in columns)
            if last is not None and key != last and rows + lo - at >= least:
                if lo > at:
                    held.append(batch.slice(at, lo - at))
                yield pa.Table.from_batches(held)
                held, rows, at = [], 0, lo
            last = key
        held.append(batch.slice(at))
        rows += batch.num_rows - at
    if held:
        yield pa.Table.from_batches(held)

"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from skyledger.session import scratch_path

#: Word separators of every operator here: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"

#: Bytes of text that a task turns into word arrays at once.
SLICE_BYTES = 4 << 20


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table under the session's shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor later re-reads files instead of redoing the work.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` bytes of text; a longer text is a run of its own."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    run = np.cumsum(sizes) // limit
    starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    for a, b in zip(starts, np.r_[starts[1:], batch.num_rows], strict=True):
        yield batch.slice(int(a), int(b - a))


def texts(column: pa.Array) -> pa.Array:
    """The column as large strings, nulls as empty."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def bounds(lists: pa.Array) -> np.ndarray:
    """Offsets of a list array from 0."""
    o = lists.offsets.to_numpy().astype(np.int64)
    return o - o[0]


class Words:
    """The words of a run of texts, coded: ``codes`` index ``values``; text i has ``codes[first[i]:first[i + 1]]``."""

    def __init__(self, column: pa.Array, lower_ascii: bool = False):
        parts = pc.ascii_split_whitespace(texts(column))
        coded = parts.flatten().dictionary_encode()
        codes = coded.indices.to_numpy().astype(np.int64)
        first = bounds(parts)
        values = coded.dictionary
        empty = pc.index(values, pa.scalar("", values.type)).as_py()
        if empty >= 0:  # pieces before a leading or after a trailing separator
            real = codes != empty
            first = np.r_[0, np.cumsum(real)][first]
            codes = codes[real]
        if lower_ascii:
            low = pc.ascii_lower(values).dictionary_encode()
            codes, values = low.indices.to_numpy().astype(np.int64)[codes], low.dictionary
        self.codes, self.first, self.values = codes, first, values

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each run ``first[i]:first[i + 1]`` (empty runs give 0)."""
    total = np.r_[np.zeros((1, *values.shape[1:]), values.dtype), np.cumsum(values, axis=0)]
    return total[first[1:]] - total[first[:-1]]

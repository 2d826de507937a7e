"""Access to list columns of Arrow batches as flat NumPy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """values (float64, null as NaN) and length per row (0 for a null list)."""
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64), lengths


def pieces(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into runs of rows whose lists hold about ``most`` values together; every row stays whole."""
    lengths = batch.column(column).value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    which = np.cumsum(lengths) // most
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(which)) + 1, [batch.num_rows]])
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def place_in_row(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each value of flattened lists: its row and its index in the row; and where each row starts."""
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    return row, np.arange(len(row)) - starts[row], starts


def first_of_source(batch: pa.RecordBatch, columns: tuple[str, ...]) -> np.ndarray:
    """For each row the first row of the batch that is equal in ``columns`` (nulls are equal)."""
    code = np.zeros(batch.num_rows, np.int64)
    for c in columns:
        d = batch.column(c).dictionary_encode()
        code = code * (len(d.dictionary) + 1) + d.indices.fill_null(len(d.dictionary)).to_numpy(zero_copy_only=False)
        _, code = np.unique(code, return_inverse=True)
    _, first = np.unique(code, return_index=True)
    return first[code]

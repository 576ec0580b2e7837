"""Work on Arrow lists a bounded number of elements at a time, whatever the size of a batch."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Elements of the first list column in a slice of more than one row.
ELEMENTS_AT_ONCE = 1_000_000


def offsets_of(lists: pa.Array) -> np.ndarray:
    """Where each list begins among the flattened elements, and where the last ends; nulls are empty."""
    return np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())])


def lists_of(lists: pa.Array, values: pa.Array) -> pa.ListArray:
    """``values`` cut into lists of the lengths of ``lists``; null lists stay null."""
    return pa.ListArray.from_arrays(pa.array(offsets_of(lists).astype(np.int32)), values, mask=lists.is_null())


def in_slices(work: Callable[..., pa.Array], *columns: pa.Array, elements: int = ELEMENTS_AT_ONCE) -> pa.Array:
    """``work`` on slices of rows whose lists in the first column have about ``elements`` elements together."""
    offsets = offsets_of(columns[0])
    cuts = np.searchsorted(offsets, np.arange(elements, offsets[-1], elements), "right") - 1
    edges = np.unique(np.concatenate([[0], np.maximum(cuts, 1), [len(offsets) - 1]]))
    if len(edges) < 2:
        return work(*columns)
    return pa.concat_arrays([
        work(*[c.slice(low, high - low) for c in columns]) for low, high in zip(edges, edges[1:], strict=False)])

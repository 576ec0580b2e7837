"""Removal of passages that an earlier document has, found by level-wise doubling.

Only what is repeated at one length can be repeated at twice that length.  The first
level takes, of each window of the next length, the run of words with the smallest hash
(so that equal windows choose equal runs) and keeps the runs that stand in two documents
or more.  Each following level doubles the length, up to the wanted one, tests the
windows whose parts have survived, and ends when the wanted length is reached or nothing
is left.  A level is one aggregation by hash, combined before the shuffle, and one join
of the occurrences with the hashes that are repeated.

Windows are compared by a 64-bit hash of their words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispan.llm.shared import stored
from lexispan.llm.words import Words, as_bytes, grams, slices, sliding

SHORTEST = 8
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


def lengths(window: int) -> list[int]:
    """Window lengths from short to ``window``, each at most twice the one before."""
    found = [window]
    while found[0] > SHORTEST:
        found.insert(0, (found[0] + 1) // 2)
    return found


def anchors(h: np.ndarray, row: np.ndarray, n: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the ``n``-word runs that are the smallest of some window."""
    g, inside = grams(h, row, n)
    if len(h) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    width = window - n + 1
    least = np.where(row[: len(h) - window + 1] == row[window - 1:], sliding(g, width, np.minimum), 0)
    pad = np.zeros(width - 1, np.uint64)
    reach = sliding(np.concatenate([pad, least, pad]), width, np.maximum)
    found = np.flatnonzero((reach == g) & inside)
    return found, g[found]


def _anchor_rows(n: int, window: int, schema: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = as_bytes(batch["_text"])
            for start, stop in slices(column):
                w = Words(column, start, stop)
                at, g = anchors(w.hashes, w.row, n, window)
                yield _occurrences(batch, w, start, at, g, schema)

    return run


def _occurrences(batch, w: Words, start: int, at: np.ndarray, g: np.ndarray, schema) -> pa.RecordBatch:
    rows = w.row[at]
    source = pa.array(rows + start)
    return pa.RecordBatch.from_arrays([
        pa.array(g.view(np.int64)), batch["_doc"].take(source), batch["_t"].take(source),
        pa.array((at - w.first[rows]).astype(np.int32)),
    ], schema=schema)


def _flags(batch, w: Words, start: int, stop: int) -> np.ndarray:
    """Which words are listed in the column ``_at`` of positions."""
    lists = batch["_at"].slice(start, stop - start)
    counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    at = lists.flatten().to_numpy(zero_copy_only=False) + np.repeat(w.first[:-1], counts)
    flags = np.zeros(len(w), bool)
    flags[at] = True
    return flags


def _window_rows(n: int, length: int, first: bool, schema: pa.Schema):
    """Windows of ``length`` words whose parts of ``n`` words are listed in ``_at``.

    At the ``first`` level only the part with the smallest hash was tested; another
    part may have been tested in this document alone.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = as_bytes(batch["_text"])
            for start, stop in slices(column):
                w = Words(column, start, stop)
                h = w.hashes
                windows, inside = grams(h, w.row, length)
                if not len(windows):
                    continue
                flags = _flags(batch, w, start, stop)
                if first:
                    g, _ = grams(h, w.row, n)
                    width = length - n + 1
                    listed = np.where(flags[: len(g)], g, _NEVER)
                    survives = sliding(g, width, np.minimum) == sliding(listed, width, np.minimum)
                else:
                    survives = flags[: len(windows)] & flags[length - n: length - n + len(windows)]
                at = np.flatnonzero(survives & inside)
                yield _occurrences(batch, w, start, at, windows[at], schema)

    return run


def _kept_rows(length: int, schema: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch["_text"]).to_pylist()
            starts = batch["_at"].to_pylist()
            totals, removed, kept = [], [], []
            for text, at in zip(texts, starts, strict=True):
                words = text.split()
                totals.append(len(words))
                if at:
                    ends = np.zeros(len(words) + 1, np.int64)
                    at = np.array(at)
                    np.add.at(ends, at, 1)
                    np.add.at(ends, at + length, -1)
                    stays = np.cumsum(ends)[:-1] == 0
                    words = [word for word, stay in zip(words, stays.tolist(), strict=True) if stay]
                removed.append(totals[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([
                batch["_doc"], pa.array(totals, pa.int64()), pa.array(removed, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ], schema=schema)

    return run


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13
) -> DataFrame:
    """``(id, n_words, n_removed, kept)`` per row of ``docs``.

    Removed is each word covered by a window of ``window`` words whose words, in their
    order and unchanged, also start somewhere in a document with a smaller id; the
    smallest id of a passage therefore keeps it.  ``kept`` has the other words joined by
    one blank.  Words are runs of anything but blank, tab, LF, VT, FF and CR; null text
    has none.  A repetition inside one document, or between rows of equal id, removes
    nothing.  Rows without an id take part in nothing and keep all their words.  Ids
    are integers or strings.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(
        F.col(id_col).alias("_doc"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
    ).withColumn("_t", F.xxhash64("_text"))
    named = texts.filter(F.col("_doc").isNotNull())
    unnamed = texts.filter(F.col("_doc").isNull())
    schema = f"_h long, _doc {kind}, _t long, _pos int"
    arrow = pa.schema([("_h", pa.int64()), ("_doc", _arrow(kind)), ("_t", pa.int64()), ("_pos", pa.int32())])
    place = ["_doc", "_t"]
    # One exchange of the texts serves all later levels and the last step.
    placed = named.repartition(*place)

    levels = lengths(window)
    found = named.mapInArrow(
        _anchor_rows(levels[0], levels[1] if len(levels) > 1 else window, arrow), schema)
    for k, length in enumerate(levels):
        if k:
            listed = found.groupBy(*place).agg(F.collect_list("_pos").alias("_at"))
            if k == 1:
                listed = stored(listed, "repeats-anchors")
            found = placed.join(listed, place).mapInArrow(
                _window_rows(levels[k - 1], length, k == 1, arrow), schema)
        several = found.groupBy("_h").agg(
            F.min("_doc").alias("_least"), F.max("_doc").alias("_most")
        ).filter("_least < _most").select(F.col("_h").alias("_g"), "_least")
        if k == 0:
            several = stored(several, "repeats-level")
        found = found.join(several, F.col("_h") == F.col("_g"))
        if length == window:
            found = found.filter("_least < _doc")
        found = found.select("_h", *place, "_pos")
    removed = found.groupBy(*place).agg(F.collect_list("_pos").alias("_at"))
    out = pa.schema([("_doc", _arrow(kind)), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                     ("kept", pa.string())])
    judged = placed.join(removed, place, "left").unionByName(
        unnamed.withColumn("_at", F.lit(None).cast("array<int>")))
    result = judged.mapInArrow(
        _kept_rows(window, out), f"_doc {kind}, n_words long, n_removed long, kept string")
    return result.withColumnRenamed("_doc", id_col)

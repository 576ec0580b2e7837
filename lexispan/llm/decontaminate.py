"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The test items are few next to the corpus.  They go to the tasks in slices of bounded
size, as a sorted table of the hashes of their n-grams.  A first pass counts in how many
documents each of these n-grams stands; the rare ones are the seeds, and so are those
about as frequent as an item's median one, however often the item was copied.  A second pass finds the seeds in the documents, and where several of an item
lie close together, the item is aligned with that stretch by words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispan.llm.words import Words, as_bytes, grams, slices

N = 3
SEEDS = 2
SLACK = 8
MIN_WORDS = 5
MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5
RARE_SHARE = 0.001
RARE_DOCUMENTS = 10
SLICE_TEXT_BYTES = 16 << 20
_FILTER_BITS = 20
#: Bytes that separate words: ASCII but for letters and digits.
SEPARATORS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


@dataclass
class Items:
    """Test items as word hashes, and a sorted table of their n-grams."""

    ids: list
    words: list[np.ndarray]
    hashes: np.ndarray  # distinct n-grams, sorted
    places: dict[int, list[tuple[int, int]]]  # number of the n-gram: items and positions

    @classmethod
    def of(cls, rows: list[tuple[object, str]]) -> Items:
        ids, words, places = [], [], {}
        for item_id, text in rows:
            h = _words(pa.array([text])).hashes
            if len(h) >= MIN_WORDS:
                g, _ = grams(h, np.zeros(len(h), np.int64), N)
                for at, value in enumerate(g.tolist()):
                    places.setdefault(value, []).append((len(ids), at))
                ids.append(item_id)
                words.append(h)
        hashes = np.array(sorted(places), np.uint64)
        return cls(ids, words, hashes, {i: places[v] for i, v in enumerate(hashes.tolist())})

    def find(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``g`` of n-grams of items, and their numbers."""
        shift = np.uint64(64 - _FILTER_BITS)
        present = np.zeros(1 << _FILTER_BITS, bool)
        present[self.hashes >> shift] = True
        at = np.flatnonzero(present[g >> shift])
        if not len(self.hashes):
            return at[:0], at[:0]
        number = np.minimum(np.searchsorted(self.hashes, g[at]), len(self.hashes) - 1)
        same = self.hashes[number] == g[at]
        return at[same], number[same]

    def rare(self, frequency: np.ndarray, documents: int) -> Items:
        """Only the rare n-grams, and for each item those as rare as its median one, twice over."""
        rare = max(RARE_DOCUMENTS, RARE_SHARE * documents)
        limits = [
            max(rare, 2 * np.median([frequency[n] for n in numbers])) for numbers in self.numbers_by_item()]
        kept = {
            n: [(i, at) for i, at in found if frequency[n] <= limits[i]]
            for n, found in self.places.items()
        }
        numbers = [n for n, found in sorted(kept.items()) if found]
        return Items(self.ids, self.words, self.hashes[numbers],
                     {k: kept[n] for k, n in enumerate(numbers)})

    def numbers_by_item(self) -> list[list[int]]:
        by_item: list[list[int]] = [[] for _ in self.ids]
        for number, found in self.places.items():
            for i, _ in found:
                by_item[i].append(number)
        return by_item


def _words(texts: pa.Array, start: int = 0, stop: int | None = None) -> Words:
    column = as_bytes(pc.utf8_lower(texts)) if start == 0 and stop is None else texts
    return Words(column, start, len(column) if stop is None else stop, SEPARATORS)


def alignment(item: np.ndarray, stretch: np.ndarray) -> float:
    """Best local alignment of two word sequences as a share of the item's full score."""
    gaps = np.arange(len(stretch) + 1) * -GAP
    above = np.zeros(len(stretch) + 1, np.int64)
    best = 0
    for word in item:
        step = np.where(stretch == word, MATCH, MISMATCH)
        row = np.zeros_like(above)
        row[1:] = np.maximum(0, np.maximum(above[:-1] + step, above[1:] + GAP))
        # A gap in the item costs the same per word wherever it begins.
        row = np.maximum.accumulate(row + gaps) - gaps
        best = max(best, int(row.max()))
        above = row
    return best / (MATCH * len(item))


def _stretches(at: list[tuple[int, int]], length: int, wanted: int) -> Iterator[tuple[int, int]]:
    """Word ranges where ``wanted`` seeds or more of one item lie close together."""
    at.sort()
    run: list[tuple[int, int]] = []
    for place in [*at, (1 << 62, 0)]:
        if run and place[0] - run[-1][0] > length + SLACK:
            if len(set(run)) >= wanted:
                low = min(p - i for p, i in run) - SLACK
                high = max(p - i for p, i in run) + length + SLACK
                yield max(0, low), high
            run = []
        run.append(place)


def _matches(w: Words, h: np.ndarray, items: Items, wanted: list[int]) -> Iterator[tuple[int, int, float]]:
    """``(row, item, score)`` of every stretch that was aligned."""
    g, inside = grams(h, w.row, N)
    at, numbers = items.find(g)
    seeds: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for position, number in zip(at.tolist(), numbers.tolist(), strict=True):
        if inside[position]:
            row = int(w.row[position])
            for item, place in items.places[number]:
                seeds.setdefault((row, item), []).append((position - int(w.first[row]), place))
    for (row, item), places in seeds.items():
        words = items.words[item]
        own = h[w.first[row]: w.first[row + 1]]
        for low, high in _stretches(places, len(words), wanted[item]):
            yield row, item, alignment(words, own[low:high])


def _frequencies(items: Items):
    """Documents per n-gram, by its number, and all documents at -1."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            found[-1] += batch.num_rows
            column = as_bytes(pc.utf8_lower(batch["_text"]))
            for start, stop in slices(column):
                w = Words(column, start, stop, SEPARATORS)
                g, inside = grams(w.hashes, w.row, N)
                at, numbers = items.find(g)
                at, numbers = at[inside[at]], numbers[inside[at]]
                once = np.unique(w.row[at] * np.int64(len(items.hashes) or 1) + numbers)
                found.update((once % (len(items.hashes) or 1)).tolist())
        yield pa.record_batch({
            "number": pa.array(found.keys(), pa.int64()), "n": pa.array(found.values(), pa.int64())})

    return run


def _judged(texts: pa.Array, items: Items, threshold: float) -> tuple[list[tuple], list[set]]:
    """``(score, item)`` of the best alignment of each text, and the items that reach ``threshold``."""
    wanted = [min(SEEDS, len(set(numbers))) for numbers in items.numbers_by_item()]
    best: list[tuple] = [(0.0, None)] * len(texts)
    hits: list[set] = [set() for _ in range(len(texts))]
    column = as_bytes(pc.utf8_lower(texts))
    for start, stop in slices(column):
        w = Words(column, start, stop, SEPARATORS)
        for row, item, score in _matches(w, w.hashes, items, wanted):
            i = start + row
            if score > best[i][0]:
                best[i] = score, item
            if score >= threshold:
                hits[i].add(item)
    return best, hits


def _scores(items: Items, threshold: float, item_type: pa.DataType):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, hits = _judged(batch["_text"], items, threshold)
            yield pa.record_batch({
                "_id": batch["_id"],
                "score": pa.array([score for score, _ in best], pa.float64()),
                "item_id": pa.array([None if i is None else items.ids[i] for _, i in best], item_type),
                "n_items": pa.array(map(len, hits), pa.int64()),
            })

    return run


def _item_slices(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple]]:
    """The items in slices of about ``SLICE_TEXT_BYTES``, one at a time."""
    items = benchmark.filter(F.col(item_id).isNotNull() & F.col(text).isNotNull()).select(
        F.col(item_id).alias("id"), F.col(text).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + size // SLICE_TEXT_BYTES
    for part in range(parts):
        chosen = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part)
        yield [(r.id, r.text) for r in chosen.orderBy("id", "text").collect()]


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD,
) -> DataFrame:
    """``(id, contaminated, score, item_id, n_items)`` per row of ``docs``.

    ``score`` is the best alignment with any item as a share of that item's full score
    and ``item_id`` that item; ``n_items`` counts the items that reach ``threshold``.
    Words are runs of letters and digits, case ignored.  Items of fewer than
    ``MIN_WORDS`` words can't be told from ordinary prose and are not searched.  Null
    texts, empty texts and an empty benchmark give score 0 and a null item.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    item_kind = benchmark.schema[item_id].dataType.simpleString()
    arrow_item = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[item_kind]
    rows = docs.select(
        F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    found = [
        rows.mapInArrow(
            _scores(items, threshold, arrow_item),
            f"_id {kind}, score double, item_id {item_kind}, n_items long")
        for items in _seeded_items(rows, benchmark, item_id, item_text)
    ]
    result = found[0]
    if len(found) > 1:
        for more in found[1:]:
            result = result.unionByName(more)
        best = F.max(F.struct("score", "item_id")).alias("best")
        result = result.groupBy("_id").agg(best, F.sum("n_items").alias("n_items")).select(
            "_id", "best.score", "best.item_id", "n_items")
    return result.select(
        F.col("_id").alias(id_col), (F.col("n_items") > 0).alias("contaminated"), "score",
        F.col("item_id"), "n_items")


def _seeded_items(
    rows: DataFrame, benchmark: DataFrame, item_id: str, item_text: str
) -> Iterator[Items]:
    """Slices of the items with only their rare n-grams, counted over all of ``rows``."""
    for part in _item_slices(benchmark, item_id, item_text):
        items = Items.of(part)
        counted = rows.mapInArrow(_frequencies(items), "number long, n long").groupBy("number").agg(
            F.sum("n").alias("n")).collect()
        frequency = {r.number: r.n for r in counted}
        yield items.rare(
            np.array([frequency.get(n, 0) for n in range(len(items.hashes))]), frequency.get(-1, 0))


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
    item_text: str = "text", threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of ``docs`` that align with no item; all columns as they were, and no shuffle."""
    schema = docs.schema

    def clean(items: Items):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index(text_col)).cast(pa.string()).fill_null("")
                _, hits = _judged(texts, items, threshold)
                yield batch.filter(pa.array([not found for found in hits], pa.bool_()))

        return run

    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    for items in _seeded_items(rows, benchmark, item_id, item_text):
        docs = docs.mapInArrow(clean(items), schema)
    return docs

"""SimHash near-duplicates: fingerprints in BK-trees.

A BK-tree hangs each fingerprint below its parent under their Hamming distance; a search
follows only the edges within the radius around the distance to the node.  A tree over
all fingerprints would grow with the corpus, so there are shard trees: fingerprints that
agree on one of ``radius + 1`` groups of bits share a shard, and two within the radius
always agree on one.  A shard that is too large for one tree is cut in the same way by
the bits that are left.  Trees are built in the tasks that hold the shards.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispan.llm.columns import drop_rows
from lexispan.llm.components import components
from lexispan.llm.shared import stored
from lexispan.llm.words import as_bytes

BITS = 64
TREE_SIZE = 2000
#: Shards that leave so few bits free are small enough whatever they hold.
FREE_BITS = 12
SEED = 42


class BKTree:
    """Integers below their parents by Hamming distance."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> int:
        """The number of ``value``'s node, which is made if there is none."""
        at = 0
        if self.values:
            while True:
                d = (value ^ self.values[at]).bit_count()
                if d == 0:
                    return at
                below = self.children[at].get(d)
                if below is None:
                    self.children[at][d] = len(self.values)
                    break
                at = below
        self.values.append(value)
        self.children.append({})
        return len(self.values) - 1

    def within(self, value: int, radius: int) -> Iterator[tuple[int, int]]:
        """``(distance, node)`` of the nodes at most ``radius`` away."""
        todo = [0] if self.values else []
        while todo:
            at = todo.pop()
            d = (value ^ self.values[at]).bit_count()
            if d <= radius:
                yield d, at
            edges = self.children[at]
            if len(edges) <= 2 * radius:
                todo.extend(below for e, below in edges.items() if d - radius <= e <= d + radius)
            else:
                todo.extend(edges[e] for e in range(max(1, d - radius), d + radius + 1) if e in edges)


class Sets:
    """Disjoint sets of 0..n-1, each known by its smallest member."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.parent[max(i, j)] = min(i, j)
        return i != j


def majority(hashes: np.ndarray) -> int:
    """The number whose bits are set in over half of ``hashes``; 0 if there are none."""
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i: i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of the XXH64 of each shingle of ``text``, A-Z lower-cased."""
    words = text.lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = (ends - sizes + 1)[:n].tolist()
    stops = ends[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    return majority(np.fromiter(
        (digest(whole[i:j], SEED) for i, j in zip(starts, stops, strict=True)), np.uint64, n))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(id, fp)`` per row: the 64-bit SimHash of the whole text as a signed number.

    Shingles are ``shingle`` consecutive words joined by a blank, repeats included; of
    fewer words, the whole sequence.  Text without words, and null, has fingerprint 0.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, shingle) for t in as_bytes(batch["_text"]).to_pylist()]
            yield pa.record_batch({
                "_id": batch["_id"], "fp": pa.array(np.array(found, np.uint64).view(np.int64))})

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(run, f"_id {kind}, fp long").withColumnRenamed("_id", id_col)


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _cut(mask: int, parts: int) -> list[int]:
    """``mask`` with one of ``parts`` equal groups of the other bits added, for each group."""
    free = [i for i in range(BITS) if not mask >> i & 1]
    bounds = [len(free) * k // parts for k in range(parts + 1)]
    return [
        mask | sum(1 << i for i in free[low:high])
        for low, high in zip(bounds, bounds[1:], strict=False) if high > low
    ]


def _tree_links(radius: int):
    """Each member of a shard with the first of those it is linked to, directly or not."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for members in batch["members"].to_pylist():
                values = sorted({m % (1 << BITS) for m in members})
                tree, sets = BKTree(), Sets(len(values))
                for i, value in enumerate(values):
                    for _, j in tree.within(value, radius):
                        sets.join(i, j)
                    tree.add(value)
                for i, value in enumerate(values):
                    if (root := sets.root(i)) != i:
                        a.append(value)
                        b.append(values[root])
            yield pa.record_batch({
                "a": pa.array(np.array(a, np.uint64).view(np.int64)),
                "b": pa.array(np.array(b, np.uint64).view(np.int64))})

    return run


def fingerprint_links(prints: DataFrame, radius: int = 3, tree_size: int = TREE_SIZE) -> DataFrame:
    """``(a, b)``: links that join exactly the fingerprints connected by distances up to ``radius``.

    ``prints`` has the distinct fingerprints in ``fp``.  A shard gives one link less than
    it has members at most, however many pairs of it are close.
    """
    spark = prints.sparkSession
    masks, links = set(_cut(0, radius + 1)), []
    rows = prints.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    while True:
        rows = stored(
            rows.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value")), "shards")
        sizes = rows.groupBy("mask", "value").count()
        if min(mask.bit_count() for mask in masks) >= BITS - FREE_BITS:
            tree_size = 1 << FREE_BITS
        fit = sizes.filter(f"count BETWEEN 2 AND {tree_size}").select("mask", "value")
        members = rows.join(fit, ["mask", "value"]).groupBy("mask", "value").agg(
            F.collect_list("fp").alias("members")).select("members")
        links.append(stored(members.mapInArrow(_tree_links(radius), "a long, b long"), "links"))
        large = sizes.filter(f"count > {tree_size}").select("mask", "value")
        rows = stored(rows.join(large, ["mask", "value"], "left_semi").select("fp", "mask"), "large-shards")
        if rows.isEmpty():
            break
        finer = [(_signed(m), _signed(c)) for m in masks for c in _cut(m, radius + 1)]
        masks = {c % (1 << BITS) for _, c in finer}
        table = F.broadcast(spark.createDataFrame(finer, "mask long, finer long"))
        # Two masks may be cut to the same finer one.
        rows = rows.join(table, "mask").select("fp", F.col("finer").alias("mask")).distinct()
    found = links[0]
    for more in links[1:]:
        found = found.unionByName(more)
    return found


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
    radius: int = 3, tree_size: int = TREE_SIZE,
) -> DataFrame:
    """``(id, fp, component)`` per row; the component is the smallest id reachable by links.

    Two rows are linked when their fingerprints differ in at most ``radius`` bits.  Rows
    without an id belong to their component but don't name it.  No rows, no result rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    marked = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    prints = stored(marked.groupBy("fp").agg(F.min(id_col).alias("first")), "distinct-fingerprints")
    groups = components(fingerprint_links(prints, radius, tree_size))
    named = prints.join(groups, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("group"))
    least = named.groupBy("group").agg(F.min("first").cast(kind).alias("component"))
    return marked.join(named.join(least, "group").select("fp", "component"), "fp").select(
        id_col, "fp", "component")


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3,
) -> DataFrame:
    """One row of each component of ``near_duplicates``: the smallest id; all columns as they were.

    A row is known by its id and text, so others that share its id stay; ids may repeat or
    be null, which counts as smallest.  Of equal texts with one id one row stays.
    """
    digest = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    keyed = docs.select(F.struct(F.col(id_col).alias("id"), digest.alias("digest")).alias("_key"),
                        F.col(text_col).alias("_text"))
    found = near_duplicates(keyed, "_key", "_text", shingle, radius)
    rows = stored(found.groupBy("_key").agg(
        F.count(F.lit(1)).alias("n"), F.first("component").alias("component")).filter(
        "n > 1 OR NOT _key <=> component").select("_key.*", "n", (F.col("_key") == F.col("component")).alias("kept")), "near-rows")
    return drop_rows(docs, id_col, digest, rows.filter("NOT kept").select("id", "digest"),
                     rows.filter("kept").select("id", "digest"))


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")

"""Reading one large JSON or CSV file in many tasks.

A JSON document and a CSV file with line breaks in its fields have no separator that
always ends a record: whether a comma or a line feed does depends on all the text before.
Spark's text source cuts such a file into byte ranges all the same, with the separator as
end of line, from any store that Spark reads.  The first pass reduces each range to what
it does to the state of a reader: whether it changes between inside and outside a string,
and how it changes the depth of brackets, for both ways it may begin.  From these few
numbers per range follows the state at the start of each.  The second pass cuts the
ranges into records.  A record that lies across ranges comes out in parts, which are put
together by key.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexispan.session import ship_package
from lexispan.sources.scratch import stored

#: How a record lies in its range: all of it, from its start on, up to its end, neither;
#: and the name of the last section that begins in the range.
WHOLE, HEAD, TAIL, MIDDLE, NAME = range(5)
#: What happens at a place of the text.
NEXT, CLOSE, OPEN = range(3)
#: Text that is looked at, or collected as records, at a time; a state takes some ten bytes a byte.
BYTES_AT_ONCE = 4 << 20

_KEY = re.compile(rb'"((?:[^"\\]|\\.)*)"\s*:\s*[\[{]$')
_RECORDS = "file string, start long, seq long, kind int, section string, record binary"


def _quotes(data: np.ndarray, escaped: bool) -> np.ndarray:
    """Where a string begins or ends; with ``escaped``, a backslash hides the next character."""
    found = data == ord('"')
    if escaped and (data == ord("\\")).any():
        place = np.arange(len(data))
        before = np.maximum.accumulate(np.where(data != ord("\\"), place, -1))
        at = np.flatnonzero(found)
        at = at[at > 0]
        odd = (at - 1 - before[at - 1]) % 2 == 1
        found[at[odd]] = False
    return found


class CsvRecords:
    """Lines of a CSV file that end outside quotes.  A quote in a field is doubled."""

    separator = "\n"
    starts_open, sections = True, False

    def measure(self, text: bytes) -> tuple[int, int, int]:
        return text.count(b'"') % 2, 0, 0

    def events(self, text: bytes, inside: int, depth: int) -> tuple[list[int], list[int], int, int]:
        data = np.frombuffer(text, np.uint8)
        within = inside + np.cumsum(data == ord('"'))
        at = np.flatnonzero((data == ord("\n")) & (within % 2 == 0))
        return at.tolist(), [NEXT] * len(at), int(within[-1] % 2), 0


class JsonRecords:
    """The values or members at ``depth`` brackets within one JSON document.

    At depth 1 these are the members of the outermost object, at depth 2 the entries of
    the arrays (or objects) in it, with the name each of those has there as section.
    """

    separator = ","
    starts_open, sections = False, True

    def __init__(self, depth: int) -> None:
        self.depth = depth

    def _shape(self, text: bytes, inside: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data = np.frombuffer(text, np.uint8)
        within = (inside + np.cumsum(_quotes(data, True))) % 2
        step = ((data == ord("{")) | (data == ord("["))).astype(np.int64)
        step -= (data == ord("}")) | (data == ord("]"))
        return data, within, step

    def measure(self, text: bytes) -> tuple[int, int, int]:
        _, within, step = self._shape(text, 0)
        return int(within[-1]), int(step[within == 0].sum()), int(step[within == 1].sum())

    def events(self, text: bytes, inside: int, depth: int) -> tuple[list[int], list[int], int, int]:
        data, within, step = self._shape(text, inside)
        step[within == 1] = 0
        depths = depth + np.cumsum(step)
        opens = (step == 1) & (depths == self.depth)
        closes = (step == -1) & (depths == self.depth - 1)
        commas = (data == ord(",")) & (within == 0) & (depths == self.depth)
        kind = np.where(opens, OPEN, np.where(closes, CLOSE, NEXT))
        at = np.flatnonzero(opens | closes | commas)
        return at.tolist(), kind[at].tolist(), int(within[-1]), int(depths[-1])


def _ranges(spark: SparkSession, paths: Sequence[str], separator: str) -> DataFrame:
    """``(file, start, piece)``: the text between separators, in order within each range.

    The scan belongs to a session of its own, so that its ranges are the same in both
    passes whatever happens to the number of executors or the caller's settings.
    """
    own = spark.newSession()
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.files.minPartitionNum", spark.conf.get(
        "spark.sql.files.minPartitionNum", None) or str(spark.sparkContext.defaultParallelism))
    text = own.read.option("lineSep", separator).text(list(paths))
    return _handed_over(spark, text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("piece")))


def _handed_over(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``df`` under the caller's session; the optimizer removes the empty side."""
    empty = spark.sql("SELECT 1").select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema])
    return empty.filter(F.lit(False)).unionByName(df)


def _parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that parts of more than one row have about ``BYTES_AT_ONCE`` of text at most."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch["piece"]), 0).to_numpy(), dtype=np.int64)
        low = 0
        while low < batch.num_rows:
            done = int(ends[low - 1]) if low else 0
            high = max(low + 1, int(np.searchsorted(ends, done + BYTES_AT_ONCE, "right")))
            yield batch.slice(low, high - low)
            low = high


def _runs(batches: Iterable[pa.RecordBatch], separator: bytes) -> Iterator[tuple[str, int, bytes]]:
    """The text of each part of a batch, cut where another range begins."""
    for batch in _parts(batches):
        file, start = batch["file"].dictionary_encode(), batch["start"].to_numpy()
        number = file.indices.to_numpy()
        edges = np.flatnonzero((np.diff(number) != 0) | (np.diff(start) != 0)) + 1
        pieces = batch["piece"].to_pylist()
        bounds = [0, *edges.tolist(), len(pieces)]
        for low, high in zip(bounds, bounds[1:], strict=False):
            yield file[low].as_py(), int(start[low]), separator.join(pieces[low:high]) + separator


def _start_states(pieces: DataFrame, form, one_text: bool) -> dict[tuple[str, int], tuple[int, int]]:
    """Whether each range begins inside a string, and how deep: two numbers per range."""
    separator = form.separator.encode()

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list[int]] = {}
        for file, start, text in _runs(batches, separator):
            flips, outside, within = form.measure(text)
            own = found.setdefault((file, start), [0, 0, 0])
            rises = (outside, within) if own[0] == 0 else (within, outside)
            own[0] ^= flips
            own[1] += rises[0]
            own[2] += rises[1]
        yield pa.record_batch({
            "file": pa.array([f for f, _ in found], pa.string()), "start": pa.array([s for _, s in found], pa.int64()),
            **{name: pa.array([own[k] for own in found.values()], pa.int64())
               for k, name in enumerate(("flips", "outside", "within"))}})

    # One row per range, that is per maxPartitionBytes of text.
    ranges = pieces.mapInArrow(measure, "file string, start long, flips long, outside long, within long").collect()
    states, file, inside, depth = {}, None, 0, 0
    for r in sorted(ranges, key=lambda r: (r.file, r.start)):
        if r.file != file and not one_text:
            file, inside, depth = r.file, 0, 0
        states[r.file, r.start] = inside, depth
        depth += r.within if inside else r.outside
        inside ^= r.flips
    return states


def _cut(pieces: DataFrame, form, states) -> DataFrame:
    """Rows of ``_RECORDS``: whole records, and the parts of those across ranges."""
    separator = form.separator.encode()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        waiting, place, section = 0, None, None

        def finish() -> None:
            if opened:
                out.append((*place, seq, HEAD if known else MIDDLE, section, b"".join(pending)))
            if section is not None:
                out.append((*place, seq + 1, NAME, section, None))

        for file, start, text in _runs(batches, separator):
            if (file, start) != place:
                if place is not None:
                    finish()
                place, section, seq, pending = (file, start), None, 0, []
                inside, depth = states.value[place]
                opened = form.starts_open or depth >= form.depth
                # The first record of a file begins where the file does.
                known = start == 0
            at, kinds, inside, depth = form.events(text, inside, depth)
            last = 0
            for i, kind in zip(at, kinds, strict=True):
                if kind == OPEN:
                    name = _KEY.search(text, last, i + 1)
                    section = name[1].decode() if name else ""
                    opened = known = True
                else:
                    record = text[last:i] if not pending else b"".join([*pending, text[last:i]])
                    out.append((file, start, seq, WHOLE if known else TAIL, section, record))
                    waiting += len(record)
                    seq += 1
                    pending, known, opened = [], True, kind != CLOSE
                last = i + 1
            if opened:
                pending.append(text[last:])
            if len(out) >= 4096 or waiting >= BYTES_AT_ONCE:
                yield _batch(out)
                out.clear()
                waiting = 0
        if place is not None:
            finish()
        yield _batch(out)

    return pieces.mapInArrow(cut, _RECORDS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.binary())
    names = [part.split()[0] for part in _RECORDS.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def records(spark: SparkSession, paths: Sequence[str], form, one_text: bool = False) -> DataFrame:
    """``(file, start, seq, section, record)``: the records of all files below ``paths``.

    With ``one_text`` the files are consecutive parts of one text, in the order of their
    names, none of which ends within a record.

    ``record`` is the text of one record, blank ones left out; ``start`` and ``seq`` order
    the records of a file.  Only the parts of records that lie across byte ranges are
    shuffled.  Files without records give no rows.
    """
    ship_package(spark)
    pieces = _ranges(spark, paths, form.separator)
    states = spark.sparkContext.broadcast(_start_states(pieces, form, one_text))
    cut = _cut(pieces, form, states)
    # Three rows per range at most.
    parts = stored(cut.filter(F.col("kind") != WHOLE), "record-parts")
    order = Window.partitionBy("file").orderBy("start", "seq")
    begun = F.when(F.col("kind") == HEAD, F.struct("start", "seq", "section"))
    owners = parts.filter(F.col("kind") != NAME).select("file", "start", "seq", "kind", "section").withColumn(
        "owner", F.last(begun, ignorenulls=True).over(order)).select("file", "start", "seq", "owner")
    joined = parts.filter(F.col("kind") != NAME).drop("section").join(owners, ["file", "start", "seq"]).groupBy(
        "file", "owner").agg(F.array_sort(F.collect_list(F.struct("start", "seq", "record"))).alias("parts")).select(
        "file", F.col("owner.start").alias("start"), F.col("owner.seq").alias("seq"),
        F.col("owner.section").alias("section"),
        F.aggregate("parts", F.lit(b""), lambda text, part: F.concat(text, part["record"])).alias("record"))
    found = cut.filter(F.col("kind") == WHOLE).drop("kind").unionByName(joined).withColumn(
        "record", F.col("record").cast("string")).filter(F.trim(F.translate("record", "\t\r\n", "   ")) != "")
    if not form.sections:
        return found
    # A range that begins within a section has its name from the ranges before it.
    named = {(r.file, r.start): r.section for r in parts.filter(F.col("kind") == NAME).collect()}
    before, rows, file = None, [], None
    for place in sorted(states.value):
        if place[0] != file and not one_text:
            file, before = place[0], None
        rows.append((*place, before))
        before = named.get(place, before)
    continued = spark.createDataFrame(rows, "file string, start long, continued string")
    return found.join(F.broadcast(continued), ["file", "start"], "left").withColumn(
        "section", F.coalesce("section", "continued")).drop("continued")

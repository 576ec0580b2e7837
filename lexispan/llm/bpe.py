"""BPE encoding and decoding by tree concatenation.

A text of up to ``leaf_chars`` code points is encoded in its row.  A longer one is cut
in halves, and these again, at whatever character lies in the middle; the leaves become
rows that tasks encode in parallel.  Afterwards neighbouring halves are joined up to the
root: a window around the join is encoded anew and grows until one of its tokens on the
left is also a token of the left half and one on the right also one of the right half.
What lies outside the two tokens stays as the halves have it, what lies between them is
the window's.

Why the result is that of the whole text: merges are applied by rank, so a sequence of
tokens is the encoding of its text exactly when every two neighbours are the encoding of
theirs.  Of the joined sequence any two neighbours come from one encoding.  Splits,
special tokens and normalisation look a few characters ahead, hence the tokens that are
compared end ``MARGIN`` characters before the cut (or start as many after it) with a
character in between that starts a new normalisation unit.  A window that covers both
halves is the whole encoding, so the growth ends.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from tokenizers import Tokenizer

from lexispan.llm.shared import stored
from lexispan.llm.words import slices

LEAF_CHARS = 1 << 15
FIRST_WINDOW = 64
#: More than the longest special token and than what a split looks ahead.
MARGIN = 32
#: Tokens of one character at most: four bytes of each character it is normalised to.
MOST_TOKENS = 16
#: Words of each of the two generations of a worker's cache, and the longest one kept there.
CACHED_WORDS = 250_000
CACHED_BYTES = 64

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Characters whose normal form, lower case and kind are the same in every version of Unicode.
_PLAIN = re.compile(r"[\x21-\x7E\u00A1-\u017F]+")
_codecs: dict[str, Codec] = {}


class Codec:
    """A tokenizer file's text as functions on texts, with a cache of the ids of words.

    Only BPE models without dropout whose splits drop white space are taken: for others
    the ids of a text are not those of its parts.
    """

    def __init__(self, spec: str) -> None:
        parsed = json.loads(spec)
        model, added = parsed["model"], parsed.get("added_tokens") or []
        if model.get("type", "BPE") != "BPE" or model.get("dropout"):
            raise ValueError("a BPE model without dropout is needed")
        if any(len(token["content"]) >= MARGIN for token in added):
            raise ValueError("a special token is longer than the margin of the joins")
        vocabulary = model["vocab"] | {token["content"]: token["id"] for token in added}
        self.names = np.full(max(vocabulary.values(), default=-1) + 1, None, object)
        for name, i in vocabulary.items():
            self.names[i] = name
        self.bare = not parsed.get("decoder")
        self.pieces_of = _splitter(parsed)
        self.special = re.compile(b"|".join(re.escape(t["content"].encode()) for t in added) or rb"(?!)")
        self.spec, self.young, self.old, self.pieces = spec, {}, {}, {}

    @functools.cached_property
    def library(self) -> Tokenizer:
        """The library's tokenizer; a worker that only decodes needs none."""
        library = Tokenizer.from_str(self.spec)
        library.no_padding()
        library.no_truncation()
        ids = [e.ids for e in library.encode_batch(["a", "b'", "c", "a b'\t c"], add_special_tokens=False)]
        if [i for part in ids[:3] for i in part] != ids[3]:
            raise ValueError("the tokenizer's splits must drop white space")
        return library

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if self.pieces_of is None or not _PLAIN.fullmatch(text) or self.special.search(word):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()
        known, found = self.pieces, []
        for piece in self.pieces_of(text.lower()):
            if (ids := known.get(piece)) is None:
                if len(known) > CACHED_WORDS:
                    known.clear()
                # The model sees the bytes of a piece as characters.
                seen = piece if piece.isascii() else "".join(map(_BYTES.__getitem__, piece.encode()))
                ids = known[piece] = np.array([t.id for t in self.library.model.tokenize(seen)], np.uint32).tobytes()
            found.append(ids)
        return b"".join(found)

    def words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word as bytes of four; a short word is encoded once while it stays cached."""
        young, old = self.young, self.old
        if len(young) > CACHED_WORDS:
            self.old, self.young = old, young = young, {}
        long = {}
        for word in set(words).difference(young):
            ids = old.get(word)
            if ids is None:
                ids = self._word(word)
            (young if len(word) <= CACHED_BYTES else long)[word] = ids
        return [young[w] if w in young else long[w] for w in words] if long else [young[w] for w in words]

    def ids(self, text: bytes) -> np.ndarray:
        """The ids of a whole text.  White space of ASCII is dropped and joins nothing."""
        return np.frombuffer(b"".join(self.words(text.split())), np.uint32)

    def window(self, text: str, at: int) -> Encoding:
        """The ids of ``text``, which starts at character ``at``, with the places of its tokens."""
        found = self.library.encode(text, add_special_tokens=False)
        spans = np.array(found.offsets, np.int64).reshape(-1, 2) + at
        starts = spans[:, 0].copy()
        starts[1:][spans[:-1, 1] > spans[1:, 0]] = -1  # begins inside a character
        return Encoding(np.array(found.ids, np.uint32), starts, spans[:, 1])

    def leaf(self, text: str, at: int) -> Encoding:
        """As ``window``; of short words only the first token has its place, and no end is told."""
        spans = [m.span() for m in _WORD.finditer(text)]
        words = [text[i:j].encode() for i, j in spans]
        long = {k: self.window(text[i:j], at + i) for k, (i, j) in enumerate(spans) if j - i > CACHED_BYTES}
        encoded = self.words([b"" if k in long else w for k, w in enumerate(words)])
        for k, found in long.items():
            encoded[k] = found.ids.tobytes()
        ids = np.frombuffer(b"".join(encoded), np.uint32)
        counts = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
        first = np.cumsum(counts) - counts
        places = np.full(len(ids), -1, np.int64)
        some = counts > 0
        places[first[some]] = at + np.array([i for i, _ in spans], np.int64)[some]
        for k, found in long.items():
            places[first[k]: first[k] + counts[k]] = found.starts
        return Encoding(ids, places)

    def text(self, ids: np.ndarray) -> str:
        """What the library decodes ``ids`` to, special tokens included; unknown ids are skipped."""
        ids = ids[(ids >= 0) & (ids < len(self.names))]
        if not self.bare:
            return self.library.decode(ids.tolist(), skip_special_tokens=False)
        return " ".join(filter(None, self.names[ids].tolist()))


def _splitter(parsed: dict):
    """The file's split of lower-cased text into pieces, if it is a pattern followed by byte characters."""
    steps = (parsed.get("pre_tokenizer") or {}).get("pretokenizers") or []
    forms = [step["type"] for step in (parsed.get("normalizer") or {}).get("normalizers") or []]
    if [step["type"] for step in steps] != ["Split", "ByteLevel"] or forms != ["NFC", "Replace", "Lowercase"]:
        return None
    split, level = steps
    if split["behavior"] != "Removed" or not split["invert"] or level["add_prefix_space"] or level["use_regex"]:
        return None
    return regex.compile(split["pattern"]["Regex"]).findall if "Regex" in split["pattern"] else None


def _byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next one from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


_BYTES = _byte_characters()


class Encoding:
    """Ids with the character each token starts at (-1: inside a character, or not told)."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray | None = None) -> None:
        self.ids, self.starts, self.ends = ids, starts, ends

    def place(self, start: int, token: int, low: int, high: int) -> int | None:
        """The number, from ``low`` to ``high``, of the token ``token`` that starts at ``start``."""
        low, high = max(low, 0), min(high, len(self.ids))
        for i in np.flatnonzero(self.starts[low:high] == start):
            if self.ids[low + i] == token:
                return low + int(i)
        return None

    def between(self, low: int, high: int) -> Encoding:
        return Encoding(self.ids[low:high], self.starts[low:high])

    def then(self, *others: Encoding) -> Encoding:
        parts = (self, *others)
        return Encoding(np.concatenate([p.ids for p in parts]), np.concatenate([p.starts for p in parts]))


def join_halves(
    codec: Codec, text: str, low: int, cut: int, high: int, left: Encoding, right: Encoding,
    first_window: int = FIRST_WINDOW,
) -> Encoding:
    """The encoding of ``text[low:high]`` from those of its parts before and after ``cut``."""
    width = first_window
    while True:
        near = MOST_TOKENS * width
        start, stop = max(low, cut - width), min(high, cut + width)
        window = codec.window(text[start:stop], start)
        from_left = (0, 0) if start == low else None
        from_right = (len(window.ids), len(right.ids)) if stop == high else None
        if from_left is None:
            fit = (window.starts >= 0) & (window.ends <= cut - MARGIN)
            for i in np.flatnonzero(fit)[::-1].tolist():
                j = left.place(window.starts[i], window.ids[i], len(left.ids) - near, len(left.ids))
                if j is not None and _separates(text[window.ends[i]: cut]):
                    from_left = i, j
                    break
        if from_right is None:
            fit = (window.starts >= cut + MARGIN) & (window.ends <= stop - MARGIN)
            for i in np.flatnonzero(fit).tolist():
                j = right.place(window.starts[i], window.ids[i], 0, near)
                if j is not None and _separates(text[cut: window.starts[i]]):
                    from_right = i, j
                    break
        if from_left and from_right:
            return left.between(0, from_left[1]).then(
                window.between(from_left[0], from_right[0]), right.between(from_right[1], len(right.ids)))
        width *= 2


def _separates(text: str) -> bool:
    return any(unicodedata.combining(c) == 0 for c in text)


def halves(low: int, high: int, leaf_chars: int) -> Iterator[tuple[int, int]]:
    """The leaves of the tree over ``low`` to ``high``, each of at most ``leaf_chars``."""
    if high - low <= leaf_chars:
        yield low, high
    else:
        middle = (low + high) // 2
        yield from halves(low, middle, leaf_chars)
        yield from halves(middle, high, leaf_chars)


def join_tree(codec: Codec, text: str, low: int, high: int, leaves: dict[int, Encoding],
              leaf_chars: int, first_window: int = FIRST_WINDOW) -> Encoding:
    """The encoding of ``text[low:high]`` from ``leaves``, keyed by where each starts."""
    if high - low <= leaf_chars:
        return leaves.pop(low)
    middle = (low + high) // 2
    left = join_tree(codec, text, low, middle, leaves, leaf_chars, first_window)
    right = join_tree(codec, text, middle, high, leaves, leaf_chars, first_window)
    return join_halves(codec, text, low, middle, high, left, right, first_window)


def codec_of(spec: str) -> Codec:
    """The codec of a tokenizer file's text; made once per process."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(spec)
    return _codecs[key]


def _shared_spec(df: DataFrame, path: str):
    """The file's text, read where the driver is; executors get it by broadcast."""
    with open(path, encoding="utf-8") as file:
        spec = file.read()
    codec_of(spec)
    return df.sparkSession.sparkContext.broadcast(spec)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])
    flat = np.concatenate([np.zeros(0, np.uint32), *parts]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat))


def encode_texts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", leaf_chars: int = LEAF_CHARS,
    decoded: str | None = None,
) -> DataFrame:
    """``(id, ids array<int>)`` per row of ``docs``: its whole text in the vocabulary of the file ``path``.

    With ``decoded`` a column of this name has what ``decode_ids`` makes of the ids.

    The ids are those of the file's own library with special tokens found in texts but
    none added, and neither padding nor truncation.  Null text is empty and has no ids.
    Rows that repeat an id or a text, or have no id, each give a row.  Other columns are
    not read; no rows give no rows.
    """
    spec = _shared_spec(docs, path)
    codec_of(spec.value).library  # refuse the file here and not in a task
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    long = F.char_length("_text") > leaf_chars
    out = f"_id {kind}, ids array<int>" + (", _decoded string" if decoded else "")

    def result(codec: Codec, ids: pa.Array, found: list[np.ndarray]) -> dict[str, pa.Array]:
        texts = {"_decoded": pa.array(map(codec.text, found), pa.string())} if decoded else {}
        return {"_id": ids, "ids": _lists(found), **texts}

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(spec.value)
        for batch in batches:
            texts = batch["_text"].cast(pa.large_string()).cast(pa.large_binary())
            for start, stop in slices(texts):
                found = [codec.ids(t) for t in texts[start:stop].to_pylist()]
                yield pa.record_batch(result(codec, batch["_id"][start:stop], found))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch["_text"].to_pylist()):
                spans = list(halves(0, len(text), leaf_chars))
                for k in range(0, len(spans), 64):
                    some = spans[k: k + 64]
                    yield pa.record_batch({
                        "_id": pa.concat_arrays([batch["_id"][i: i + 1]] * len(some)),
                        "_row": pa.concat_arrays([batch["_row"][i: i + 1]] * len(some)),
                        "low": pa.array([low for low, _ in some], pa.int64()),
                        "part": pa.array([text[low:high] for low, high in some], pa.string()),
                    })

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(spec.value)
        for batch in batches:
            for i, (low, part) in enumerate(zip(batch["low"].to_pylist(), batch["part"].to_pylist(), strict=True)):
                found = codec.leaf(part, low)
                yield pa.record_batch({
                    **{c: batch[c][i: i + 1] for c in ("_id", "_row", "low", "part")},
                    "ids": pa.array([found.ids.tobytes()], pa.binary()),
                    "places": pa.array([found.starts.tobytes()], pa.binary()),
                })

    def join(group: pa.Table) -> pa.Table:
        codec = codec_of(spec.value)
        leaves = sorted(zip(group["low"].to_pylist(), group["part"].to_pylist(),
                            group["ids"].to_pylist(), group["places"].to_pylist(), strict=True))
        text = "".join(part for _, part, _, _ in leaves)
        encoded = {low: Encoding(np.frombuffer(ids, np.uint32), np.frombuffer(places, np.int64))
                   for low, _, ids, places in leaves}
        found = join_tree(codec, text, 0, len(text), encoded, leaf_chars)
        return pa.table(result(codec, group["_id"][:1].combine_chunks(), [found.ids]))

    short = rows.filter(~long).mapInArrow(whole, out)
    # The row's number is drawn once: the leaves are stored before anything depends on it.
    leaves = rows.filter(long).withColumn("_row", F.monotonically_increasing_id()).mapInArrow(
        cut, f"_id {kind}, _row long, low long, part string")
    leaves = stored(leaves.repartition("_row", "low"), "leaves")
    joined = leaves.mapInArrow(
        encode, f"_id {kind}, _row long, low long, part string, ids binary, places binary"
    ).groupBy("_row").applyInArrow(join, out)
    return short.unionByName(joined).toDF(id_col, "ids", *([decoded] if decoded else []))


def decode_ids(encoded: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """The rows of ``encoded`` with the text of their ids in a further column ``out``.

    Special tokens are kept, ids that the vocabulary lacks are skipped; null ids give an
    empty text.  A column that is called ``out`` already is replaced.
    """
    spec = _shared_spec(encoded, path)
    encoded = encoded.drop(out)
    schema = StructType([*encoded.schema.fields, StructField(out, StringType())])

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(spec.value)
        for batch in batches:
            lists = batch[ids_col]
            bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())])
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            texts = [codec.text(flat[i:j]) for i, j in zip(bounds, bounds[1:], strict=False)]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out])

    return encoded.mapInArrow(decode, schema)

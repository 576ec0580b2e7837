"""Toxicity: a learnt, weighted lexicon matched by Aho-Corasick on folded text.

Folding lower-cases, maps letters of other scripts that look Latin and digits or signs
used as letters, and removes invisible characters.  The lexicon holds whole words and
beginnings of words with their log-odds of standing in toxic texts.  A text's matches,
less those inside exception phrases, are summed by weight and set against its length in
words; a logistic curve turns that into a score.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispan.llm.shared import forget, stored

SAMPLE_ROWS = 20_000
LEXICON_TERMS = 2_000
CANDIDATE_TERMS = 20_000
MIN_TEXTS = 5
MIN_WEIGHT = 1.2
PURE_WEIGHT = 5.0
PREFIX_LENGTHS = range(4, 9)
FEATURES = 4
_NAMES = [f"f{i}" for i in range(FEATURES)]
_FIELDS = ", ".join(f"{name} double" for name in [*_NAMES, "score"])
# Characters that look like a Latin letter, and signs read as one.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k",
    "ӏ": "l", "м": "m", "н": "h", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y",
    "ѵ": "v", "ԝ": "w", "х": "x", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k",
    "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ɑ": "a", "ɡ": "g", "ı": "i",
    "ʟ": "l", "ո": "n", "օ": "o", "ѡ": "w",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i", "€": "e"}
INVISIBLE = "­​‌‍‎‏⁠﻿"
EXCEPTIONS = ("trash can", "trash cans", "trash bin", "clown fish", "pond scum", "stupid question")
_FULL_WIDTH = {0xFEE0 + i: chr(i).lower() for i in range(0x21, 0x7F)}
_OTHER_ASCII = {i: " " for i in range(128) if not chr(i).isalnum()}
_TABLE = (
    _FULL_WIDTH | _OTHER_ASCII | {ord(a): b for a, b in (HOMOGLYPHS | DIGITS).items()}
    | dict.fromkeys(map(ord, INVISIBLE))
)
_SIGN = re.compile(r"(?<=\w)[@$!|€](?=\w)")


def fold(text: str) -> str:
    """``text`` as the lexicon is written: letters, everything else of ASCII a blank.

    A sign is read as a letter only between letters or digits.
    """
    text = text.lower()
    if any(sign in text for sign in SIGNS):
        text = _SIGN.sub(lambda m: SIGNS[m[0]], text)
    return f" {text.translate(_TABLE)} "


def terms_of(folded: str) -> set[str]:
    """The words, as ``' word '``, and word beginnings, as ``' begin'``, of a folded text."""
    words = set(folded.split())
    found = {f" {w} " for w in words if len(w) > 2}
    found.update(f" {w[:k]}" for w in words for k in PREFIX_LENGTHS if len(w) > k)
    return found


@dataclass(frozen=True)
class Model:
    """The lexicon ``{term: weight}``, its exceptions and the curve's coefficients."""

    lexicon: dict[str, float]
    exceptions: tuple[str, ...]
    coefficients: tuple[float, ...]

    @functools.cached_property
    def automaton(self):
        import ahocorasick

        machine = ahocorasick.Automaton()
        for term, weight in self.lexicon.items():
            machine.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            folded = fold(phrase)
            machine.add_word(folded, (len(folded), 0.0))
        if len(machine):
            machine.make_automaton()
        return machine

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "automaton"}

    def features(self, text: str | None) -> tuple[float, ...]:
        """Matches per 1,000 words: pure terms by weight, whether there is one, the rest by
        weight and by number."""
        folded = fold(text or "")
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        if self.lexicon:
            for end, (length, weight) in self.automaton.iter(folded):
                start = end - length + 1
                if weight == 0.0:
                    spared.append((start, end))
                elif weight > best.get(start, 0.0):
                    best[start] = weight
        for start, end in spared:
            for inside in [s for s in best if start <= s < end]:
                del best[inside]
        words = max(1, folded.count(" ") if not best else len(folded.split()))
        pure = sum(w for w in best.values() if w >= PURE_WEIGHT)
        rest = [w for w in best.values() if w < PURE_WEIGHT]
        return (
            math.log1p(1000 * pure / words), float(pure > 0),
            math.log1p(1000 * sum(rest) / words), math.log1p(1000 * len(rest) / words),
        )

    def score(self, features: np.ndarray) -> np.ndarray:
        z = self.coefficients[0] + features @ np.array(self.coefficients[1:])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def held_out(id_column: Column) -> Column:
    return F.crc32(id_column.cast("string")) % 5 == 0


def _count_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    toxic, clean = Counter(), Counter()
    for batch in batches:
        for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist(), strict=True):
            (toxic if label else clean).update(terms_of(fold(text or "")))
    terms = list(toxic.keys() | clean.keys())
    for i in range(0, len(terms), 50_000):
        part = terms[i: i + 50_000]
        yield pa.record_batch({
            "term": pa.array(part, pa.string()),
            "toxic": pa.array([toxic[t] for t in part], pa.int64()),
            "clean": pa.array([clean[t] for t in part], pa.int64()),
        })


def _choose(candidates: list, n_toxic: int, n_clean: int) -> dict[str, float]:
    """Terms by weight; a longer beginning only if it weighs clearly more than its own beginning."""
    lexicon: dict[str, float] = {}
    weighed = sorted(
        ((r.term, math.log((r.toxic + 0.5) / (n_toxic + 1)) - math.log((r.clean + 0.5) / (n_clean + 1)))
         for r in candidates),
        key=lambda x: (len(x[0]), x[0]),
    )
    for term, weight in weighed:
        shorter = max((lexicon.get(term[:k], 0.0) for k in range(4, len(term))), default=0.0)
        if weight >= MIN_WEIGHT and weight > shorter + 1.0:
            lexicon[term] = round(weight, 4)
    most = sorted(lexicon.items(), key=lambda x: (-x[1], x[0]))[:LEXICON_TERMS]
    return dict(most)


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> tuple[float, ...]:
    """Coefficients, the constant first, by Newton steps with a small ridge."""
    full = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(full.shape[1])
    ridge = np.diag([1e-3] + [penalty] * x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -30, 30)))
        step = np.linalg.solve(
            (full * (p * (1 - p))[:, None]).T @ full + ridge, full.T @ (p - y) + ridge @ w)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS,
    exceptions: tuple[str, ...] = EXCEPTIONS,
) -> Model:
    """Learn from at most ``sample_rows`` labelled documents, chosen by a hash of the id.

    Labels whose id falls to the held-out fifth are never read, nor are null ids, null
    labels and any other column of ``docs``.  Without a toxic or without a clean
    document in the sample the lexicon is empty and every score is that share of toxic.
    """
    sample = labels.filter(
        F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col))
    ).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")).dropDuplicates(["_id"])
    sample = sample.orderBy(F.md5(F.col("_id").cast("string")), "_id").limit(sample_rows)
    train = stored(
        docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
        .join(F.broadcast(sample), "_id").select("text", "label"),
        "toxicity-sample",
    )
    counts = {r.label: r["count"] for r in train.groupBy("label").count().collect()}
    n_toxic, n_clean = counts.get(1, 0), counts.get(0, 0)
    if not n_toxic or not n_clean:
        share = (n_toxic + 0.5) / (n_toxic + n_clean + 1)
        return Model({}, exceptions, (math.log(share / (1 - share)), *[0.0] * FEATURES))
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    candidates = (
        train.mapInArrow(_count_terms, "term string, toxic long, clean long").groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter(F.col("toxic") >= MIN_TEXTS).orderBy((odds * F.sqrt("toxic")).desc(), "term")
        .limit(CANDIDATE_TERMS).collect()
    )
    lexicon = Model(_choose(candidates, n_toxic, n_clean), exceptions, (0.0,) * (FEATURES + 1))
    known = train.mapInArrow(_scorer(lexicon, "label"), f"label int, {_FIELDS}").toPandas()
    forget(train)
    curve = _logistic(known[_NAMES].to_numpy(), known["label"].to_numpy(float))
    return Model(lexicon.lexicon, exceptions, curve)


def _features(model: Model, texts: pa.Array) -> np.ndarray:
    return np.array([model.features(t) for t in texts.to_pylist()], float).reshape(-1, FEATURES)


def _scorer(model: Model, *kept: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features = _features(model, batch["text"])
            columns = {name: batch[name] for name in kept}
            columns |= {name: features[:, i] for i, name in enumerate(_NAMES)}
            yield pa.record_batch(columns | {"score": model.score(features)})

    return run


def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score, predicted)`` per row of ``docs``, from the whole text and nothing else.

    ``score`` rises with toxicity in 0 to 1; null text scores as empty.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    scored = texts.mapInArrow(_scorer(model, "_id"), f"_id {kind}, {_FIELDS}")
    return scored.select(
        F.col("_id").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model does not predict to be toxic; all columns as they were."""
    schema = docs.schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            yield batch.filter(pa.array(model.score(_features(model, texts)) < 0.5))

    return docs.mapInArrow(run, schema)

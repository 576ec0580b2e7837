"""Text expressions: tokens, n-grams, templates, parsed model replies.

All of them are built-in expressions over one row: no shuffle and no Python
worker, in batch and in streaming queries alike.
"""

from __future__ import annotations

import string
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexispan.functions.stopwords import ENGLISH_STOP_WORDS

# Characters that separate tokens, in regular-expression form.
SEPARATORS = r"""\s;@#$%&?!"()\[\]{}<>,:"""

# Contraction endings that are split off a word.
CONTRACTIONS = ["n't", "'s", "'m", "'d", "'ll", "'re", "'ve"]

# One scan of the text yields the words.  A word is a run of letters between
# separators; one contraction ending and then closing dots or quotes may follow.
# The first branch never gives letters back, so only words before "n't" backtrack.
WORD = (
    rf"(?<![^{SEPARATORS}])"
    r"(\p{L}++(?<!n(?='t))|\p{L}+(?=n't))"
    rf"(?:{'|'.join(CONTRACTIONS)})?[.'`]*"
    rf"(?![^{SEPARATORS}])"
)


def words(text: Column) -> Column:
    """Lower-case alphabetic words of a text, in order (``array<string>``)."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), 1)


def is_stop_word(token: Column, stop_words: Iterable[str] = ENGLISH_STOP_WORDS) -> Column:
    return token.isin(*stop_words)


def content_words(text: Column, stop_words: Iterable[str] = ENGLISH_STOP_WORDS) -> Column:
    """``words`` without the stop words."""
    return F.filter(words(text), lambda t: ~is_stop_word(t, stop_words))


def ngrams(tokens: Column, n: int, separator: str = "_") -> Column:
    """Runs of ``n`` neighbouring tokens; an empty array when there are fewer."""
    if n == 1:
        return tokens
    last = F.size(tokens) - n
    return F.when(
        last >= 0,
        F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.concat_ws(separator, *[F.get(tokens, i + k) for k in range(n)]),
        ),
    ).otherwise(F.array().cast("array<string>"))


def ngram_range(tokens: Column, low: int, high: int, separator: str = "_") -> Column:
    """All n-grams for ``n`` from ``low`` to ``high``, the shorter ones first."""
    return F.concat(*[ngrams(tokens, n, separator) for n in range(low, high + 1)])


def template_parts(template: str) -> list[tuple[str, str | None]]:
    """Split ``"a {b} c"`` into ``[("a ", "b"), (" c", None)]``; ``{{`` is a brace."""
    parts = []
    for literal, name, spec, conversion in string.Formatter().parse(template):
        if spec or conversion:
            raise ValueError(f"only plain names may stand in braces: {template!r}")
        parts.append((literal, name))
    return parts


def template_variables(template: str) -> list[str]:
    return [name for _, name in template_parts(template) if name is not None]


def render_template(template: str) -> Column:
    """The template with each ``{name}`` replaced by the column of that name."""
    pieces: list[Column] = []
    for literal, name in template_parts(template):
        if literal:
            pieces.append(F.lit(literal))
        if name is not None:
            pieces.append(F.coalesce(F.col(name).cast("string"), F.lit("")))
    return F.concat(*pieces) if pieces else F.lit("")


def parse_route(reply: Column) -> Column:
    """``struct<destination, next_inputs>`` from the JSON object inside a reply.

    Null fields when the reply holds no JSON object.
    """
    body = F.regexp_extract(reply, r"(?s)\{.*\}", 0)
    return F.from_json(body, "destination string, next_inputs string")


def parse_list(literal: Column) -> Column:
    """Read a stored list of strings, such as ``["a", "b"]`` or ``['a', 'b']``."""
    return F.from_json(literal, "array<string>", {"allowSingleQuotes": "true"})


def cut_prefix(text: Column, length: int = 512) -> Column:
    """The first ``length`` characters, the input limit of a scoring model."""
    return F.substring(text, 1, length)


def char_slice(text: Column, start: Column, end: Column) -> Column:
    """Characters ``start`` (0-based) up to, not including, ``end``."""
    return F.substring(text, start + 1, end - start)

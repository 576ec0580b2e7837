"""Parts of the checking SQL (DuckDB): the input derivations, written independently.

Tokens are cleaned one by one here, while the library scans the text once; lemmas
are looked up from surface form to base form, while the library goes the other way.
"""

from __future__ import annotations

from lexispan.functions.stopwords import ENGLISH_STOP_WORDS
from lexispan.operators.lookup import NOUN_ENDINGS


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(values) -> str:
    return ", ".join(quoted(v) for v in values)


STOP_LIST = listed(ENGLISH_STOP_WORDS)
_PIECES = r"""string_split_regex(lower(text), '[\s;@#$%&?!"()\[\]{}<>,:]+')"""
_STRIPPED = (
    r"regexp_replace(regexp_replace(t, '[.''`]+$', ''), "
    r"'(n''t|''s|''m|''d|''ll|''re|''ve)$', '')"
)

ALL_WORDS = rf"""list_filter(list_transform({_PIECES}, lambda t: {_STRIPPED}),
                     lambda t: regexp_full_match(t, '\p{{L}}+'))"""

# Every document with its words, then without stop words.
NEWS = f"""
news AS (
  SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN -1 ELSE 1 END AS label,
         {ALL_WORDS} AS all_words
  FROM documents WHERE text IS NOT NULL),
words AS (
  SELECT doc_id, label,
         list_filter(all_words, lambda t: t NOT IN ({STOP_LIST})) AS tokens
  FROM news)"""

_CANDIDATES = "\n".join(
    f"  UNION ALL SELECT word, left(word, length(word) - {len(e)}) || '{b}' "
    f"FROM lexicon WHERE word LIKE '%{e}'"
    for e, b in NOUN_ENDINGS
)

# The corpus vocabulary is its own lexicon.
LEMMAS = f"""
lexicon AS (SELECT DISTINCT unnest(tokens) AS word FROM words),
candidates AS (
  SELECT word, word AS lemma FROM lexicon
{_CANDIDATES}),
lemmas AS (
  SELECT word, min({{'n': length(lemma), 'lemma': lemma}}).lemma AS lemma
  FROM candidates WHERE lemma IN (SELECT word FROM lexicon) GROUP BY word)"""

# ``clean(doc_id, label, tokens)``: lemmatised words in order.
CLEAN = f"""{NEWS}, {LEMMAS},
flat AS (
  SELECT doc_id, unnest(tokens) AS word, generate_subscripts(tokens, 1) AS i FROM words),
clean AS (
  SELECT w.doc_id, any_value(w.label) AS label,
         coalesce(list(l.lemma ORDER BY f.i) FILTER (WHERE f.i IS NOT NULL), []) AS tokens
  FROM words w LEFT JOIN flat f ON w.doc_id = f.doc_id LEFT JOIN lemmas l ON f.word = l.word
  GROUP BY w.doc_id)"""


def grams(tokens: str, n: int) -> str:
    """List of n-grams of a token list."""
    if n == 1:
        return tokens
    parts = " || '_' || ".join(f"{tokens}[i + {k}]" for k in range(n))
    return (
        f"list_transform(range(1, greatest(len({tokens}) - {n - 2}, 1)), lambda i: {parts})"
    )


def vocabulary(source: str, terms: str, top_n: int, name: str = "vocab") -> str:
    """CTE ``name(idx, term, cnt)``."""
    return f"""
{name} AS (
  SELECT CAST(row_number() OVER (ORDER BY cnt DESC, term) - 1 AS INTEGER) AS idx, term, cnt
  FROM (SELECT term, count(*) AS cnt FROM (SELECT unnest({terms}) AS term FROM {source})
        GROUP BY term ORDER BY cnt DESC, term LIMIT {top_n}))"""


def tfidf(fit: str, apply: str, top_n: int) -> str:
    """CTEs ``vocab``, ``idf`` and ``entries``, learned on ``fit``, for ``apply``."""
    return f"""{vocabulary(fit, 'tokens', top_n)},
idf AS (
  SELECT v.idx, v.term, v.cnt, CAST(count(d.doc_id) AS BIGINT) AS df,
         ln(((SELECT count(*) FROM {fit}) + 1) / (count(d.doc_id) + 1)) + 1 AS idf
  FROM vocab v LEFT JOIN (
    SELECT DISTINCT doc_id, unnest(tokens) AS term FROM {fit}) d ON v.term = d.term
  GROUP BY v.idx, v.term, v.cnt),
counted AS (
  SELECT doc_id, term, count(*) AS cnt, any_value(n) AS n
  FROM (SELECT doc_id, unnest(tokens) AS term, len(tokens) AS n FROM {apply})
  GROUP BY doc_id, term),
entries AS (
  SELECT doc_id, idx, i.term, c.cnt, c.cnt / n AS tf, c.cnt / n * idf AS tfidf,
         c.cnt / n * idf / sqrt(sum(pow(c.cnt / n * idf, 2)) OVER (PARTITION BY doc_id))
           AS tfidf_l2
  FROM counted c JOIN idf i ON c.term = i.term)"""


EMBEDDING = """
embedding AS (
  SELECT word, embedding AS vec
  FROM (SELECT word, CAST('0x' || left(md5(word), 8) AS BIGINT)
                     % (SELECT count(*) FROM embeddings) AS vec_id
        FROM (SELECT DISTINCT unnest(tokens) AS word FROM clean)
        WHERE substr(md5(word), 9, 1) < 'e') k
  JOIN embeddings e ON k.vec_id = e.vec_id)"""

REVIEWS = """
reviews AS (
  SELECT d.doc_id, d.text,
         CASE WHEN quality = 1 THEN (CASE WHEN toxic = 1 THEN 4 ELSE 5 END)
              WHEN d.doc_id % 3 = 0 THEN 3 ELSE 1 END AS score
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
sentiment AS (
  SELECT doc_id, score, text, CASE WHEN score > 3 THEN 1 ELSE 0 END AS label
  FROM reviews WHERE score <> 3 AND text IS NOT NULL),
balanced AS (
  SELECT doc_id, text, label FROM (
    SELECT *, row_number() OVER (PARTITION BY label
                                 ORDER BY md5('42:' || doc_id), doc_id) AS r
    FROM sentiment)
  WHERE r <= (SELECT min(n) FROM (SELECT count(*) AS n FROM sentiment GROUP BY label)))"""

PREDICTIONS = """
predictions AS (
  SELECT doc_id, quality AS y, 1 - toxic AS pred FROM labels)"""

MODEL_PREDICTIONS = f"""{PREDICTIONS},
by_model AS (
  SELECT 'not_toxic' AS model, doc_id, y, pred FROM predictions
  UNION ALL SELECT 'perfect', doc_id, y, y FROM predictions
  UNION ALL SELECT 'never', doc_id, y, 0 FROM predictions
  UNION ALL SELECT 'by_id', doc_id, y, CAST(doc_id % 2 AS INTEGER) FROM predictions)"""


def binary_report(source: str, group: str = "") -> str:
    """SELECT of the report over ``source``, optionally per ``group`` column."""
    lead = f"{group}, " if group else ""
    by = f"GROUP BY {group}" if group else ""
    return f"""
SELECT {lead}n, tp, fp, fn, coalesce(correct / nullif(n, 0), 0) AS accuracy,
       p AS precision, r AS recall, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f1
FROM (
  SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS p,
         coalesce(tp / nullif(tp + fn, 0), 0) AS r
  FROM (
    SELECT {lead}count(*) AS n, count(*) FILTER (WHERE y = pred) AS correct,
           count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp,
           count(*) FILTER (WHERE y = 0 AND pred = 1) AS fp,
           count(*) FILTER (WHERE y = 1 AND pred = 0) AS fn
    FROM {source} {by}))"""


def normalized(text: str) -> str:
    """Answer normalisation of a SQL expression."""
    word = r"\p{L}\p{M}\p{N}_"
    article = rf"(^|[^{word}])(a|an|the)($|[^{word}])"
    bare = rf"regexp_replace(lower({text}), '[!-/:-@\[-`{{-~]', '', 'g')"
    for _ in range(2):
        bare = rf"regexp_replace({bare}, '{article}', '\1 \3', 'g')"
    return rf"trim(regexp_replace({bare}, '[\s\p{{Z}}\x0b\x1c-\x1f\x85]+', ' ', 'g'))"


QA = """
qa_source AS (
  SELECT d.doc_id, l.quality = 1 AS has, string_split(d.text, ' ') AS ws, d.text, d.source
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
ws AS (
  SELECT *, doc_id * 7919 % len(ws) AS pos, doc_id % 60 + 1 AS n FROM qa_source),
gold AS (
  SELECT doc_id AS qid, has AS has_ans,
         CASE WHEN has THEN [array_to_string(ws[pos + 1 : pos + n], ' '),
                             array_to_string(ws[pos + 1 : pos + (n + 1) // 2], ' ')]
              ELSE [] END AS golds
  FROM ws),
preds AS (
  SELECT doc_id AS qid,
         CASE WHEN doc_id % 5 = 0 THEN ''
              WHEN doc_id % 3 = 0 THEN array_to_string(ws[pos + 2 : pos + n + 1], ' ')
              ELSE array_to_string(ws[pos + 1 : pos + n], ' ') END AS pred
  FROM ws WHERE doc_id % 11 <> 0),
na AS (
  SELECT doc_id AS qid,
         ((doc_id * 37) % 101 + CASE WHEN quality = 1 THEN 0 ELSE 40 END) / CAST(100 AS DOUBLE)
           AS na_prob
  FROM labels)"""

# ``scores(qid, has_ans, pred, exact, f1, na_prob)`` of answered questions.
SCORES = f"""{QA},
forms AS (
  SELECT qid, {normalized('g')} AS form FROM (SELECT qid, unnest(golds) AS g FROM gold)),
targets AS (
  SELECT qid, form FROM forms WHERE form <> ''
  UNION
  SELECT qid, '' FROM gold WHERE qid NOT IN (SELECT qid FROM forms WHERE form <> '')),
pairs AS (
  SELECT g.qid, t.form, p.pred, {normalized('p.pred')} AS answer
  FROM gold g JOIN targets t ON g.qid = t.qid JOIN preds p ON g.qid = p.qid),
gold_bag AS (
  SELECT qid, form, tok, count(*) AS n FROM (
    SELECT qid, form, unnest(string_split(form, ' ')) AS tok FROM pairs WHERE form <> '')
  GROUP BY qid, form, tok),
pred_bag AS (
  SELECT qid, tok, count(*) AS n FROM (
    SELECT DISTINCT qid, answer FROM pairs WHERE answer <> '') q,
    LATERAL (SELECT unnest(string_split(q.answer, ' ')) AS tok)
  GROUP BY qid, tok),
overlap AS (
  SELECT g.qid, g.form, sum(least(g.n, p.n)) AS same
  FROM gold_bag g JOIN pred_bag p ON g.qid = p.qid AND g.tok = p.tok GROUP BY g.qid, g.form),
sized AS (
  SELECT p.*, coalesce(o.same, 0) AS same,
         CASE WHEN p.form = '' THEN 0 ELSE len(string_split(p.form, ' ')) END AS ng,
         CASE WHEN answer = '' THEN 0 ELSE len(string_split(answer, ' ')) END AS np
  FROM pairs p LEFT JOIN overlap o ON p.qid = o.qid AND p.form = o.form),
raw_scores AS (
  SELECT qid, any_value(pred) AS pred,
         max(CASE WHEN form = answer THEN 1 ELSE 0 END) AS exact,
         max(CASE WHEN ng = 0 OR np = 0 THEN (CASE WHEN ng = np THEN 1.0 ELSE 0.0 END)
                  WHEN same = 0 THEN 0.0
                  ELSE 2 * (same / np) * (same / ng) / (same / np + same / ng) END) AS f1
  FROM sized GROUP BY qid),
scores AS (
  SELECT r.qid, g.has_ans, r.pred, r.exact, r.f1, n.na_prob
  FROM raw_scores r JOIN gold g ON r.qid = g.qid LEFT JOIN na n ON r.qid = n.qid)"""

# ``windows(doc_id, window_idx, first_token, last_token, shift, ..)`` of all documents,
# and ``tokens(doc_id, i, s, e)`` with character offsets.
WINDOWS = """
pieces AS (
  SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS k
  FROM (SELECT doc_id, string_split_regex(text, '[ \\n\\t]') AS p FROM examples)),
placed AS (
  SELECT doc_id, k, length(piece) AS n,
         CAST(coalesce(sum(length(piece) + 1) OVER (PARTITION BY doc_id ORDER BY k
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS s
  FROM pieces),
tokens AS (
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS INTEGER) AS i,
         s, CAST(s + n AS INTEGER) AS e
  FROM placed WHERE n > 0),
sizes AS (
  SELECT x.doc_id, x.q, 384 - x.q - 3 AS cap, 384 - x.q - 3 - 128 AS step,
         coalesce(t.n, 0) AS n
  FROM (SELECT doc_id, len(list_filter(string_split_regex(question, '[ \\n\\t]'),
                                       lambda t: t <> '')) AS q FROM examples) x
  LEFT JOIN (SELECT doc_id, count(*) AS n FROM tokens GROUP BY doc_id) t
    ON x.doc_id = t.doc_id),
windows AS (
  SELECT doc_id, CAST(w AS INTEGER) AS window_idx, CAST(w * step AS INTEGER) AS first_token,
         CAST(least(w * step + cap, n) AS INTEGER) AS end_token,
         CAST(q + 2 AS INTEGER) AS shift
  FROM (SELECT *, unnest(range(CASE WHEN n <= cap THEN 1
                                    ELSE CAST(ceil((n - cap) / step) AS BIGINT) + 1 END)) AS w
        FROM sizes))"""

DOC_EXAMPLES = """
examples AS (
  SELECT doc_id, text, array_to_string(string_split(text, ' ')[1:7], ' ') AS question
  FROM documents)"""

QA_EXAMPLES = f"""{QA},
examples AS (
  SELECT doc_id, text, array_to_string(ws[1:7], ' ') AS question,
         CASE WHEN doc_id % 7 <> 0 THEN source END AS title,
         has AND len(ws) > 5 AS has_answer,
         array_to_string(ws[pos + 1 : pos + n], ' ') AS answer,
         CAST(CASE WHEN pos > 0 THEN length(array_to_string(ws[1 : pos], ' ')) + 1 ELSE 0 END
              AS INTEGER) AS answer_start
  FROM ws)"""

# ``spans(doc_id, window_idx, text, score, na_score)`` of the derived scores.
SPANS = f"""{DOC_EXAMPLES}, {WINDOWS},
logits AS (
  SELECT doc_id, window_idx, first_token, end_token, shift,
         list_transform(range(384), lambda i:
           (doc_id * 31 + i * 17 + window_idx * 7) % 101 / CAST(10 AS DOUBLE)) AS a,
         list_transform(range(384), lambda i:
           (doc_id * 13 + i * 29 + window_idx * 11) % 103 / CAST(10 AS DOUBLE)) AS b
  FROM windows),
ends AS (
  SELECT *, list_position(a, list_max(a)) - 1 AS pa, list_position(b, list_max(b)) - 1 AS pb
  FROM logits),
ordered AS (SELECT *, least(pa, pb) AS pf, greatest(pa, pb) AS pt FROM ends),
spans AS (
  SELECT o.doc_id, o.window_idx, a[pf + 1] + b[pt + 1] AS score, a[1] + b[1] AS na_score,
         CASE WHEN coalesce(te.e, 0) > coalesce(ts.s, 0)
              THEN substr(x.text, coalesce(ts.s, 0) + 1, coalesce(te.e, 0) - coalesce(ts.s, 0))
              ELSE '' END AS text
  FROM ordered o JOIN examples x ON o.doc_id = x.doc_id
  LEFT JOIN tokens ts ON ts.doc_id = o.doc_id AND ts.i = o.first_token + pf - shift
    AND ts.i >= o.first_token AND ts.i < o.end_token
  LEFT JOIN tokens te ON te.doc_id = o.doc_id AND te.i = o.first_token + pt - shift
    AND te.i >= o.first_token AND te.i < o.end_token)"""

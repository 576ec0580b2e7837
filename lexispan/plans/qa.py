"""Queries over QA sets: answers, evaluation, context windows, span selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispan.functions import tables
from lexispan.functions.answers import answer_tokens as tokens_of_answer
from lexispan.functions.answers import normalize_answer as normal_form
from lexispan.functions.arrays import attention_mask, pad_or_cut
from lexispan.operators import qa_eval, qa_select, qa_windows
from lexispan.plans import inputs, sql
from lexispan.session import keep
from lexispan.sources.qa import answerable, flatten_articles, nest_examples
from lexispan.sources.scratch import new_path
from lexispan.sources.tables import bucketed

THRESHOLD = 1.0
QA_BUCKETS = 32
PADDED_LENGTH = 512


def _joined(values: Column, separator: str = " ") -> Column:
    return F.array_join(values, separator)


def _six(name: str) -> Column:
    return F.round(F.col(name).cast("double"), 6).alias(name)


def normalize_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.documents(spark, sf_dir, "doc_id", "text")
    return docs.select("doc_id", normal_form(F.col("text")).alias("normalized"))


def answer_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.documents(spark, sf_dir, "doc_id", "text")
    tokens = docs.select("doc_id", tokens_of_answer(F.col("text")).alias("tokens"))
    return tokens.select(
        "doc_id", F.size("tokens").alias("n_tokens"), _joined(F.col("tokens"), "|").alias("tokens")
    )


def qa_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Examples nested by title and flattened again."""
    return flat_rows(flatten_articles(nest_examples(inputs.qa_examples(spark, sf_dir))))


def flat_rows(questions: DataFrame) -> DataFrame:
    """Flat questions with their first answer."""
    return questions.select(
        "id", "title", "question", "context", "has_ans",
        F.coalesce(F.get("answers.text", F.lit(0)), F.lit("")).alias("answer"),
        F.coalesce(F.get("answers.answer_start", F.lit(0)), F.lit(-1)).alias("answer_start"),
    )


def qa_nest(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = nest_examples(inputs.qa_examples(spark, sf_dir))
    first = F.transform("paragraphs", lambda p: F.get(p["qas"], F.lit(0)))
    return nested.select("title", first.alias("qas")).select(
        "title", F.size("qas").alias("n_paragraphs"),
        F.size(F.filter("qas", lambda q: q["is_impossible"])).alias("n_impossible"),
        _joined(F.transform("qas", lambda q: q["id"])).alias("ids"),
    )


def qa_answerable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answerable(inputs.qa_examples(spark, sf_dir)).select(
        "id", F.get("answers.text", F.lit(0)).alias("answer")
    )


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa_eval.raw_scores(
        inputs.qa_gold(spark, sf_dir), inputs.qa_predictions(spark, sf_dir)
    )


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa_eval.with_na_prob(_raw(spark, sf_dir), inputs.qa_na_probs(spark, sf_dir))


def _kept_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persisted, since a global order is built in several passes over the scores."""
    return keep(_scored(spark, sf_dir))


def qa_raw_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).select("qid", "has_ans", "exact", _six("f1"))


def qa_missing_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa_eval.missing_predictions(
        inputs.qa_gold(spark, sf_dir), inputs.qa_predictions(spark, sf_dir)
    )


def qa_threshold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _threshold_columns(qa_eval.threshold_scores(_scored(spark, sf_dir), THRESHOLD))


def _threshold_columns(scores: DataFrame) -> DataFrame:
    return scores.select("qid", "has_ans", _six("na_prob"), _six("exact"), _six("f1"))


def _metric(metrics: DataFrame) -> DataFrame:
    return metrics.select("metric", _six("value"))


def qa_eval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = qa_eval.threshold_scores(_scored(spark, sf_dir), THRESHOLD)
    return _metric(qa_eval.summary(scores))


def qa_bucketed_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as ``qa_threshold_scores``, from stored tables that are joined as they lie."""
    inputs_of = {"gold": inputs.qa_gold, "predictions": inputs.qa_predictions, "na_probs": inputs.qa_na_probs}
    gold, predictions, na_probs = (
        bucketed(make(spark, sf_dir), f"qa_{name}", "qid", QA_BUCKETS, new_path(spark, f"qa-{name}"))
        for name, make in inputs_of.items())
    scores = qa_eval.with_na_prob(qa_eval.raw_scores(gold, predictions), na_probs)
    return _threshold_columns(qa_eval.threshold_scores(scores, THRESHOLD))


def qa_eval_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of all questions, by answerability, by title, and by both."""
    titles = inputs.qa_examples(spark, sf_dir).select(
        F.col("id").cast("bigint").alias("qid"), F.coalesce("title", F.lit("default")).alias("title"))
    scores = qa_eval.threshold_scores(_scored(spark, sf_dir), THRESHOLD).join(titles, "qid")
    cut = qa_eval.summary_by(scores, [[], ["has_ans"], ["title"], ["has_ans", "title"]])
    return cut.select("slice", "has_ans", "title", "total", _six("exact"), _six("f1"))


def packed_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a source and thousand put end to end and cut into windows of 512 words, by SQL."""
    tables.register(spark)
    words = inputs.documents(spark, sf_dir, "doc_id", "source", "text").select(
        "doc_id", "source", F.floor(F.col("doc_id") / 1000).alias("part"),
        F.size(F.split(F.coalesce("text", F.lit("")), " ")).alias("n_words"))
    return spark.sql("""SELECT * FROM pack_words(
        TABLE(SELECT * FROM {words}) PARTITION BY (source, part) ORDER BY (doc_id),
        'source,part', 'doc_id', 'n_words', 512)""", words=words)


def qa_answerable_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of the answerable questions alone, without no-answer scores."""
    gold = qa_eval.with_has_ans(inputs.qa_gold(spark, sf_dir)).filter("has_ans")
    scores = qa_eval.restrict_to(_raw(spark, sf_dir), gold)
    return _metric(qa_eval.summary(qa_eval.threshold_scores(
        qa_eval.with_na_prob(scores, None), THRESHOLD
    )))


def _answerable(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    return qa_eval.class_sizes(inputs.qa_gold(spark, sf_dir))


def qa_pr_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    yes, _ = _answerable(spark, sf_dir)
    points = qa_eval.pr_points(_kept_scores(spark, sf_dir), yes)
    names = [f"{k}_{n}" for n in ("exact", "f1", "oracle") for k in ("precision", "recall")]
    return points.select(F.coalesce("na_prob", F.lit(-1.0)).alias("na_prob"), *map(_six, names))


def qa_pr_ap(spark: SparkSession, sf_dir: str) -> DataFrame:
    yes, _ = _answerable(spark, sf_dir)
    return _metric(qa_eval.average_precision(qa_eval.pr_points(_kept_scores(spark, sf_dir), yes)))


def qa_best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, no = _answerable(spark, sf_dir)
    return _metric(qa_eval.best_thresholds(_kept_scores(spark, sf_dir), no))


def qa_na_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = qa_eval.na_histogram(_scored(spark, sf_dir))
    return bins.select("has_ans", F.col("bin").cast("int").alias("bin"), _six("share"))


def qa_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The complete record: summary, best thresholds and average precision."""
    return _metric(qa_eval.evaluate(
        inputs.qa_gold(spark, sf_dir), inputs.qa_predictions(spark, sf_dir),
        inputs.qa_na_probs(spark, sf_dir), THRESHOLD,
    ))


def token_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.documents(spark, sf_dir, "doc_id", "text")
    placed = docs.select("doc_id", qa_windows.token_offsets(F.col("text")).alias("o"))
    # The outer form: see lexispan.operators.unnest.
    numbered = placed.select("doc_id", F.posexplode_outer("o").alias("i", "o"))
    return numbered.filter("i IS NOT NULL").select("doc_id", "i", "o.s", "o.e")


def context_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = qa_windows.context_windows(
        inputs.window_examples(spark, sf_dir), "doc_id",
        max_length=inputs.MAX_LENGTH, stride=inputs.STRIDE,
    )
    return windows.select(
        "doc_id", "window_idx", "first_token", "shift", F.size("offsets").alias("n_tokens"),
        F.coalesce(F.get("offsets.s", F.lit(0)), F.lit(-1)).alias("first_char"),
        F.coalesce(F.get("offsets.e", F.size("offsets") - 1), F.lit(-1)).alias("end_char"),
    )


def answer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa_windows.train_features(
        inputs.qa_examples(spark, sf_dir), "id",
        max_length=inputs.MAX_LENGTH, stride=inputs.STRIDE,
    ).select("id", "window_idx", "start_position", "end_position")


def eval_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = qa_windows.eval_features(
        inputs.window_examples(spark, sf_dir), "doc_id",
        max_length=inputs.MAX_LENGTH, stride=inputs.STRIDE,
    )
    pairs = F.transform("offsets", lambda o: F.concat_ws(":", o["s"], o["e"]))
    return features.select(
        "doc_id", "window_idx", "context", _joined(pairs).alias("offsets")
    )


def pad_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.documents(spark, sf_dir, "doc_id", "text").select(
        "doc_id", qa_windows.token_texts(F.col("text")).alias("tokens")
    )
    tokens = F.col("tokens")
    mask = F.transform(attention_mask(tokens, PADDED_LENGTH), lambda m: m.cast("string"))
    return docs.select(
        "doc_id", _joined(pad_or_cut(tokens, PADDED_LENGTH, F.lit("[PAD]"))).alias("padded"),
        _joined(mask, "").alias("mask"),
    )


def span_best_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = qa_select.best_window(inputs.window_logits(spark, sf_dir))
    return best.select("example_id", "text", _six("score"))


def span_last_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = qa_select.last_window(inputs.window_logits(spark, sf_dir), -18.0)
    return last.select("example_id", "text", _six("na_prob"))


def span_no_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = qa_select.no_answer_decisions(inputs.window_logits(spark, sf_dir), -18.0)
    return decided.select(
        "example_id", "window_idx", "text", _six("score"), _six("na_score"), "answer"
    )


QUERIES = {f.__name__: f for f in [
    normalize_answer, answer_tokens, qa_flatten, qa_nest, qa_answerable, qa_raw_scores,
    qa_missing_predictions, qa_threshold_scores, qa_eval_slices, qa_bucketed_scores, packed_words, qa_eval_summary, qa_answerable_summary,
    qa_pr_curve, qa_pr_ap, qa_best_threshold, qa_na_histogram, qa_evaluate, token_offsets,
    context_windows, answer_alignment, eval_features, pad_truncate, span_best_window,
    span_last_window, span_no_answer,
]}

_NORMAL = f"SELECT doc_id, {sql.normalized('text')} AS t FROM documents"

_THRESHOLDED = f"""{sql.SCORES},
final AS (
  SELECT qid, has_ans, na_prob,
         CASE WHEN na_prob > 1.0 THEN CAST(NOT has_ans AS DOUBLE)
              ELSE CAST(exact AS DOUBLE) END AS exact,
         CASE WHEN na_prob > 1.0 THEN CAST(NOT has_ans AS DOUBLE)
              ELSE CAST(f1 AS DOUBLE) END AS f1
  FROM scores)"""


def _summary_sql(source: str, slices: dict[str, str]) -> str:
    parts = []
    for prefix, member in slices.items():
        rows = f"FROM {source} WHERE {member} HAVING count(*) > 0"
        for name in ("exact", "f1"):
            parts.append(f"SELECT '{prefix}{name}' AS metric, 100 * avg({name}) AS value {rows}")
        parts.append(f"SELECT '{prefix}total', CAST(count(*) AS DOUBLE) {rows}")
    return "\nUNION ALL ".join(parts)


_SLICES = {"": "true", "HasAns_": "has_ans", "NoAns_": "NOT has_ans"}
_SUMMARY = _summary_sql("final", _SLICES)

_CURVE = """
ties AS (
  SELECT na_prob, count(*) AS n,
         CAST(coalesce(sum(exact) FILTER (WHERE has_ans), 0) AS DOUBLE) AS tp_exact,
         coalesce(sum(f1) FILTER (WHERE has_ans), 0) AS tp_f1,
         CAST(count(*) FILTER (WHERE has_ans) AS DOUBLE) AS tp_oracle
  FROM scores GROUP BY na_prob),
summed AS (
  SELECT na_prob, sum(n) OVER w AS asked, sum(tp_exact) OVER w AS exact,
         sum(tp_f1) OVER w AS f1, sum(tp_oracle) OVER w AS oracle
  FROM ties WINDOW w AS (ORDER BY na_prob)),
answerable AS (SELECT count(*) AS k FROM gold WHERE has_ans),
points AS (
  SELECT -1.0 AS na_prob, 1.0 AS precision_exact, 0.0 AS recall_exact, 1.0 AS precision_f1,
         0.0 AS recall_f1, 1.0 AS precision_oracle, 0.0 AS recall_oracle
  UNION ALL
  SELECT na_prob, exact / asked, exact / k, f1 / asked, f1 / k, oracle / asked, oracle / k
  FROM summed, answerable),
stepped AS (
  SELECT *, lag(recall_exact) OVER w AS last_exact, lag(recall_f1) OVER w AS last_f1,
         lag(recall_oracle) OVER w AS last_oracle
  FROM points WINDOW w AS (ORDER BY na_prob))"""

_AP = "\nUNION ALL ".join(
    f"SELECT 'pr_{n}_ap' AS metric, "
    f"100 * sum(precision_{n} * (recall_{n} - last_{n})) AS value FROM stepped"
    for n in ("exact", "f1", "oracle")
)


def _gains(name: str) -> str:
    return f"""
gain_{name} AS (
  SELECT qid, na_prob, sum(CAST(CASE WHEN has_ans THEN {name}
                                     WHEN pred <> '' THEN -1 ELSE 0 END AS DECIMAL(28, 12)))
           OVER (ORDER BY na_prob, qid ROWS UNBOUNDED PRECEDING) AS gain
  FROM scores),
top_{name} AS (
  SELECT gain, na_prob FROM gain_{name} WHERE gain > 0
  ORDER BY gain DESC, na_prob, qid LIMIT 1)"""


def _best(name: str) -> str:
    return f"""
SELECT 'best_{name}' AS metric,
       100 * ((SELECT count(*) FROM gold WHERE NOT has_ans)
              + coalesce((SELECT CAST(gain AS DOUBLE) FROM top_{name}), 0))
           / (SELECT count(*) FROM scores) AS value
UNION ALL
SELECT 'best_{name}_thresh', coalesce((SELECT na_prob FROM top_{name}), 0.0)"""


_BEST_TABLES = f"{_gains('exact')}, {_gains('f1')}"
_BEST = f"{_best('exact')} UNION ALL {_best('f1')}"


def _rounded_metrics(tables: str, select: str) -> str:
    return f"""WITH {tables}
SELECT metric, round(CAST(value AS DOUBLE), 6) AS value FROM ({select})"""


_SPAN_ANSWER = "CASE WHEN na_score > score - 18.0 THEN '' ELSE text END"

ORACLES = {
    "normalize_answer": f"SELECT doc_id, t AS normalized FROM ({_NORMAL})",
    "answer_tokens": f"""
SELECT doc_id, CAST(CASE WHEN t = '' THEN 0 ELSE len(string_split(t, ' ')) END AS INTEGER)
         AS n_tokens, replace(t, ' ', '|') AS tokens
FROM ({_NORMAL})""",
    "qa_flatten": f"""WITH {sql.QA_EXAMPLES}
SELECT CAST(doc_id AS VARCHAR) AS id, coalesce(title, 'default') AS title, question,
       text AS context, has_answer AS has_ans,
       CASE WHEN has_answer THEN answer ELSE '' END AS answer,
       CASE WHEN has_answer THEN answer_start ELSE -1 END AS answer_start
FROM examples""",
    "qa_nest": f"""WITH {sql.QA_EXAMPLES}
SELECT title, CAST(count(*) AS INTEGER) AS n_paragraphs,
       CAST(count(*) FILTER (WHERE NOT has_answer) AS INTEGER) AS n_impossible,
       string_agg(id, ' ' ORDER BY id) AS ids
FROM (SELECT CAST(doc_id AS VARCHAR) AS id, coalesce(title, 'default') AS title, has_answer
      FROM examples)
GROUP BY title""",
    "qa_answerable": f"""WITH {sql.QA_EXAMPLES}
SELECT CAST(doc_id AS VARCHAR) AS id, answer FROM examples WHERE has_answer""",
    "qa_raw_scores": f"""WITH {sql.SCORES}
SELECT qid, has_ans, exact, round(CAST(f1 AS DOUBLE), 6) AS f1 FROM scores""",
    "qa_missing_predictions": f"""WITH {sql.QA}
SELECT qid FROM gold WHERE qid NOT IN (SELECT qid FROM preds)""",
    "qa_threshold_scores": f"""WITH {_THRESHOLDED}
SELECT qid, has_ans, round(na_prob, 6) AS na_prob, round(exact, 6) AS exact, round(f1, 6) AS f1
FROM final""",
    "qa_bucketed_scores": f"""WITH {_THRESHOLDED}
SELECT qid, has_ans, round(na_prob, 6) AS na_prob, round(exact, 6) AS exact, round(f1, 6) AS f1
FROM final""",
    "qa_eval_summary": _rounded_metrics(_THRESHOLDED, _SUMMARY),
    "qa_eval_slices": f"""WITH {_THRESHOLDED},
titled AS (
  SELECT f.*, coalesce(CASE WHEN qid % 7 <> 0 THEN source END, 'default') AS title
  FROM final f JOIN documents d ON f.qid = d.doc_id)
SELECT concat_ws('+', CASE WHEN grouping(has_ans) = 0 THEN 'has_ans' END,
                 CASE WHEN grouping(title) = 0 THEN 'title' END) AS slice,
       has_ans, title, count(*) AS total, round(100 * avg(exact), 6) AS exact, round(100 * avg(f1), 6) AS f1
FROM titled GROUP BY GROUPING SETS ((), (has_ans), (title), (has_ans, title))""",
    "packed_words": """WITH w AS (
  SELECT doc_id, source, doc_id // 1000 AS part, len(string_split(coalesce(text, ''), ' ')) AS n FROM documents),
s AS (SELECT *, CAST(sum(n) OVER (PARTITION BY source, part ORDER BY doc_id) AS BIGINT) AS stop FROM w),
u AS (
  SELECT source, part, doc_id, unnest(range((stop - n) // 512, (stop - 1) // 512 + 1)) AS number, stop - n AS start, stop FROM s)
SELECT source, part, CAST(number AS BIGINT) AS number, min(doc_id) AS first_row, max(doc_id) AS last_row,
       CAST(sum(least(stop, 512 * (number + 1)) - greatest(start, 512 * number)) AS BIGINT) AS filled
FROM u GROUP BY source, part, number""",
    "qa_answerable_summary": _rounded_metrics(
        sql.SCORES,
        _summary_sql("(SELECT * FROM scores WHERE has_ans) s",
                     {"": "true", "HasAns_": "has_ans"}),
    ),
    "qa_pr_curve": f"""WITH {sql.SCORES}, {_CURVE}
SELECT na_prob, {', '.join(f'round({k}_{n}, 6) AS {k}_{n}'
                          for n in ('exact', 'f1', 'oracle') for k in ('precision', 'recall'))}
FROM points""",
    "qa_pr_ap": _rounded_metrics(f"{sql.SCORES}, {_CURVE}", _AP),
    "qa_best_threshold": _rounded_metrics(f"{sql.SCORES}, {_BEST_TABLES}", _BEST),
    "qa_na_histogram": f"""WITH {sql.SCORES},
binned AS (
  SELECT has_ans, CASE WHEN na_prob >= 0 AND na_prob <= 1
                       THEN least(CAST(floor(na_prob * 20) AS INTEGER) + 1, 20) END AS bin,
         count(*) OVER (PARTITION BY has_ans) AS total
  FROM scores)
SELECT has_ans, bin, round(count(*) / any_value(total), 6) AS share
FROM binned WHERE bin IS NOT NULL GROUP BY has_ans, bin""",
    "qa_evaluate": _rounded_metrics(
        f"{_THRESHOLDED}, {_CURVE}, {_BEST_TABLES}",
        f"{_SUMMARY} UNION ALL {_BEST} UNION ALL {_AP}",
    ),
    "token_offsets": f"""WITH {sql.DOC_EXAMPLES}, {sql.WINDOWS}
SELECT doc_id, i, s, e FROM tokens""",
    "context_windows": f"""WITH {sql.DOC_EXAMPLES}, {sql.WINDOWS}
SELECT w.doc_id, window_idx, first_token, shift,
       CAST(end_token - first_token AS INTEGER) AS n_tokens,
       coalesce(a.s, -1) AS first_char, coalesce(b.e, -1) AS end_char
FROM windows w
LEFT JOIN tokens a ON a.doc_id = w.doc_id AND a.i = w.first_token
LEFT JOIN tokens b ON b.doc_id = w.doc_id AND b.i = w.end_token - 1""",
    "answer_alignment": f"""WITH {sql.QA_EXAMPLES}, {sql.WINDOWS},
held AS (
  SELECT w.doc_id, w.window_idx, w.shift, w.first_token, x.answer_start AS a,
         x.answer_start + length(x.answer) AS b, x.has_answer,
         min(t.s) AS lo, max(t.e) AS hi,
         max(t.i) FILTER (WHERE t.s <= x.answer_start) AS ts,
         min(t.i) FILTER (WHERE t.e >= x.answer_start + length(x.answer)) AS te
  FROM windows w JOIN examples x ON w.doc_id = x.doc_id
  LEFT JOIN tokens t ON t.doc_id = w.doc_id AND t.i >= w.first_token AND t.i < w.end_token
  GROUP BY ALL)
SELECT CAST(doc_id AS VARCHAR) AS id, window_idx,
       CAST(CASE WHEN has_answer AND lo <= a AND b <= hi THEN shift + ts - first_token
                 ELSE 0 END AS INTEGER) AS start_position,
       CAST(CASE WHEN has_answer AND lo <= a AND b <= hi THEN shift + te - first_token
                 ELSE 0 END AS INTEGER) AS end_position
FROM held""",
    "eval_features": f"""WITH {sql.DOC_EXAMPLES}, {sql.WINDOWS},
listed AS (
  SELECT w.doc_id, w.window_idx, w.shift,
         coalesce(list(t.s || ':' || t.e ORDER BY t.i) FILTER (WHERE t.i IS NOT NULL), []) AS o
  FROM windows w LEFT JOIN tokens t
    ON t.doc_id = w.doc_id AND t.i >= w.first_token AND t.i < w.end_token
  GROUP BY w.doc_id, w.window_idx, w.shift)
SELECT l.doc_id, l.window_idx, x.text AS context,
       array_to_string(list_concat(list_transform(range(shift), lambda i: '0:0'), o,
         list_transform(range(384 - shift - len(o)), lambda i: '0:0')), ' ') AS offsets
FROM listed l JOIN examples x ON l.doc_id = x.doc_id""",
    "pad_truncate": """
SELECT doc_id,
       array_to_string(list_concat(t, list_transform(range(512), lambda i: '[PAD]'))[1:512], ' ')
         AS padded,
       rpad(repeat('1', least(len(t), 512)), 512, '0') AS mask
FROM (SELECT doc_id, list_filter(string_split_regex(text, '[ \\n\\t]'), lambda x: x <> '') AS t
      FROM documents)""",
    "span_best_window": f"""WITH {sql.SPANS}
SELECT doc_id AS example_id, text, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, window_idx) AS r
  FROM spans) WHERE r = 1""",
    "span_last_window": f"""WITH {sql.SPANS}
SELECT doc_id AS example_id, {_SPAN_ANSWER} AS text, round(na_score, 6) AS na_prob FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY window_idx DESC) AS r
  FROM spans) WHERE r = 1""",
    "span_no_answer": f"""WITH {sql.SPANS}
SELECT doc_id AS example_id, window_idx, text, round(score, 6) AS score,
       round(na_score, 6) AS na_score, {_SPAN_ANSWER} AS answer
FROM spans""",
}

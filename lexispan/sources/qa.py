"""QA data sets, predictions and metrics in their JSON forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispan.sources.ranges import JsonRecords, records
from lexispan.sources.scratch import located

ANSWERS = "struct<text:array<string>,answer_start:array<int>>"
EXAMPLE_SCHEMA = (
    f"id string, title string, question string, context string, answers {ANSWERS}"
)
PARAGRAPHS = (
    "array<struct<context:string,qas:array<struct<id:string,question:string,"
    "is_impossible:boolean,answers:array<struct<text:string,answer_start:int>>>>>>"
)
ARTICLE_SCHEMA = f"title string, paragraphs {PARAGRAPHS}"
NESTED_SCHEMA = f"version string, data array<struct<title:string,paragraphs:{PARAGRAPHS}>>"

MAX_RECORD_BYTES = 256 * 1024 * 1024


def read_examples(spark: SparkSession, path: str, format: str = "json") -> DataFrame:
    """Flat examples, one JSON object per line or a Parquet table."""
    return spark.read.format(format).schema(EXAMPLE_SCHEMA).load(path)


def answerable(examples: DataFrame) -> DataFrame:
    """Examples with at least one answer."""
    return examples.filter(F.size("answers.text") > 0)


def read_nested(spark: SparkSession, path: str) -> DataFrame:
    """Articles of nested QA documents ``{version, data: [..]}``, one row each.

    Each file is one JSON value and is read by one task; many files are read in
    parallel.  ``read_document`` reads large ones.
    """
    whole = spark.read.schema(NESTED_SCHEMA).option("multiLine", True).json(path)
    return whole.select(F.inline("data"))


def read_document(spark: SparkSession, *paths: str, one_document: bool = False) -> DataFrame:
    """The rows of ``read_nested``, with every file read by as many tasks as it has byte ranges.

    The document's ``data`` is cut into articles where they begin, and each article is
    parsed by itself; other members of the document are passed over.  An article that
    doesn't fit the schema has nulls.  Files must be whole JSON documents in UTF-8, or
    with ``one_document`` the parts of one that ``write_document`` has left in a folder.
    """
    article = F.from_json("record", ARTICLE_SCHEMA)
    entries = records(spark, paths, JsonRecords(2), one_document).filter(F.col("section") == "data")
    return entries.select(article.alias("article")).select("article.*")


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """Articles stored one per line, as ``write_nested`` does."""
    return spark.read.schema(ARTICLE_SCHEMA).json(path)


def flatten_articles(articles: DataFrame) -> DataFrame:
    """``(id, title, question, context, answers, has_ans)``, one row per question."""
    paragraphs = articles.select("title", F.inline("paragraphs"))
    questions = paragraphs.select("title", "context", F.explode("qas").alias("qa"))
    answers = F.struct(
        F.col("qa.answers.text").alias("text"),
        F.col("qa.answers.answer_start").alias("answer_start"),
    )
    return questions.select(
        "qa.id", "title", "qa.question", "context", answers.alias("answers"),
        (F.size("qa.answers") > 0).alias("has_ans"),
    )


def nest_examples(examples: DataFrame, max_bytes: int = MAX_RECORD_BYTES) -> DataFrame:
    """``(title, part, paragraphs)``: examples grouped by title, in id order.

    One paragraph per example; a missing title becomes ``default``.  A title is one
    record, ``part`` 0, unless its contexts and questions have more than ``max_bytes``
    bytes; then it is cut into parts of about that size, all with its title, so that
    no row grows without bound.  ``title`` and ``part`` together name a record.
    """
    titled = examples.withColumn("title", F.coalesce("title", F.lit("default")))
    size = F.sum(F.coalesce(F.octet_length("context"), F.lit(0))
                 + F.coalesce(F.octet_length("question"), F.lit(0)))
    parts = F.greatest(F.ceil(size / max_bytes), F.lit(1)).alias("_parts")
    crowded = titled.groupBy("title").agg(parts).filter("_parts > 1")
    answers = F.transform(
        F.arrays_zip("answers.text", "answers.answer_start"),
        lambda a: F.struct(
            a["text"].alias("text"), a["answer_start"].alias("answer_start")
        ),
    )
    qa = F.struct(
        "id", "question",
        (F.size("answers.text") == 0).alias("is_impossible"),
        answers.alias("answers"),
    )
    paragraph = F.struct("id", F.struct("context", F.array(qa).alias("qas")).alias("p"))
    placed = titled.select("title", F.col("id"), paragraph.alias("_entry")).join(
        crowded, "title", "left"
    )
    part = F.pmod(F.xxhash64("id"), F.coalesce("_parts", F.lit(1)))
    grouped = placed.groupBy("title", part.alias("part")).agg(
        F.sort_array(F.collect_list("_entry")).alias("_entries")
    )
    return grouped.select(
        "title", "part", F.transform("_entries", lambda e: e["p"]).alias("paragraphs")
    )


def write_nested(examples: DataFrame, path: str, max_bytes: int = MAX_RECORD_BYTES) -> None:
    """Write examples as articles, one JSON object ``{title, paragraphs}`` per line."""
    nest_examples(examples, max_bytes).drop("part").write.mode("overwrite").json(path)


def read_json_map(
    spark: SparkSession, path: str, key: str, value: str, type: str, one_document: bool = False,
) -> DataFrame:
    """``(key, value)`` rows from files that each hold one JSON object.

    A file is read by as many tasks as it has byte ranges and cut into its members, which
    are parsed one by one.  A member that stands twice gives two rows; a value that is
    not of ``type`` is null.  ``one_document``: the files are parts of one object, in the
    order of their names.
    """
    member = F.from_json(F.concat(F.lit("{"), "record", F.lit("}")), f"map<string,{type}>")
    return records(spark, [path], JsonRecords(1), one_document).select(F.explode(member).alias(key, value))


def read_prediction_map(spark: SparkSession, path: str, one_document: bool = False) -> DataFrame:
    return read_json_map(spark, path, "qid", "text", "string", one_document)


def read_na_prob_map(spark: SparkSession, path: str, one_document: bool = False) -> DataFrame:
    return read_json_map(spark, path, "qid", "na_prob", "double", one_document)


def _write_document(
    entries: DataFrame, path: str, opening: str, closing: str, order: str, text: str, single_file: bool,
) -> None:
    """Write the JSON texts ``text`` as one document, entries in the order of the unique ``order``.

    The folder's files, one after the other by name, are the document.  With
    ``single_file`` they become one file ``path``: by ``concat`` where the file system
    has it, else by a stream that holds a few kilobytes.
    """
    spark = entries.sparkSession
    first, last = entries.agg(F.min(order), F.max(order)).first()
    if first is None:
        lines = spark.range(1).select(F.lit(opening + closing))
    else:
        lines = entries.repartitionByRange(order).sortWithinPartitions(order).select(F.concat(
            F.when(F.col(order) == first, opening).otherwise(","), F.col(text),
            F.when(F.col(order) == last, closing).otherwise("")))
    folder = f"{path}.parts" if single_file else path
    lines.write.mode("overwrite").text(folder)
    if single_file:
        _join_files(spark, folder, path)


def _join_files(spark: SparkSession, folder: str, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    source, system = located(spark, folder)
    target, _ = located(spark, path)
    parts = sorted((f.getPath().toString(), f.getPath()) for f in system.listStatus(source)
                   if f.getPath().getName().startswith("part-") and f.getLen() > 0)
    system.delete(target, True)
    files = spark.sparkContext._gateway.new_array(hadoop.fs.Path, len(parts) - 1)
    for i, (_, file) in enumerate(parts[1:]):
        files[i] = file
    try:
        if len(parts) > 1:
            system.concat(parts[0][1], files)
        system.rename(parts[0][1], target)
    except Exception as error:
        if "UnsupportedOperationException" not in str(error):
            raise
        with_stream = system.create(target)
        try:
            for _, file in parts:
                stream = system.open(file)
                hadoop.io.IOUtils.copyBytes(stream, with_stream, 4096, False)
                stream.close()
        finally:
            with_stream.close()
    system.delete(source, True)


def _member(key: Column, value: Column) -> Column:
    """``"key":value`` as it stands in a JSON object; a null value is ``null``."""
    whole = F.to_json(F.create_map(key, value), {"ignoreNullFields": "false"})
    return F.substr(whole, F.lit(2), F.char_length(whole) - 2)


def write_prediction_map(
    predictions: DataFrame, path: str, key: str = "qid", value: str = "text", single_file: bool = True,
) -> None:
    """Write ``(key, value)`` as one JSON object ``{key: value, ..}`` in UTF-8, as the evaluator reads it.

    Of rows that share a key the one with the largest value stays, as an object has each
    member once; rows without a key are left out.  No rows give ``{}``.
    """
    name = F.col(key).cast("string").alias("_key")
    entries = predictions.filter(F.col(key).isNotNull()).groupBy(name).agg(F.max(value).alias("_value")).select(
        "_key", _member(F.col("_key"), F.col("_value")).alias("_text"))
    _write_document(entries, path, "{", "}", "_key", "_text", single_file)


def write_document(
    examples: DataFrame, path: str, version: str = "v2.0", max_bytes: int = MAX_RECORD_BYTES,
    single_file: bool = True,
) -> None:
    """Write examples as one nested document ``{version, data: [..]}``, articles by title.

    Titles, paragraphs and answers are those of ``nest_examples``.  No examples give an
    empty ``data``.
    """
    nested = nest_examples(examples, max_bytes)
    # Titles and parts are unique together, and so is their text: the separator ends it.
    order = F.concat(F.col("title"), F.lit("\u0000"), F.lpad(F.col("part").cast("string"), 20, "0"))
    entries = nested.select(order.alias("_order"), F.to_json(F.struct("title", "paragraphs")).alias("_text"))
    opening = F.to_json(F.struct(F.lit(version).alias("version")))
    head = examples.sparkSession.range(1).select(opening).first()[0][:-1] + ',"data":['
    _write_document(entries, path, head, "]}", "_order", "_text", single_file)


def write_predictions(predictions: DataFrame, path: str) -> None:
    """One ``{"qid", "text"}`` (or ``na_prob``) object per line, UTF-8."""
    predictions.write.mode("overwrite").json(path)


def read_predictions(spark: SparkSession, path: str, schema: str = "qid string, text string") -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """One ``{"metric", "value"}`` object per line."""
    metrics.write.mode("overwrite").json(path)

"""Table functions for SQL: a table and further arguments in, another number of rows out."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf


def _pack_words():
    # Made in a function, so that it goes to the workers by value and needs no package there.
    from pyspark.sql.types import LongType, StructField, StructType
    from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

    class PackWords:
        """Rows of a partition put end to end and cut into windows of ``size`` words.

        ``pack_words(TABLE(t) PARTITION BY (..) ORDER BY (..), keys, id, words, size)``:
        ``keys`` lists the columns that tell partitions apart, by commas, ``id`` and ``words``
        name an identifier and a number of words; null is no words.  Per window: the keys,
        its number from 0, the first and last row, and how many words of it are filled,
        which is less than ``size`` in the last one of a partition alone.
        """

        @staticmethod
        def analyze(table: AnalyzeArgument, keys: AnalyzeArgument, id: AnalyzeArgument, words: AnalyzeArgument,
                    size: AnalyzeArgument):
            if not table.isTable:
                raise ValueError("the first argument must be a table")
            if size.value is None or int(size.value) < 1:
                raise ValueError("a window needs at least one word")
            known = {field.name: field.dataType for field in table.dataType.fields}
            names = [name.strip() for name in str(keys.value or "").split(",") if name.strip()]
            missing = [name for name in (*names, id.value, words.value) if name not in known]
            if missing:
                raise ValueError(f"the table has no columns {missing}")
            return AnalyzeResult(StructType([
                *[StructField(name, known[name]) for name in names], StructField("number", LongType()),
                StructField("first_row", known[id.value]), StructField("last_row", known[id.value]),
                StructField("filled", LongType())]))

        def __init__(self) -> None:
            self.window, self.filled, self.first, self.last, self.keys = 0, 0, None, None, ()

        def eval(self, row, keys, id, words, size):
            self.keys = tuple(row[name.strip()] for name in (keys or "").split(",") if name.strip())
            left = row[words] or 0
            while left > 0:
                if self.filled == 0:
                    self.first = row[id]
                taken = min(left, size - self.filled)
                left, self.filled, self.last = left - taken, self.filled + taken, row[id]
                if self.filled == size:
                    yield (*self.keys, self.window, self.first, self.last, self.filled)
                    self.window, self.filled = self.window + 1, 0

        def terminate(self):
            if self.filled:
                yield (*self.keys, self.window, self.first, self.last, self.filled)

    return PackWords


def register(spark: SparkSession) -> None:
    """Make the table functions known to the session's SQL."""
    spark.udtf.register("pack_words", udtf(_pack_words()))

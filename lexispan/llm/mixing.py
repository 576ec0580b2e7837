"""Mixing sources to target weights by temperature.

The token shares of the sources are raised to an exponent and normalised; the exponent
is bisected until the mixture meets a target entropy or no source is repeated more
often than allowed.  The weights are then realised as budgeted block permutations:
every source is walked in a seeded permutation, anew in each epoch, until its part of
the token budget is used, and the walk is cut into blocks of equal parts, so that each
block holds every source at its weight.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexispan.llm.columns import word_count
from lexispan.llm.shared import stored

STEPS = 1 << 20
ROWS_PER_BUCKET = 4096


def _mixtures(shares: DataFrame, exponents: list[float], budget_share: float | None) -> list:
    """Entropy and largest number of repeats of each exponent, in the order of ``exponents``."""
    points = F.explode(F.array(*[F.lit(x) for x in exponents])).alias("x")
    p, x = F.col("share"), F.col("x")
    rows = shares.select("share", points).groupBy("x").agg(
        F.sum(F.pow(p, x)).alias("z"), F.sum(F.pow(p, x) * F.log(p)).alias("s"),
        F.max(F.pow(p, x - 1)).alias("most"), F.min(F.pow(p, x - 1)).alias("least"),
    ).orderBy("x").collect()
    return [
        (math.log(r.z) - r.x * r.s / r.z,
         r.most / r.least if budget_share is None else budget_share * r.most / r.z)
        for r in rows
    ]


def bisect_exponent(
    shares: DataFrame, *, max_repeats: float | None = None, target_entropy: float | None = None,
    budget_share: float | None = None, ways: int = 16,
) -> float:
    """The exponent in [0, 1], as a multiple of 2**-20, that meets the wanted limit.

    ``target_entropy`` (nats): the largest exponent whose mixture is at least that
    diverse.  ``max_repeats``: the smallest exponent, the most even mixture, that walks
    no source more often than that; 1 if none does.  ``shares`` has one row per source.
    Each round tests ``ways - 1`` points in one aggregate; its few rows come to the driver.
    """
    if (max_repeats is None) == (target_entropy is None):
        raise ValueError("give either max_repeats or target_entropy")
    low, high = -1, STEPS + 1  # below high all points fail or hold, and beyond low likewise
    while high - low > 1:
        step = max(1, (high - low) // ways)
        points = [k for k in range(low + step, high, step)]
        found = _mixtures(shares, [k / STEPS for k in points], budget_share)
        for k, (entropy, repeats) in zip(points, found, strict=True):
            beyond = entropy < target_entropy if max_repeats is None else repeats <= max_repeats
            if beyond:
                high = min(high, k)
            else:
                low = max(low, k)
    if max_repeats is None:
        return max(low, 0) / STEPS
    return min(high, STEPS) / STEPS


def source_weights(
    docs: DataFrame, source: str, tokens: str, *, max_repeats: float | None = 2.0,
    target_entropy: float | None = None, budget: float | None = None,
) -> tuple[DataFrame, float]:
    """``(source, source_tokens, weight, target)`` and the exponent.

    ``target`` is the part of the token budget.  Without a budget it is the least one
    that takes every document at least once.  A source without tokens has weight 0.
    """
    sizes = stored(
        docs.groupBy(source).agg(F.sum(tokens).cast("double").alias("source_tokens"),
                                 F.count(F.lit(1)).alias("source_rows")),
        "mix-sources",
    )
    total = sizes.agg(F.sum("source_tokens")).first()[0] or 0.0
    if not total:
        return sizes.withColumns({"weight": F.lit(0.0), "target": F.lit(0.0)}), 1.0
    shares = sizes.filter("source_tokens > 0").select((F.col("source_tokens") / total).alias("share"))
    exponent = bisect_exponent(
        shares, max_repeats=max_repeats if target_entropy is None else None,
        target_entropy=target_entropy, budget_share=None if budget is None else budget / total,
    )
    raised = F.when(F.col("source_tokens") > 0, F.pow(F.col("source_tokens") / total, F.lit(exponent)))
    z, least = sizes.agg(F.sum(raised), F.max(F.col("source_tokens") / raised)).first()
    whole = least * z if budget is None else budget
    weight = F.coalesce(raised / z, F.lit(0.0))
    return sizes.withColumns({"weight": weight, "target": weight * whole}), exponent


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text", *,
    max_repeats: float | None = 2.0, target_entropy: float | None = None,
    budget: float | None = None, block_tokens: int = 1 << 20, seed: int = 7,
) -> DataFrame:
    """``(id, source, n_tokens, epoch, block, weight, exponent)``: one row per use of a document.

    Tokens are words.  In an epoch a source is walked once, in the order of
    ``md5(seed:epoch:id)``; the last epoch stops at the first document that starts at
    or beyond the source's target, so a target is missed by less than one document.
    Without ``budget`` no document is left out.  Null source counts as the source ''.
    Texts without words cost nothing and are used in every epoch walked to their
    place; a source with no words at all is walked once.  Rows of one id are walked
    one after the other.  No rows give no rows.
    """
    rows = stored(
        docs.select(
            F.col(id_col).alias("_id"), F.coalesce(F.col(source), F.lit("")).alias("_source"),
            word_count(F.col(text)).alias("_tokens"),
        ),
        "mix-rows",
    )
    weights, exponent = source_weights(
        rows, "_source", "_tokens", max_repeats=max_repeats, target_entropy=target_entropy,
        budget=budget,
    )
    totals = weights.agg(F.sum("target"), F.max("source_rows")).first()
    blocks = max(1, math.ceil((totals[0] or 0) / block_tokens))
    digits = max(0, math.ceil(math.log((totals[1] or 1) / ROWS_PER_BUCKET, 16)))
    return _walk(rows, weights, blocks, digits, seed).select(
        F.col("_id").alias(id_col), F.col("_source").alias(source), F.col("_tokens").alias("n_tokens"),
        "epoch", "block", "weight", F.lit(exponent).alias("exponent"),
    )


def _walk(rows: DataFrame, weights: DataFrame, blocks: int, digits: int, seed: int) -> DataFrame:
    """Running tokens of each source and epoch, cut into buckets by the order's first digits."""
    size, target = F.col("source_tokens"), F.col("target")
    # A target that is a whole number of epochs but for rounding is that number.
    epochs = F.when(size > 0, F.greatest(F.lit(1.0), F.ceil(target / size - 1e-9))).otherwise(F.lit(1.0))
    last = F.coalesce(target / F.nullif(size, F.lit(0.0)), F.lit(1.0))
    uses = rows.join(weights, "_source").select(
        "_id", "_source", "_tokens", "weight", "source_tokens", "target",
        F.explode(F.sequence(F.lit(1), epochs.cast("int"))).alias("epoch"), last.alias("_last"),
    )
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"), F.col("_id").cast("string")))
    uses = uses.withColumn("_key", key).withColumn("_bucket", F.substring("_key", 1, digits))
    group = ["_source", "epoch", "_bucket"]
    before = Window.partitionBy("_source", "epoch").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = uses.groupBy(*group).agg(F.sum("_tokens").alias("_sum")).select(
        *group, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*group).orderBy("_key", "_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = uses.withColumn("_inside", F.coalesce(F.sum("_tokens").over(inside), F.lit(0)))
    placed = placed.join(offsets, group).withColumn("_start", F.col("_offset") + F.col("_inside"))
    whole = (F.col("epoch") <= F.col("_last") + 1e-9) | (F.col("source_tokens") == 0)
    begins = (F.col("epoch") - 1) * F.col("source_tokens") + F.col("_start")
    part: Column = F.coalesce(begins / F.nullif(F.col("target"), F.lit(0.0)), F.lit(0.0))
    return placed.filter(whole | (begins < F.col("target"))).withColumn(
        "block", F.least(F.floor(part * blocks), F.lit(blocks - 1)).cast("long"))

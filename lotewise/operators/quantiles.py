"""Exact quantiles per group without holding a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lotewise.operators.joins import many_to_one
from lotewise.session import keep

# Each quantile is looked for between two sketched bounds this far (in rank share)
# from it; the span is cut in SLICES equal widths.
MARGIN = 0.002
SLICES = 512


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: dict[str, float]
) -> DataFrame:
    """One row per group with a double column per entry of `probs`, plus `n`.

    Linear interpolation between the two nearest ranks; NULL values are left out.
    Three passes over `df`, none of which orders a whole group: a sketch brackets
    each quantile; the rows are counted per cell between the brackets (map-side
    combine), which tells exactly in which cell each wanted rank lies; the distinct
    values of those few cells alone are put in order. A poor sketch makes a cell
    larger, never the answer wrong. The sketch and the list of wanted cells (a few
    rows per group) are kept in the shared folder between the passes.
    """
    by = list(by)
    if not by:
        raise ValueError("group by at least one column; add an 'all' row for a total")
    src = df.select(*by, F.col(value).cast("double").alias("__v")).filter("__v IS NOT NULL")
    bounds = sorted({b for p in probs.values() for b in (max(p - MARGIN, 0.0), min(p + MARGIN, 1.0))})
    sketch = keep(
        src.groupBy(*by).agg(
            F.array_distinct(F.percentile_approx("__v", bounds, 10000)).alias("__b"),
            F.count(F.lit(1)).alias("n"),
        ),
        "sketch",
    )
    cells = _celled(src, sketch, by, len(bounds))
    cell = [*by, "__span", "__slice"]
    wanted = keep(_wanted_cells(cells, sketch, by, probs), "cells")

    inside = many_to_one(cells, wanted.select(*cell).distinct(), cell)
    values = inside.groupBy(*cell, "__v").agg(F.count(F.lit(1)).alias("__m"))
    upto = W.partitionBy(*cell).orderBy("__v").rowsBetween(W.unboundedPreceding, W.currentRow)
    values = values.withColumn("__upto", F.sum("__m").over(upto))
    picked = many_to_one(wanted, values, cell).filter(
        "__in_cell < __upto AND __in_cell >= __upto - __m"
    )
    # the two neighbours of each quantile, by rank
    ends = picked.groupBy(*by, "n").agg(
        *(
            pick(F.when(F.col("__name") == name, F.col("__v"))).alias(f"__{side}_{name}")
            for name in probs
            for side, pick in (("low", F.min), ("high", F.max))
        )
    )

    def between(name: str, p: float) -> Column:
        place = (F.col("n") - 1) * F.lit(float(p))
        low, high = F.col(f"__low_{name}"), F.col(f"__high_{name}")
        return (low + (high - low) * (place - F.floor(place))).alias(name)

    return ends.select(*by, "n", *(between(name, p) for name, p in probs.items()))


def _celled(src: DataFrame, sketch: DataFrame, by: Sequence[str], n_bounds: int) -> DataFrame:
    """The cell of each value: its span between two bounds, then a slice of the span."""
    joined = many_to_one(src, sketch.drop("n"), by)
    span = F.lit(0)
    for i in range(n_bounds):
        span = span + F.when(F.col("__v") > F.get("__b", F.lit(i)), 1).otherwise(0)
    joined = joined.withColumn("__span", span)
    low, high = F.get("__b", F.col("__span") - 1), F.get("__b", F.col("__span"))
    share = F.try_divide(F.col("__v") - low, high - low)
    sliced = F.coalesce(F.ceil(share * SLICES).cast("int"), F.lit(0))
    return joined.withColumn("__slice", sliced).drop("__b")


def _wanted_cells(
    cells: DataFrame, sketch: DataFrame, by: Sequence[str], probs: dict[str, float]
) -> DataFrame:
    """Per quantile and neighbour: the cell its rank lies in, and the rank inside it."""
    counts = cells.groupBy(*by, "__span", "__slice").agg(F.count(F.lit(1)).alias("__c"))
    upto = (
        W.partitionBy(*by)
        .orderBy("__span", "__slice")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    counts = counts.withColumn("__end", F.sum("__c").over(upto))
    last = F.col("n") - 1
    places = F.array(
        *(
            F.struct(F.lit(name).alias("__name"), F.floor(last * F.lit(float(p))).alias("__lo"))
            for name, p in probs.items()
        )
    )
    ranks = (
        sketch.select(*by, "n", F.inline(places))
        .withColumn("__next", F.least(F.col("__lo") + 1, last))
        .withColumn("__rank", F.explode(F.array_distinct(F.array("__lo", "__next"))))
    )
    start = F.col("__end") - F.col("__c")
    return (
        many_to_one(counts, ranks, by)
        .filter((F.col("__rank") >= start) & (F.col("__rank") < F.col("__end")))
        .select(
            *by, "n", "__name", "__span", "__slice", (F.col("__rank") - start).alias("__in_cell")
        )
    )

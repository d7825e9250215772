"""How right the stored values are, against a second reading."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lotewise.functions.text import fold
from lotewise.operators.joins import many_to_one
from lotewise.session import keep

NUMBER = "number"
TEXT = "text"
_COMPARED_AS = "decimal(20,4)"

MATCH = "match"
INCONSISTENT = "inconsistent report"
ERROR = "extraction error"


def _agree(a: Column, b: Column, kind: str, tolerance: float) -> Column:
    """Never NULL: two values agree only when both are there and can be read."""
    if kind == NUMBER:
        gap = F.abs(a.try_cast(_COMPARED_AS) - b.try_cast(_COMPARED_AS))
        same = gap <= F.lit(str(tolerance)).cast(_COMPARED_AS)
    else:
        same = fold(a.cast("string")) == fold(b.cast("string"))
    return F.coalesce(same, F.lit(False))


def reconcile(
    stored: DataFrame,
    printed: DataFrame,
    second: DataFrame,
    key: Sequence[str],
    fields: dict[str, str],
    sources: Sequence[str],
    tolerance: float = 0.01,
) -> DataFrame:
    """One row per key and comparable field, with its outcome.

    `stored` and `printed` have one row per key; `second` has one per key and
    `source`, and the first source of `sources` that carries a field counts. The
    three are joined once per key, still wide; fields become rows after the join,
    so what is shuffled is one row per report and not one per field.
    """
    unknown = set(fields.values()) - {NUMBER, TEXT}
    if unknown:
        raise ValueError(f"unknown kinds: {sorted(unknown)}")
    key = list(key)
    rank = F.array_position(F.array(*(F.lit(s) for s in sources)), F.col("source"))
    rank = F.nullif(rank.cast("int"), F.lit(0))
    best = second.groupBy(*key).agg(
        *(
            F.min(
                F.when(
                    F.col(f).isNotNull() & rank.isNotNull(),
                    F.struct(rank.alias("rank"), F.col(f).alias("value"), F.col("source")),
                )
            ).alias(f"__second_{f}")
            for f in fields
        )
    )
    read = printed.select(*key, *(F.col(f).alias(f"__printed_{f}") for f in fields))
    wide = stored.select(*key, *fields).join(read, key, "left").join(best, key)

    def outcome(f: str, kind: str) -> Column:
        other = F.col(f"__second_{f}.value")
        return (
            F.when(_agree(F.col(f), other, kind, tolerance), MATCH)
            .when(_agree(F.col(f), F.col(f"__printed_{f}"), kind, tolerance), INCONSISTENT)
            .otherwise(ERROR)
        )

    rows = F.array(
        *(
            F.when(
                F.col(f"__second_{f}").isNotNull(),
                F.struct(
                    F.lit(f).alias("field"),
                    F.col(f).cast("string").alias("stored"),
                    F.col(f"__second_{f}.value").cast("string").alias("second"),
                    F.col(f"__second_{f}.source").alias("source"),
                    outcome(f, kind).alias("outcome"),
                ),
            )
            for f, kind in fields.items()
        )
    )
    return wide.select(*key, F.inline(F.array_compact(rows)))


def align_samples(
    stored: DataFrame,
    second: DataFrame,
    parent: str,
    number: str,
    fields: dict[str, str],
    least: int = 3,
) -> DataFrame:
    """E2 for samples: (parent, number, second_number) of the samples of a report that are the same one.

    The second source numbers samples its own way, so they are matched by what they say: first those that
    agree in all `fields`, then, of what is left, in all but one, and so on down to `least` of them. Samples of a report
    that agree in the same fields are matched in the order of their numbers; of several candidates the one
    of the lower number counts, and what it leaves is tried again. An absent value agrees with nothing. Every step is an
    equi-join on report, fields and values, so pairs of samples are never formed.

    `stored` and `second` have (parent, number, *fields), numbers unique within a report. Samples without a partner
    are not in the result.
    """
    left = keep(_fingerprints(stored, parent, number, fields, least), "aligned-stored")
    right = keep(_fingerprints(second, parent, number, fields, least), "aligned-second")
    pairs = None
    for size in range(len(fields), least - 1, -1):
        for _ in range(2):  # a second time for those whose first choice went to another
            a, b = (
                side if pairs is None else many_to_one(side, pairs.select(parent, F.col(used).alias(number)), [parent, number], "left_anti")
                for side, used in ((left, number), (right, "second_number"))
            )
            one, other = _candidates(a, size, parent, number), _candidates(b, size, parent, number)
            on = [parent, "mask", "print", "nth"]
            met = one.join(other.withColumnRenamed(number, "second_number"), on).select(parent, number, "second_number")
            first = met.groupBy(parent, number).agg(F.min("second_number").alias("second_number"))
            new = keep(first.groupBy(parent, "second_number").agg(F.min(number).alias(number)), "aligned")
            new = new.select(parent, number, "second_number")
            pairs = new if pairs is None else pairs.unionByName(new)
    return pairs


def _fingerprints(samples: DataFrame, parent: str, number: str, fields: dict[str, str], least: int) -> DataFrame:
    """(parent, number, prints): for each choice of at least `least` fields (a bit mask) the hash of
    their values, where all are there."""
    values = []
    for f, kind in fields.items():
        same = F.round(F.col(f).try_cast(_COMPARED_AS), 2) if kind == NUMBER else F.nullif(fold(F.col(f).cast("string")), F.lit(""))
        values.append(same.cast("string"))
    masks = [m for m in range(1, 1 << len(fields)) if m.bit_count() >= least]

    def printed(mask: int) -> Column:
        chosen = [v for i, v in enumerate(values) if mask >> i & 1]
        there = F.forall(F.array(*chosen), lambda v: v.isNotNull())
        entry = F.struct(F.lit(mask).alias("mask"), F.md5(F.to_json(F.array(*chosen))).alias("print"))
        return F.when(there, entry)

    return samples.select(parent, number, F.array_compact(F.array(*(printed(m) for m in masks))).alias("prints"))


def _candidates(samples: DataFrame, size: int, parent: str, number: str) -> DataFrame:
    """(parent, number, mask, print, nth) for the choices of `size` fields; nth tells samples apart that say the same."""
    entries = samples.select(parent, number, F.explode("prints").alias("p")).filter(F.bit_count("p.mask") == size)
    alike = W.partitionBy(parent, "p.mask", "p.print").orderBy(number)
    return entries.select(
        parent, number, F.col("p.mask").alias("mask"), F.col("p.print").alias("print"), F.row_number().over(alike).alias("nth")
    )


def reconcile_samples(
    stored: DataFrame,
    printed: DataFrame,
    second: DataFrame,
    parent: str,
    number: str,
    fields: dict[str, str],
    sources: Sequence[str],
    tolerance: float = 0.01,
    least: int = 3,
) -> DataFrame:
    """E2 for samples whose numbers differ between the sources: `reconcile` once `second` has the stored numbers.

    Only reports in `stored` count, so a drawn sample of reports keeps the second source small.
    """
    drawn = stored.select(parent).distinct()
    parts = []
    for source in sources:
        one = many_to_one(second.filter(F.col("source") == source), drawn, [parent], "left_semi")
        pairs = align_samples(stored, one, parent, number, fields, least)
        named = pairs.select(parent, F.col(number).alias("__stored"), F.col("second_number").alias(number))
        parts.append(one.join(named, [parent, number]).withColumn(number, F.col("__stored")).drop("__stored"))
    return reconcile(stored, printed, reduce(DataFrame.unionByName, parts), [parent, number], fields, sources, tolerance)


def accuracy_by_field(reconciled: DataFrame) -> DataFrame:
    """Hit rate per field. An inconsistent report was read right, so it is a hit."""
    counted = reconciled.groupBy("field").agg(
        F.count(F.lit(1)).alias("n_comparable"),
        F.count_if(F.col("outcome") == MATCH).alias("n_match"),
        F.count_if(F.col("outcome") == INCONSISTENT).alias("n_inconsistent"),
        F.count_if(F.col("outcome") == ERROR).alias("n_error"),
    )
    right = F.col("n_match") + F.col("n_inconsistent")
    return counted.withColumn("accuracy", right / F.col("n_comparable"))

"""Suspicious data: empty, incoherent, far-off values, all in one report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lotewise.operators.joins import many_to_one
from lotewise.operators.quantiles import exact_quantiles
from lotewise.session import keep

_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def empty_fields(df: DataFrame) -> DataFrame:
    """Per column, rows without a value and rows with zero; one pass for all."""
    rows = [
        F.struct(
            F.lit(name).alias("field"),
            F.col("n_rows"),
            F.col(f"empty_{i}").alias("n_empty"),
            F.col(f"zero_{i}").alias("n_zero"),
        )
        for i, name in enumerate(df.columns)
    ]
    return df.agg(*_field_counts(df)).select(F.inline(F.array(*rows)))


def _field_counts(df: DataFrame) -> list[Column]:
    """The rows, and for each column how many are empty and how many zero."""
    counts = [F.count(F.lit(1)).alias("n_rows")]
    for i, (name, kind) in enumerate(df.dtypes):
        c = F.col(f"`{name}`")
        if kind == "string":
            empty = c.isNull() | (F.trim(c) == "")
        elif kind.startswith("array"):
            empty = c.isNull() | (F.size(c) == 0)
        else:
            empty = c.isNull()
        number = kind in _NUMERIC or kind.startswith("decimal")
        zero = F.count_if(c == 0) if number else F.lit(0).cast("long")
        counts += [F.count_if(empty).alias(f"empty_{i}"), zero.alias(f"zero_{i}")]
    return counts


def incoherent_values(df: DataFrame, key: Sequence[str], rules: dict[str, Column]) -> DataFrame:
    """E5: (key, rule) for values that contradict each other; NULL is no contradiction."""
    broken = F.array_compact(F.array(*(F.when(bad, F.lit(n)) for n, bad in rules.items())))
    return df.select(*key, F.explode(broken).alias("rule"))


def outliers(df: DataFrame, value: str, by: Sequence[str], fence: float = 1.5) -> DataFrame:
    """Rows outside the quartile fences of their group, with the fences.

    The quartiles are exact. Group and value alone are kept in the shared folder, as they
    are gone over three times; the fences (one row per group) join back to the rows. NULL
    groups are judged together.
    """
    by = list(by)
    narrow = keep(df.select(*by, value), "outliers")
    q = exact_quantiles(narrow, by, value, {"q1": 0.25, "q3": 0.75})
    spread = F.col("q3") - F.col("q1")
    fences = q.select(
        *by,
        (F.col("q1") - F.lit(fence) * spread).alias("low"),
        (F.col("q3") + F.lit(fence) * spread).alias("high"),
    )
    outside = (F.col(value) < F.col("low")) | (F.col(value) > F.col("high"))
    return many_to_one(df, fences, by).filter(outside)


def quality_report(sections: dict[str, DataFrame]) -> DataFrame:
    """The quality queries in one long result (section, check, key, value).

    Each frame brings the columns check, key, value; they are read as text.
    """
    parts = [
        frame.select(
            F.lit(name).alias("section"),
            F.col("check").cast("string").alias("check"),
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
        )
        for name, frame in sections.items()
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def quality_of_table(
    df: DataFrame, key: Sequence[str], rules: dict[str, Column], values: dict[str, Sequence[str]]
) -> DataFrame:
    """E4, E5 and E6 of one table, read once: (section, check, key, value).

    While the table is read, empty and zero values and the rows that break each rule are counted, and what the
    other sections need (key, broken rules, the compared values and their groups) is written narrow into the
    shared folder. Broken rules by row and outliers (`values`: {value: group columns}) come from there. Only the counts,
    a few numbers a column, pass the driver. Keys are joined by `-`.
    """
    watch = Observation("quality")
    broken = F.array_compact(F.array(*(F.when(bad, F.lit(n)) for n, bad in rules.items())))
    by = list(dict.fromkeys(c for group in values.values() for c in group))
    hits = [F.count_if(bad).alias(f"rule_{i}") for i, bad in enumerate(rules.values())]
    wanted = [F.concat_ws("-", *key).alias("key"), broken.alias("__broken")]
    plain = [c for c in dict.fromkeys([*by, *values])]
    narrow = keep(df.observe(watch, *_field_counts(df), *hits).select(*wanted, *plain), "quality")
    seen = watch.get
    counted = [("empty", name, kind, str(seen[f"{kind}_{i}"])) for i, name in enumerate(df.columns) for kind in ("empty", "zero")]
    counted += [("rule", name, "rows", str(seen[f"rule_{i}"])) for i, name in enumerate(rules)]
    counts = df.sparkSession.createDataFrame(counted, "section string, check string, key string, value string")
    none = F.lit(None).cast("string").alias("value")
    rows = narrow.select(F.lit("incoherent").alias("section"), F.explode("__broken").alias("check"), "key", none)
    out = counts.unionByName(rows.select("section", "check", "key", "value"))
    for value, group in values.items():
        far = outliers(narrow.select("key", value, *group), value, group)
        named = F.concat_ws(" ", F.lit(value), *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in group))
        out = out.unionByName(
            far.select(F.lit("outlier").alias("section"), named.alias("check"), "key", F.col(value).cast("string").alias("value"))
        )
    return out

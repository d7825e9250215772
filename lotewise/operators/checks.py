"""Known problems per report, contaminated text, samples, verdict."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotewise.functions.text import fold
from lotewise.session import keep


def field_checks(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """D3: (key, check) for every rule a row breaks; a NULL rule counts as kept."""
    broken = F.array_compact(
        F.array(*(F.when(bad, F.lit(name)) for name, bad in rules.items()))
    )
    return df.select(key, F.explode(broken).alias("check"))


def foreign_text(
    df: DataFrame, key: str, value: str, labels: DataFrame, label_key: str, label: str
) -> DataFrame:
    """(key, label_key) wherever `value` contains the whole text of a label.

    Works for label lists of any size (a label must have a non-space character). A
    label is looked up by one piece that any text holding it must have: of its inner words
    the one that the fewest texts hold, so that a common word never makes all texts meet all
    labels; or, when it has no word between others, its longest word as a part of a word.

    Texts are cut into words once. Only the pieces that some label asks for are kept, as an index (piece, text)
    in the shared folder: while the labels are few enough to be broadcast, no word is shuffled at all, and else each once.
    Texts and labels that share a piece meet in an equi-join, and the containment is then tested on the whole text.
    """
    listed = labels.filter(F.col(label).rlike(r"\S")).select(
        F.col(label_key).alias("__lk"), F.col(label).alias("__label")
    )
    tokens = F.filter(F.split("__label", r"\s+"), lambda t: t != "")
    longest = F.reduce(tokens, F.lit(""), lambda best, x: F.when(F.length(x) > F.length(best), x).otherwise(best))
    inner = F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 2, F.lit(0)))
    pieces = keep(listed.select("__lk", inner.alias("__inner"), longest.alias("__piece")), "label-pieces")
    by_part = pieces.filter("size(__inner) = 0").select("__lk", "__piece")
    inside = pieces.select("__lk", F.explode(F.array_distinct("__inner")).alias("__piece"))

    words = F.split(F.col(value), r"\s+")
    lengths = sorted(by_part.agg(F.collect_set(F.length("__piece")).alias("n")).head()["n"])
    if lengths:  # parts of words, only of the lengths some label asks for
        fitting = lambda w: F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length(w))
        places = lambda w, n: F.sequence(F.lit(1), F.length(w) - n + 1)
        parts = lambda w: F.flatten(
            F.transform(fitting(w), lambda n: F.transform(places(w, n), lambda i: F.substring(w, i, n)))
        )
        words = F.concat(words, F.flatten(F.transform(F.array_distinct(words), parts)))
    asked = inside.select("__piece").unionByName(by_part.select("__piece")).distinct()
    cut = df.select(F.col(key).alias("__k"), F.explode(F.array_distinct(words)).alias("__piece"))
    index = keep(cut.join(asked, "__piece", "left_semi"), "piece-index")

    held = index.groupBy("__piece").agg(F.count(F.lit(1)).alias("__n"))
    # a label with an inner word that no text holds is in no text
    by_word = (
        inside.join(held, "__piece", "left")
        .groupBy("__lk")
        .agg(F.min_by("__piece", F.struct(F.coalesce("__n", F.lit(0)), "__piece")).alias("__piece"))
    )
    pairs = index.join(by_word.unionByName(by_part), "__piece").select("__k", "__lk").distinct().join(listed, "__lk")
    whole = df.select(F.col(key).alias("__k"), F.col(value).alias("__value"))
    return (
        whole.join(pairs, "__k")
        .filter(F.contains(F.col("__value"), F.col("__label")))
        .select(F.col("__k").alias(key), F.col("__lk").alias(label_key))
    )


def foreign_labels(df: DataFrame, key: str, columns: Sequence[str], labels: DataFrame) -> DataFrame:
    """D4 over all text columns of a table: (key, column, label) wherever a column's text contains a printed
    label (`labels`: label, field) of another column. A label in the column it belongs to is no
    contamination. Text and labels are compared folded.
    """
    texts = F.array(*(F.struct(F.lit(c).alias("column"), fold(F.col(c).cast("string")).alias("text")) for c in columns))
    cells = df.select(F.col(key).alias("__key"), F.inline(texts)).filter("text <> ''")
    cells = cells.select(F.struct("__key", "column").alias("__cell"), "text")
    listed = labels.select(F.struct("label", "field").alias("__of"), fold("label").alias("__folded"))
    found = foreign_text(cells, "__cell", "text", listed, "__of", "__folded")
    return found.filter("__cell.column <> __of.field").select(
        F.col("__cell.__key").alias(key), F.col("__cell.column").alias("column"), F.col("__of.label").alias("label")
    )


def seeded(key: str, seed: int) -> Column:
    """A repeatable shuffle position for a key."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))


def random_sample(df: DataFrame, key: str, n: int | None = 500, seed: int = 7) -> DataFrame:
    """`n` rows drawn by key, the same ones for the same seed; None = all."""
    if n is None:
        return df
    return df.orderBy(seeded(key, seed), key).limit(n)


def canary_sample(
    df: DataFrame, key: str, recency: str, n: int = 60, recent_share: float = 1 / 3, seed: int = 7
) -> DataFrame:
    """The quick-test sample: the latest third, the rest drawn from what remains."""
    n_recent = round(n * recent_share)
    latest = df.orderBy(F.col(recency).desc_nulls_last(), F.col(key).desc()).limit(n_recent)
    others = df.join(F.broadcast(latest.select(key)), key, "left_anti")
    return latest.withColumn("draw", F.lit("recent")).unionByName(
        random_sample(others, key, n - n_recent, seed).withColumn("draw", F.lit("random"))
    )


def verdict(check_results: DataFrame) -> DataFrame:
    """One row: `may run` when every check is within its limit."""
    ok = F.coalesce(F.bool_and("ok"), F.lit(True))
    return check_results.agg(
        F.when(ok, "may run").otherwise("do not run yet").alias("verdict"),
        F.count_if(~F.col("ok")).alias("n_failed"),
        F.count(F.lit(1)).alias("n_checks"),
    )

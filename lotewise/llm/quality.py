"""Quality filtering by weak supervision: rules vote, their accuracies are estimated.

Each rule reads one measure of a text and votes good, bad, or abstains. Expectation-
maximisation over the vote patterns of all documents estimates how accurate each rule is,
without labels; a document is kept when the posterior probability of good reaches
`KEEP`. Two fixed rules (fewer than 50 words, more than half of the words inside repeated
three-word windows) drop a document whatever the vote.

DataFrame functions alone; the driver gets the counts of vote patterns, at most 3 to the
power of the number of rules, and iterates on those. Null and empty texts have no words
and are not kept. Repeated rows get equal results; further columns are left alone. Work
and memory per row grow with its text; nothing is shuffled but the counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotewise.llm import weak
from lotewise.llm.common import GAP, WORD, let
from lotewise.session import keep

SYMBOLS = "[#*$%&|<>]"
#: A word of letters and digits, with one mark after it at most.
PLAIN = r"(?<![^\x20\x09-\x0D])[\p{L}\p{N}'-]++[.,;:!?]?+(?![^\x20\x09-\x0D])"
KEEP = 0.5



def _share(part: str, whole: str) -> Callable:
    return lambda q: q[part] / F.greatest(q[whole], F.lit(1))


#: Rule: (measure, votes good up to, votes bad from); between the two it abstains.
RULES: dict[str, tuple[Callable, float, float]] = {
    "repeated_words": (_share("n_repeat_words", "n_words"), 0.15, 0.30),
    "symbols": (_share("n_symbols", "n_words"), 0.05, 0.20),
    "dup_lines": (_share("n_dup_lines", "n_lines"), 0.10, 0.50),
    "capitals": (_share("n_capitals", "n_letters"), 0.20, 0.50),
    "exclaimed": (_share("n_exclaimed", "n_words"), 0.05, 0.20),
    "same_word": (_share("n_same", "n_words"), 0.05, 0.15),
    "odd_words": (lambda q: 1 - _share("n_plain", "n_words")(q), 0.25, 0.40),
    "word_length": (lambda q: F.abs(_share("word_chars", "n_words")(q) - 6.0), 3.0, 5.0),
}
MEASURES = [
    "n_words", "word_chars", "n_repeat_words", "n_same", "n_lines", "n_dup_lines",
    "n_symbols", "n_plain", "n_exclaimed", "n_capitals", "n_letters",
]


def words(text: Column) -> Column:
    """The words of a text, never null."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\x20\x09-\x0D]+", "")
    return F.filter(F.split(trimmed, GAP, -1), lambda w: w != "")


def repeat_words(w: Column) -> Column:
    """Words that stand in a three-word window found twice or more in the text.

    Windows are compared by 64-bit hash. Only texts in which a hash repeats sort the
    windows with their places; the union of the marked windows is then measured from gap
    to gap."""

    def hashes(w: Column) -> Column:
        last = F.size(w) - 2
        return F.transform(
            F.sequence(F.lit(0), last - 1), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        )

    def covered(h: Column) -> Column:
        placed = F.sort_array(F.arrays_zip(h.alias("h"), F.sequence(F.lit(0), F.size(h) - 1).alias("at")))

        def marked(p: Column) -> Column:
            same = lambda x, i: F.coalesce(F.get(p, i)["h"] == x["h"], F.lit(False))
            twice = F.filter(p, lambda x, i: same(x, i + 1) | same(x, i - 1))
            return F.sort_array(F.transform(twice, lambda x: x["at"]))

        return let(
            let(placed, marked),
            lambda at: F.aggregate(
                at,
                F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
                lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(x - a["last"], F.lit(3))).alias("n")),
            )["n"],
        )

    def of(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0)

    return F.when(F.size(w) >= 4, let(hashes(w), of)).otherwise(0)


def measured(text: Column) -> Column:
    """Struct of the `MEASURES` of a text, all longs; a null text counts as empty."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))

    def of_words(w: Column) -> list[Column]:
        same = F.filter(w, lambda x, i: F.coalesce(F.get(w, i - 1) == x, F.lit(False)))
        return [F.size(w), F.char_length(F.array_join(w, "")), repeat_words(w), F.size(same)]

    def of_lines(x: Column) -> list[Column]:
        return [F.size(x), F.size(x) - F.size(F.array_distinct(x))]

    counted = [F.regexp_count(text, F.lit(p)) for p in (SYMBOLS, PLAIN, "!!", "[A-Z]", "[A-Za-z]")]

    def whole(w: Column, x: Column) -> Column:
        every = [*of_words(w), *of_lines(x), *counted]
        return F.struct(*(c.cast("long").alias(n) for n, c in zip(MEASURES, every, strict=True)))

    return let(words(text), lambda w: let(lines, lambda x: whole(w, x)))


def votes(q: Column) -> list[Column]:
    """One of 1, 0 and -1 for each rule, from the measures; a text without words has only bad ones."""

    def vote(measure: Callable, good: float, bad: float) -> Column:
        x = measure(q)
        return F.when(q["n_words"] == 0, -1).when(x >= bad, -1).when(x <= good, 1).otherwise(0)

    return [vote(*rule) for rule in RULES.values()]


def failed(q: Column) -> Column:
    """The two fixed rules."""
    return (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])


def estimate(voted: DataFrame) -> weak.Reliabilities:
    counted = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).orderBy("votes").collect()
    return weak.estimate([(tuple(r.votes), r.n) for r in counted], len(RULES), prior=0.8, right=0.98, caught=0.3)


def probability(model: weak.Reliabilities, cast: list[Column]) -> Column:
    """The posterior probability that a document is good, from its votes."""
    total = F.lit(model.prior)
    for k, v in enumerate(cast):
        total = total + F.when(v > 0, model.when_yes[k]).when(v < 0, model.when_no[k]).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def judged(docs: DataFrame) -> DataFrame:
    """One row for each of `docs`, without its text: the measures, `base_failed`, the
    probability of good as `p_good`, and `kept`."""
    named = {c: f"__in_{i}" for i, c in enumerate(docs.columns) if c != "text"}
    measures = docs.select(*(F.col(c).alias(n) for c, n in named.items()), measured(F.col("text")).alias("q"))
    voted = keep(measures.withColumn("votes", F.array(*votes(F.col("q")))), "quality")
    cast = [F.get("votes", F.lit(k)) for k in range(len(RULES))]
    p_good = probability(estimate(voted), cast)
    outside = [F.col(n).alias(c) for c, n in named.items() if c not in {*MEASURES, "base_failed", "p_good", "kept"}]
    return voted.select(
        *outside,
        "q.*",
        failed(F.col("q")).alias("base_failed"),
        p_good.alias("p_good"),
        (~failed(F.col("q")) & (p_good >= KEEP)).alias("kept"),
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that are kept, with their columns as they are. The texts are
    measured twice, once to estimate and once to filter, and not shuffled."""
    text = F.col("text")
    model = estimate(keep(docs.select(let(measured(text), lambda q: F.array(*votes(q))).alias("votes")), "votes"))
    return docs.filter(
        let(measured(text), lambda q: ~failed(q) & (probability(model, votes(q)) >= KEEP))
    )


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good"
    )

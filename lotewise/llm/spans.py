"""Places of pattern matches in a text, by column expressions alone.

A span is (start, end, m): code points, end exclusive, and the matched text. Matches are
leftmost and do not overlap. Patterns use possessive repeats, so no match needs a stack
that grows with the text, and start only where a run of their first characters starts
(or where the last match ended, \\G), so a long run is read once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotewise.llm.common import let

SPANS = "array<struct<start:int,end:int,m:string>>"
#: Tagged spans: `kind` is the place of the kind in the list of kinds.
TAGGED = "array<struct<kind:int,start:int,end:int,m:string>>"


def find(text: Column, pattern: str) -> Column:
    """The spans of `pattern`; none for a null text. Texts without a match, which most
    are, are read once and build nothing."""

    def places(t: Column) -> Column:
        parts = F.zip_with(
            F.regexp_extract_all(t, F.lit(pattern), F.lit(0)),
            F.split(t, pattern, -1),
            lambda m, gap: F.struct(m.alias("m"), gap.alias("gap")),
        )
        nothing = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("found"))

        def step(done: Column, part: Column) -> Column:
            start = done["at"] + F.char_length(part["gap"])
            end = start + F.char_length(part["m"])
            span = F.struct(start.alias("start"), end.alias("end"), part["m"].alias("m"))
            return F.struct(end.alias("at"), F.concat(done["found"], F.array(span)).alias("found"))

        return F.aggregate(F.filter(parts, lambda p: p["m"].isNotNull()), nothing, step)["found"]

    return F.when(text.rlike(pattern), places(text)).otherwise(F.array().cast(SPANS))


def tag(spans: Column, kind: int) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["m"].alias("m")
        ),
    )


def apart(spans: Column, others: Column) -> Column:
    """The spans that overlap none of `others`."""
    return let(
        others,
        lambda o: F.filter(
            spans, lambda s: ~F.exists(o, lambda x: (x["start"] < s["end"]) & (s["start"] < x["end"]))
        ),
    )


def outside(spans: Column, others: Column) -> Column:
    """The parts of the tagged spans that lie outside all of `others`, which are in order of start."""

    def cut(o: Column, s: Column) -> Column:
        def part(start: Column, end: Column) -> Column:
            m = F.substring(s["m"], start - s["start"] + 1, end - start)
            piece = F.struct(s["kind"].alias("kind"), start.alias("start"), end.alias("end"), m.alias("m"))
            return F.when(start < end, F.array(piece)).otherwise(F.array().cast(TAGGED))

        def step(done: Column, x: Column) -> Column:
            found = F.concat(done["found"], part(done["at"], x["start"]))
            return F.struct(F.greatest(done["at"], x["end"]).alias("at"), found.alias("found"))

        touching = F.filter(o, lambda x: (x["start"] < s["end"]) & (s["start"] < x["end"]))
        nothing = F.struct(s["start"].alias("at"), F.array().cast(TAGGED).alias("found"))
        rest = lambda t: F.aggregate(t, nothing, step, lambda d: F.concat(d["found"], part(d["at"], s["end"])))
        return let(touching, lambda t: F.when(F.size(t) > 0, rest(t)).otherwise(F.array(s)))

    return let(others, lambda o: F.flatten(F.transform(spans, lambda s: cut(o, s))))


def count(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def listed(spans: Column, kinds: list[str]) -> Column:
    """`kind:start:end`, comma-joined, in the order of the array."""
    names = F.array(*map(F.lit, kinds))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def by_start(spans: Column) -> Column:
    """Sorted by start, then by kind."""
    keyed = F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"], s["m"]))
    return F.transform(
        F.sort_array(keyed),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["m"].alias("m")),
    )


def masked(text: Column, spans: Column, kinds: list[str]) -> Column:
    """`text` with each span replaced by [KIND]; where spans overlap, the one that starts
    first covers the rest."""
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in kinds))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        before = F.substring(text, done["at"] + 1, s["start"] - done["at"])
        fresh = F.struct(s["end"].alias("at"), F.concat(done["out"], before, F.get(names, s["kind"])).alias("out"))
        return F.when(s["start"] < done["at"], done).otherwise(fresh)

    hidden = let(
        F.aggregate(by_start(spans), start, step),
        lambda d: F.concat(d["out"], F.substring(text, d["at"] + 1, 2147483647)),
    )
    return F.when(F.size(spans) > 0, hidden).otherwise(text)


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check; for short strings only."""
    return reduce(lambda a, b: a + b, [_digit(number, i) for i in range(1, 20)]) % 10 == 0


def _digit(number: Column, i: int) -> Column:
    """The i-th digit from the right, doubled (digits added) where i is even; 0 beyond."""
    d = F.when(F.char_length(number) >= i, F.substring(number, -i, 1).cast("int")).otherwise(0)
    return d if i % 2 else F.when(d > 4, d * 2 - 9).otherwise(d * 2)

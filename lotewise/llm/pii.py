"""Personal data in texts: labelers vote on candidate spans, a classifier decides.

Candidates are what the fixed patterns find and what wider ones add (local phone numbers,
spelled-out mail addresses, names after a title, account and insurance numbers). Five labelers vote
on each or abstain: a strict pattern, a gazetteer, cue words before the span, the variety
of its digits, and its borders. Expectation-maximisation over the vote patterns of all
candidates estimates how far each labeler can be relied on; the posterior of each pattern
then trains a logistic classifier of votes, kind and shape, which decides. Spans of the
fixed patterns always stay.

DataFrame functions alone; the driver gets the counts of the vote patterns, at most
243 x 2 for each of the nine kinds, and fits from them. Null and empty texts have no spans;
repeated rows get equal results; further columns are left alone; without any candidate
nothing is added. Work and memory per row grow with its text.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotewise.llm import spans, weak
from lotewise.llm.common import let
from lotewise.session import keep

# The patterns of the four kinds, written so that a run is read once.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
KINDS = ["email", "ip", "card", "phone", "spelled_email", "local_phone", "name", "account", "insurance"]

WIDER = {
    4: r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?"
    r"[A-Za-z0-9-]{1,63}+\x20?(?:\(dot\)|\[dot\]|\x20dot\x20)\x20?[A-Za-z]{2,12}(?![A-Za-z])",
    5: r"(?<![0-9A-Za-z+(.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])",
    6: r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.?\x20[A-Z][a-z]{1,30}(?:\x20[A-Z][a-z]{1,30})?",
    7: r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?![A-Z0-9])",
    8: r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
ANY_WIDER = "|".join(WIDER.values())

LABELERS = 5
#: Characters before a span in which cue words count.
CONTEXT = 40
CUES = {
    0: "mail|contact|write to|reach|e-?mail", 1: r"\bip\b|address|host|server|login", 2: "card|visa|pay|credit|master",
    3: "call|phone|tel|mobile|fax", 4: "mail|contact|reach", 5: "call|phone|tel|mobile|fax", 6: "name|dear|contact|sincerely|by",
    7: "iban|account|bank", 8: "ssn|social|insurance",
}
AGAINST = r"version|release|isbn|issn|serial|build|revision|section|chapter"
DOMAINS = "com|org|net|edu|gov|io|de|fr|es|uk|it|nl|ch|at|br|pt|eu|info|biz|us|ca|au|jp"
GIVEN = (
    "James|John|Robert|Michael|William|David|Richard|Joseph|Thomas|Mary|Patricia|Jennifer|Linda|Elizabeth|Barbara|Susan|"
    "Hans|Peter|Anna|Maria|Jean|Pierre|Marie|Sophie|Jose|Juan|Carmen|Ana|Luis|Carlos"
)


def base_spans(text: Column) -> Column:
    """What the fixed patterns find, kind after kind."""
    parts = [
        spans.find(text, EMAIL),
        F.filter(spans.find(text, IP), lambda s: s["m"].rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")),
        F.filter(
            spans.find(text, CARD),
            lambda s: let(
                spans.digits(s["m"]), lambda d: F.char_length(d).between(13, 19) & spans.luhn(F.substring(d, 1, 19))
            ),
        ),
        F.filter(spans.find(text, PHONE), lambda s: F.char_length(spans.digits(s["m"])).between(9, 15)),
    ]
    return F.concat(*(spans.tag(p, k) for k, p in enumerate(parts)))


def wider_spans(text: Column) -> Column:
    def kind(s: Column) -> Column:
        return reduce(
            lambda rest, k: F.when(s["m"].rlike(f"^(?:{WIDER[k]})$"), k).otherwise(rest), reversed(WIDER), F.lit(6)
        )

    return F.transform(
        spans.find(text, ANY_WIDER),
        lambda s: F.struct(kind(s).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["m"].alias("m")),
    )


def _votes(text: Column, s: Column) -> list[Column]:
    def vote(yes: Column, no: Column) -> Column:
        return F.when(no, -1).when(yes, 1).otherwise(0)

    kind, m = s["kind"], s["m"]
    never = F.lit(False)
    number = spans.digits(m)
    before = F.lower(F.substring(text, F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1, F.least(s["start"], F.lit(CONTEXT))))
    cue = reduce(lambda rest, k: rest | ((kind == k) & before.rlike(CUES[k])), CUES, never)
    numeric = kind.isin(2, 3, 5, 7, 8)
    strict = vote(
        kind.isin(1, 2)
        | ((kind == 0) & m.rlike(r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\.[A-Za-z]{2,12}$"))
        | ((kind == 3) & m.rlike(r"^\+[1-9][0-9]{0,2}[\x20.-]?\(?[0-9]"))
        | ((kind == 5) & m.rlike(r"^\([2-9][0-9]{2}\)\x20?[2-9]"))
        | ((kind == 7) & m.rlike(r"^(?:AT|BE|CH|DE|ES|FR|GB|IT|NL|PT)[0-9]{2}")),
        ((kind == 0) & m.rlike(r"^[.%+-]|\.\.|@-")) | ((kind == 5) & m.rlike(r"^\(?[01]")) | ((kind == 8) & m.rlike("^(?:000|666|9)")),
    )
    listed = vote(
        ((kind == 0) & m.rlike(rf"\.(?:{DOMAINS})$"))
        | ((kind == 4) & m.rlike(rf"[\x20)\]](?:{DOMAINS})$"))
        | ((kind == 6) & m.rlike(rf"\x20(?:{GIVEN})(?:\x20|$)"))
        | ((kind == 2) & number.rlike("^(?:4|5[1-5]|3[47]|6011)")),
        (kind == 4) & ~m.rlike(rf"[\x20)\]](?:{DOMAINS})$"),
    )
    context = vote(cue, before.rlike(AGAINST))
    variety = vote(
        numeric & (F.char_length(number) > 0) & ~number.rlike(r"([0-9])\1{4}"),
        numeric & number.rlike(r"^([0-9])\1+$|0123456789|1234567890"),
    )
    after = F.substring(text, s["end"] + 1, F.lit(1))
    ahead = F.substring(text, s["start"], F.lit(1))
    inside = after.rlike("[A-Za-z0-9_]") | (ahead.rlike("[A-Za-z0-9_]") & (s["start"] > 0))
    borders = vote(~inside, inside)
    return [strict, listed, context, variety, borders]


CANDIDATES = (
    "array<struct<kind:int,start:int,end:int,m:string,fixed:boolean,"
    "v0:int,v1:int,v2:int,v3:int,v4:int,parted:boolean>>"
)


def candidates(text: Column) -> Column:
    """All candidate spans of a text with their votes; none for a null text."""

    def voted(base: Column) -> Column:
        def row(s: Column, fixed: bool) -> Column:
            votes = [v.alias(f"v{k}") for k, v in enumerate(_votes(text, s))]
            named = [s[c].alias(c) for c in ("kind", "start", "end", "m")]
            return F.struct(*named, F.lit(fixed).alias("fixed"), *votes, s["m"].rlike(r"[\x20().-]").alias("parted"))

        more = spans.apart(wider_spans(text), base)
        return F.concat(F.transform(base, lambda s: row(s, True)), F.transform(more, lambda s: row(s, False)))

    found = let(base_spans(text), voted)
    return F.coalesce(found.cast(CANDIDATES), F.array().cast(CANDIDATES))


def patterns(found: DataFrame) -> list:
    """Counts of (kind, votes, shape) over all candidates of `found.candidates`."""
    keys = ["kind", *(f"v{k}" for k in range(LABELERS)), "parted"]
    return (
        found.select(F.explode("candidates").alias("c"))
        .groupBy(*(F.col(f"c.{k}").alias(k) for k in keys))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(*keys)
        .collect()
    )


WIDTH = len(KINDS) + 2 * LABELERS + 1


def _features(kind: int, votes: tuple[int, ...], parted: bool) -> list[int]:
    cast = [len(KINDS) + 2 * k + (v < 0) for k, v in enumerate(votes) if v]
    return [kind, *cast, *([WIDTH - 1] if parted else [])]


def train(counted: list) -> list[float]:
    """Weights of the span classifier, the constant last; none without candidates."""
    if not counted:
        return []
    votes = [tuple(r[f"v{k}"] for k in range(LABELERS)) for r in counted]
    model = weak.estimate([(v, r.n) for v, r in zip(votes, counted)], LABELERS)
    rows = [
        (_features(r.kind, v, r.parted), float(r.n), 1 / (1 + math.exp(-model.log_odds(v))))
        for v, r in zip(votes, counted)
    ]
    return weak.fit_logistic(rows, WIDTH)


def accepted(found: Column, weights: list[float]) -> Column:
    """The spans that stay, as tagged spans by kind, then by start."""

    def score(s: Column) -> Column:
        total = F.lit(weights[-1]) + F.get(F.array(*map(F.lit, weights[: len(KINDS)])), s["kind"])
        for k in range(LABELERS):
            yes, no = weights[len(KINDS) + 2 * k], weights[len(KINDS) + 2 * k + 1]
            total = total + F.when(s[f"v{k}"] > 0, yes).when(s[f"v{k}"] < 0, no).otherwise(0.0)
        return total + F.when(s["parted"], weights[WIDTH - 1]).otherwise(0.0)

    kept = F.filter(found, lambda s: s["fixed"] | (score(s) > 0)) if weights else F.filter(found, lambda s: s["fixed"])
    bare = F.transform(kept, lambda s: F.struct(s["kind"], s["start"], s["end"], s["m"]))
    return F.sort_array(bare).cast(spans.TAGGED)


def fixed(found: Column) -> Column:
    kept = F.filter(found, lambda s: s["fixed"])
    return F.transform(kept, lambda s: F.struct(s["kind"], s["start"], s["end"], s["m"])).cast(spans.TAGGED)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans) for each row: tagged spans by kind, then by start."""
    found = keep(docs.select("doc_id", candidates(F.col("text")).alias("candidates")), "pii")
    weights = train(patterns(found))
    return found.select(
        "doc_id", fixed(F.col("candidates")).alias("base"), accepted(F.col("candidates"), weights).alias("spans")
    )


def mask_personal_data(docs: DataFrame) -> DataFrame:
    """`docs` with every span in `text` replaced by its kind in brackets. Other columns stay
    as they are; a null text stays null."""
    found = keep(docs.select(candidates(F.col("text")).alias("candidates")).filter("size(candidates) > 0"), "pii")
    weights = train(patterns(found))
    text = F.col("text")
    hidden = let(accepted(candidates(text), weights), lambda s: spans.masked(text, s, KINDS))
    return docs.withColumn("text", F.when(text.isNotNull(), hidden))


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        *(spans.count(F.col("base"), k).alias(f"n_{name}") for k, name in enumerate(KINDS[:4])),
        F.sha2(spans.listed(F.col("base"), KINDS), 256).alias("base_sha256"),
        spans.listed(F.col("spans"), KINDS).alias("spans"),
    )

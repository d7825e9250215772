"""Secrets in texts: fixed patterns, and runs that look random to two Markov models.

A run of 16 or more characters of the base64 and identifier alphabets is scored by the
logarithm of its probability under a Markov model of random strings over that under a
model of ordinary identifiers. Both are tables of character pairs, counted on labelled
samples that the corpus itself gives: values that the fixed patterns vouch for are
random, runs of letters alone are ordinary. At most `SAMPLES` distinct values of each
class, those whose hash is lowest, fit the models; every run of every text is scored,
one that a fixed pattern overlaps by its parts of 16 or more characters outside it.

DataFrame functions alone; the only thing the driver sees is the pair counts, at most
two per pair of the 66 characters. Null and empty texts have no spans; repeated rows get
equal results; further columns are left alone; without samples of either class no run
is called random. Work and memory per row grow with its text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotewise.llm import spans
from lotewise.session import keep

# The patterns of the three kinds.
ASSIGN = (
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"

KINDS = ["assign", "access", "hex", "random"]
#: A candidate run; shorter ones give the models too little to go by, and a run without a
#: letter is a number.
RUN_CHARS = 16
RUN = rf"[A-Za-z0-9+/_=-]{{{RUN_CHARS},}}+"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SAMPLES = 20_000
#: Longest value that may be a sample.
SAMPLE_CHARS = 256
#: One run in a thousand is taken to be a secret.
ODDS = math.log(1000)


def base_spans(text: Column) -> Column:
    """What the fixed patterns find, kind after kind."""
    assign = F.filter(
        spans.find(text, ASSIGN), lambda s: F.char_length(F.regexp_extract(s["m"], ASSIGN, 2)) >= 6
    )
    return F.concat(
        spans.tag(assign, 0), spans.tag(spans.find(text, ACCESS), 1), spans.tag(spans.find(text, HEX), 2)
    )


def scanned(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with `base` and `runs`, the candidates: what base spans leave of each run, where it
    is long enough and has a letter."""
    with_base = docs.withColumn("base", F.coalesce(base_spans(F.col(text)), F.array().cast(spans.TAGGED)))
    lettered = F.filter(spans.find(F.col(text), RUN), lambda s: s["m"].rlike("[A-Za-z]"))
    parts = spans.outside(spans.tag(lettered, 3), spans.by_start(F.col("base")))
    runs = F.filter(parts, lambda s: (F.char_length(s["m"]) >= RUN_CHARS) & s["m"].rlike("[A-Za-z]"))
    return with_base.withColumn("runs", F.coalesce(runs, F.array().cast(spans.TAGGED)))


def pair_ratios(found: DataFrame) -> list[float]:
    """The log-likelihood ratio of each character after each other (or after the start),
    row by row of the alphabet, from the labelled samples in `found` (base, runs)."""
    value = F.when(F.col("s.kind") == 0, F.regexp_extract("s.m", ASSIGN, 2)).otherwise(F.col("s.m"))
    secret = found.select(F.explode("base").alias("s")).select(value.alias("v"))
    plain = found.select(F.explode("runs").alias("s")).select(F.col("s.m").alias("v"))

    def sample(values: DataFrame, fits: str, label: int) -> DataFrame:
        fit = values.filter(F.col("v").rlike(fits) & (F.char_length("v") <= SAMPLE_CHARS)).distinct()
        return fit.orderBy(F.xxhash64("v"), "v").limit(SAMPLES).select(F.lit(label).alias("label"), "v")

    rows = sample(secret, "^[A-Za-z0-9+/_=-]+$", 1).unionByName(sample(plain, "^[A-Za-z]+$", 0))
    pairs = rows.select(
        "label",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.char_length("v")), lambda i: F.substring(F.concat(F.lit("^"), "v"), i, F.lit(2))
            )
        ).alias("pair"),
    )
    seen = {(r.label, r.pair): r.n for r in pairs.groupBy("label", "pair").agg(F.count(F.lit(1)).alias("n")).collect()}
    if {label for label, _ in seen} != {0, 1}:
        return []

    def chance(label: int, a: str) -> list[float]:
        row = [seen.get((label, a + b), 0) + 0.5 for b in ALPHABET]
        return [math.log(n / sum(row)) for n in row]

    return [x - y for a in "^" + ALPHABET for x, y in zip(chance(1, a), chance(0, a))]


def log_ratio(run: Column, ratios: list[float]) -> Column:
    """The summed ratio of a run of the alphabet's characters."""
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ",").cast("array<double>")
    place = F.transform(
        F.sequence(F.lit(1), F.char_length(run)), lambda i: F.instr(F.lit(ALPHABET), F.substring(run, i, F.lit(1)))
    )
    start = F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("sum"))
    return F.aggregate(
        place,
        start,
        lambda a, p: F.struct(
            p.alias("last"), (a["sum"] + F.get(table, a["last"] * len(ALPHABET) + p - 1)).alias("sum")
        ),
    )["sum"]


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans) for each row: tagged spans by start, then by kind."""
    found = keep(scanned(docs.select("doc_id", "text")).drop("text"), "secrets")
    ratios = pair_ratios(found)
    random = (
        F.filter("runs", lambda r: log_ratio(r["m"], ratios) > ODDS) if ratios else F.array().cast(spans.TAGGED)
    )
    return found.select(
        "doc_id", spans.by_start(F.col("base")).alias("base"), spans.by_start(F.concat("base", random)).alias("spans")
    )


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        *(spans.count(F.col("base"), k).alias(f"n_{name}") for k, name in enumerate(KINDS[:3])),
        F.sha2(spans.listed(F.col("base"), KINDS), 256).alias("base_sha256"),
        spans.listed(F.col("spans"), KINDS).alias("spans"),
    )

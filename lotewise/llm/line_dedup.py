"""Line dedup by winnowing: repeated runs of lines are found by guaranteed fingerprints.

A line ends at a line feed or, so that a passage inside a long line is seen too, after a
full stop, exclamation or question mark, whatever its length. Blank lines are left out first: what is
said here of lines and their neighbours is said of lines with words. Blank lines inside a run go with it,
those before and after stay. Lines are compared by the hash of what stands
between their outer white space, and hashed again in pairs of neighbours. Fingerprints are
the smaller of every two neighbouring pair hashes, and whatever has `MIN_WORDS` words by
itself, a pair or a line. A run of that many words holds at least one of these, and the
same ones wherever it stands.

Every fingerprint is joined to its first place in the corpus, in the order of doc_id, text
hash and position, and the match is extended by the lines before and after, where those are
equal too. Where one is not, the fingerprint together with that line is looked up in the same
way, so a match reaches as far as any earlier place of the passage has it; every line of a run
is within that reach of a fingerprint. Matches that share a line make one run, and runs of at
least `MIN_WORDS` words are deleted. Only first places are joined, so a line that stands in a
third of all documents gives one row for each of them, never a pair, and a match is two numbers.

DataFrame functions alone. Nulls: a null text stays null; a null doc_id counts as the largest.
Rows equal in doc_id and text (in 31 bits of its hash, among rows of one id) are one document
and get equal results. Empty texts have no lines. Further columns are left alone; no documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotewise.llm.common import let, text_key
from lotewise.operators.joins import many_to_one
from lotewise.session import keep

#: The least length of a line: none. Where a line ends depends on nothing before it.
LINE_CHARS = 0
LINE = r"[^\n.!?]*+[\n.!?]++[\x20\t\r]*+|[^\n.!?]++"
BLANK = " \t\r\n\x0b\x0c"
WORDS = r"[^\x20\x09-\x0D]++"
MIN_WORDS = 25
LAST = (1 << 63) - 1


def lines(text: Column) -> Column:
    """The lines of a text with their ends; put together they are the text."""
    return F.regexp_extract_all(text, F.lit(LINE), F.lit(0))


def hashes(parts: Column) -> Column:
    return F.transform(parts, lambda x: F.xxhash64(F.btrim(x, F.lit(BLANK))))


def word_counts(parts: Column) -> Column:
    return F.transform(parts, lambda x: F.regexp_count(x, F.lit(WORDS)))


def fingerprints(hashed: DataFrame) -> DataFrame:
    """(print, doc, spot, around) of the selected places of `hashed` (doc, key, h, w).

    `spot` packs the key, the first line and how many lines less one, and sorts like them;
    `around` the hashes of the lines before and after, cut to 31 bits, plus one: 0 is no line.
    These rows are all that is shuffled, and whole longs with few zeros in them compress best.
    """

    def short(h: Column, i: Column) -> Column:
        return F.coalesce(F.get(h, i).bitwiseAND(0x7FFFFFFF) + 1, F.lit(0).cast("long"))

    def place(h: Column, i: Column, size: int, name: Column) -> Column:
        around = F.shiftleft(short(h, i - 1), 32).bitwiseOR(short(h, i + size))
        return F.struct(name.alias("print"), (i * 2 + (size - 1)).alias("at"), around.alias("around"))

    def pairs(h: Column, w: Column) -> Column:
        twice = F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 1)))

        def least(g: Column) -> Column:
            last = F.size(g) - 2  # the last line has no partner
            words = lambda i: F.get(w, i) + F.get(w, i + 1)
            ahead = lambda i: (i < last) & (F.get(g, i) <= F.get(g, i + 1))
            behind = lambda i: (i > 0) & (F.get(g, i) <= F.get(g, i - 1))
            chosen = F.filter(
                F.sequence(F.lit(0), last),
                lambda i: ahead(i) | behind(i) | (words(i) >= MIN_WORDS),
            )
            return F.transform(chosen, lambda i: place(h, i, 2, F.get(g, i)))

        return let(twice, least)

    h, w = F.col("h"), F.col("w")
    long = F.transform(
        F.filter(F.sequence(F.lit(0), F.size(h) - 1), lambda i: F.get(w, i) >= MIN_WORDS),
        lambda i: place(h, i, 1, F.get(h, i)),
    )
    chosen = F.when(F.size(h) > 1, F.concat(pairs(h, w), long)).otherwise(long)
    spot = F.shiftleft(F.col("key").cast("long"), 32).bitwiseOR(F.col("f.at").cast("long"))
    return hashed.select("doc", "key", F.explode(chosen).alias("f")).select(
        "f.print", "doc", spot.alias("spot"), "f.around"
    )


RANGES = "array<struct<start:int,end:int>>"


def met(prints: DataFrame) -> DataFrame:
    """The rows of `prints` whose print has an earlier place, with `there`, what is around its first."""
    place = F.struct("doc", "spot", "around")
    first = prints.groupBy("print").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return (
        many_to_one(prints, first, ["print"])
        .filter(~((F.col("doc") == F.col("first.doc")) & (F.col("spot") == F.col("first.spot"))))
        .select("print", "doc", "spot", "around", F.col("first.around").alias("there"))
    )


def matches(hashed: DataFrame) -> DataFrame:
    """(doc, key, ranges): the stretches of a document that stand, each as a whole, in an
    earlier place."""

    def side(around: str, k: int) -> Column:
        return F.shiftrightunsigned(around, 32) if k == 0 else F.col(around).bitwiseAND(0xFFFFFFFF)

    def same(k: int) -> Column:
        return (side("around", k) != 0) & (side("around", k) == side("there", k))

    def wider(k: int) -> Column:
        """The print with the line before (0) or after (1), where its first place has another."""
        name = F.xxhash64("print", F.lit(k), side("around", k))
        return F.when((side("around", k) != 0) & ~same(k), F.struct(name.alias("print"), F.lit(k).cast("long").alias("around")))

    def found(rows: DataFrame, before: Column, after: Column) -> DataFrame:
        key = F.shiftright("spot", 32).cast("int")
        packed = F.col("spot").bitwiseAND(0xFFFFFFFF).cast("int")
        at, size = F.shiftright(packed, 1), packed.bitwiseAND(1) + 1
        stretch = F.struct((at - before.cast("int")).alias("start"), (at + size + after.cast("int")).alias("end"))
        return rows.select("doc", key.alias("key"), stretch.alias("range"))

    again = keep(met(fingerprints(hashed)), "prints")
    both = F.filter(F.array(wider(0), wider(1)), lambda x: x.isNotNull())
    wide = again.select("doc", "spot", F.explode(both).alias("f")).select("f.print", "doc", "spot", "f.around")
    ranges = found(again, same(0), same(1)).unionByName(
        found(met(wide), F.col("around") == 0, F.col("around") == 1)
    )
    return ranges.groupBy("doc", "key").agg(F.collect_list("range").alias("ranges"))


def repeated(w: Column, ranges: Column) -> Column:
    """The runs (start, end exclusive) to delete: ranges that share a line put together, of
    enough words by `w`."""
    empty = F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.array().cast(RANGES).alias("found"))

    def close(s: Column) -> Column:
        words = F.aggregate(F.slice(w, s["start"] + 1, s["end"] - s["start"]), F.lit(0), lambda a, x: a + x)
        run = F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))
        return F.when(words >= MIN_WORDS, F.concat(s["found"], run)).otherwise(s["found"])

    def step(s: Column, x: Column) -> Column:
        joined = F.struct(s["start"].alias("start"), F.greatest(s["end"], x["end"]).alias("end"), s["found"].alias("found"))
        fresh = F.struct(x["start"].alias("start"), x["end"].alias("end"), close(s).alias("found"))
        return F.when(x["start"] < s["end"], joined).otherwise(fresh)

    return F.aggregate(F.sort_array(ranges), empty, step, close)


def dedup(docs: DataFrame) -> DataFrame:
    """`docs` with repeated runs deleted from `text`, and `n_deleted`, the lines it has lost."""
    doc = F.coalesce(F.col("doc_id"), F.lit(LAST))
    key = text_key(F.col("text")).bitwiseAND(0x7FFFFFFF).cast("int")  # tells rows of one id apart
    parts = lines(F.col("text"))

    def spoken(p: Column, body) -> Column:
        """`body(places, words)` of the lines that have words: blank ones are no lines here."""
        return let(
            word_counts(p),
            lambda w: let(
                F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.get(w, i) > 0),
                lambda at: body(at, F.transform(at, lambda i: F.get(w, i))),
            ),
        )

    counted = let(
        parts,
        lambda p: spoken(p, lambda at, w: F.struct(hashes(F.transform(at, lambda i: F.get(p, i))).alias("h"), w.alias("w"))),
    )
    hashed = docs.filter("text <> ''").select(doc.alias("doc"), key.alias("key"), counted.alias("c"))
    found = matches(keep(hashed.select("doc", "key", "c.h", "c.w"), "lines"))
    named = found.select(F.col("doc").alias("__doc"), F.col("key").alias("__key"), F.col("ranges").alias("__ranges"))
    joined = many_to_one(docs.withColumns({"__doc": doc, "__key": key}), named, ["__doc", "__key"], "left")

    def without(p: Column, runs: Column) -> Column:
        kept = F.filter(p, lambda x, i: ~F.exists(runs, lambda r: (r["start"] <= i) & (i < r["end"])))
        return let(kept, lambda k: F.struct(F.array_join(k, "").alias("text"), (F.size(p) - F.size(k)).alias("n")))

    def placed(at: Column, runs: Column) -> Column:
        """Runs of spoken lines as runs of all lines."""
        return F.transform(
            runs, lambda r: F.struct(F.get(at, r["start"]).alias("start"), (F.get(at, r["end"] - 1) + 1).alias("end"))
        )

    changed = let(
        parts,
        lambda p: spoken(p, lambda at, w: let(placed(at, repeated(w, F.col("__ranges"))), lambda r: without(p, r))),
    )
    same = F.struct(F.col("text").alias("text"), F.lit(0).alias("n"))
    done = joined.withColumn("__done", F.when(F.col("__ranges").isNull(), same).otherwise(changed))
    columns = [F.col("__done.text").alias("text") if c == "text" else F.col(c) for c in docs.columns]
    return done.select(*columns, F.col("__done.n").alias("n_deleted"))

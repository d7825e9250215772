from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from lotewise.llm import line_dedup
from tests.llm.helpers import ODD, documents, prose

LINE = re.compile(rf"(?s:.{{{line_dedup.LINE_CHARS}}})[^\n.!?]*[\n.!?]+[ \t\r]*|(?s:.+)")


def brute(rows, least=line_dedup.MIN_WORDS):
    """Deletes the runs of lines, of enough words, that stand in an earlier place."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    out = {}
    places: list[list[str]] = []
    for i in order:
        lines = LINE.findall(rows[i][1] or "")
        bare = [x.strip(" \t\r\n\x0b\x0c") for x in lines]
        words = [len(x.split()) for x in lines]
        gone = set()
        for earlier in [*places, bare]:
            for a in range(len(bare)):
                for b in range(len(earlier) if earlier is not bare else a):
                    n = 0
                    while a + n < len(bare) and b + n < len(earlier) and bare[a + n] == earlier[b + n]:
                        n += 1
                    if sum(words[a : a + n]) >= least:
                        gone |= set(range(a, a + n))
        places.append(bare)
        out[i] = "".join(x for k, x in enumerate(lines) if k not in gone) if rows[i][1] is not None else None
    return out


def test_against_brute_force(spark):
    rng = random.Random(9)
    own = [prose(1000 + i, 96) for i in range(40)]
    rows = []
    for i, text in enumerate(own):
        lines = LINE.findall(text + " ")
        for _ in range(2 if i >= 10 else 0):
            source = LINE.findall(own[rng.randrange(10)] + " ")
            at = rng.randrange(len(source))
            where = rng.randrange(len(lines))
            lines[where:where] = source[at : at + rng.randint(1, 7)]
        rows.append((i, "".join(lines)))
    rows.append((40, rows[3][1]))
    want = brute(rows)
    got = {r.doc_id: r.text for r in line_dedup.dedup(documents(spark, rows)).collect()}
    assert got == {rows[i][0]: t for i, t in want.items()}
    assert got[40] == ""


def test_common_short_lines_stay_and_passages_go(spark):
    passage = prose(77, 56)
    rows = [(i, f"All rights reserved.\n{prose(i, 40)} and so {passage} then {prose(500 + i, 40)}") for i in range(10)]
    got = {r.doc_id: r.text for r in line_dedup.dedup(documents(spark, rows)).collect()}
    inner = " ".join(passage.split()[8:48])
    assert inner in got[0]
    for i in range(1, 10):
        assert inner not in got[i]
        assert got[i].startswith(f"All rights reserved.\n{prose(i, 32)}")


def test_odd_rows(spark):
    docs = documents(spark, ODD)
    done = line_dedup.dedup(docs)
    assert done.columns == [*docs.columns, "n_deleted"]
    got = sorted(((r.doc_id, r.text) for r in done.collect()), key=repr)
    assert got == sorted(ODD, key=repr)
    assert line_dedup.dedup(documents(spark, [])).count() == 0
    periodic = [(1, "A line of seven words stands here.\n" * 50)]
    assert line_dedup.dedup(documents(spark, periodic)).first().text.count("seven") < 3


TRUE_LINE = re.compile(r"[^\n.!?]*[\n.!?]+[ \t\r]*|[^\n.!?]+")


def test_lines_of_any_length_are_the_unit(spark):
    table = "".join(f"cell {i:02d} a b\n" for i in range(80))
    long = " ".join(f"word{i}" for i in range(40)) + "\n"
    rows = [
        (1, table), (2, "cell xx a b\n" + table),
        (3, "Page 12\n" + long + "own ending\n"), (4, "Page 13\n" + long + "another\n"),
    ]
    got = {r.doc_id: r.text for r in line_dedup.dedup(documents(spark, rows)).collect()}
    assert got[1] == table
    assert got[2] == "cell xx a b\n"
    assert got[3] == rows[2][1]
    assert got[4] == "Page 13\nanother\n"
    for text in ["a. b!\n\nc", "no end", table, "e.g. this \n \n that?? \r\nx"]:
        assert spark.range(1).select(line_dedup.lines(F.lit(text)).alias("x")).first().x == TRUE_LINE.findall(text)


def test_passages_whose_parts_stand_first_elsewhere(spark):
    """A pair of lines alone is too short to go and has its first place between other lines;
    the passage as a whole stands in two later documents."""

    def line(seed):
        return prose(seed, 12, 12) + "\n"

    rows = []
    for n in range(12):
        passage = [line(9000 + 10 * n + k) for k in range(3 + n % 2)]
        parts = [passage[0:2], passage[2:4]] if n % 2 else [passage[1:3]]
        for k, part in enumerate([*parts, passage, passage]):
            at = 100 * n + 10 * k
            rows.append((at, line(at) + "".join(part) + line(at + 1)))
    got = {r.doc_id: r.text for r in line_dedup.dedup(documents(spark, rows)).collect()}
    assert got == {rows[i][0]: t for i, t in brute(rows).items()}


def test_blank_lines_between_hide_nothing(spark):
    """Paragraphs that end with a full stop, a carriage return and a line feed, with an empty one between."""
    rows = []
    for n in range(60):
        passage = f"{prose(9000 + n, 15, 15)}\r\n\r\n{prose(9500 + n, 15, 15)}\r\n"
        for k in range(2):
            at = 10_000 + 10 * n + 2 * k
            rows.append((2 * n + k, f"{prose(at, 20, 20)}\r\n{passage}{prose(at + 1, 20, 20)}\r\n"))
    got = {r.doc_id: r for r in line_dedup.dedup(documents(spark, rows)).collect()}
    for i, text in rows:
        said = [x.strip() for x in LINE.findall(got[i].text) if x.strip()]
        whole = [x.strip() for x in LINE.findall(text) if x.strip()]
        assert said == (whole if i % 2 == 0 else [whole[0], whole[-1]])
    assert line_dedup.dedup(documents(spark, [(1, "\r\n \n"), (2, "\n\n\n")])).filter("n_deleted > 0").count() == 0

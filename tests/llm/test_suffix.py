from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lotewise.llm import suffix_dedup as suffix
from tests.llm.helpers import ODD, documents, prose


def brute(rows):
    """Each window is looked up in all texts."""
    first: dict[bytes, int] = {}
    known = [(i, (t or "").encode()) for i, t in rows]
    for i, body in known:
        for k in range(len(body) - 49) if i is not None else ():
            window = body[k : k + 50]
            first[window] = min(first.get(window, i), i)
    out = []
    for i, body in known:
        gone = bytearray(len(body))
        for k in range(len(body) - 49) if i is not None else ():
            if first[body[k : k + 50]] < i:
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(body, gone) if not g)
        runs = sum(1 for run in bytes(gone).split(b"\0") if run)
        out.append((i, len(body), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows):
    return sorted((tuple(r) for r in suffix.remove_repeats(documents(spark, rows)).collect()), key=repr)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=80), st.sampled_from([1, 2, 3, 4, 9, 50]))
def test_ranks_follow_the_suffixes(symbols, need):
    order = np.argsort(suffix.ranks(np.array(symbols, np.int64), need), kind="stable")
    firsts = [symbols[i : i + need] for i in order]
    assert firsts == sorted(firsts)


def passages():
    rng = random.Random(5)
    line = prose(1, 40)
    rows = [(i, prose(100 + i, 60)) for i in range(30)]
    rows += [(50 + i, prose(200 + i, 20) + line + prose(300 + i, 20)) for i in range(20)]  # one passage in many
    rows += [(100 + i, rows[i % 4][1]) for i in range(12)]  # copies
    rows += [(130, line[:49]), (131, line[:50]), (132, line[10:60]), (133, "é" * 40), (134, "aé" + "é" * 40)]
    rows += [(140, "ab" * 4000), (141, "ba" * 30 + rng.choice("xyz")), (142, line + line)]
    return rows


@pytest.mark.parametrize("hot", [suffix.HOT, 0])
def test_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix, "HOT", hot)  # pieces whole, or all cut into windows
    if not hot:  # many buckets, shards and slices
        for name, value in (("BUCKET", 2000), ("PRINTS", 500), ("SHARD", 3000), ("SLICE", 1000), ("GATHERED", 4000)):
            monkeypatch.setattr(suffix, name, value)
    rows = passages() + ODD
    assert found(spark, rows) == brute(rows)


def test_long_texts(spark):
    body = prose(9, 60_000)
    rows = [(1, body), (2, "x" + body[5:-5] + "y"), (3, "z" * 400_000), (4, "z" * 60)]
    got = {r[0]: r for r in found(spark, rows)}
    assert got[1][2] == 0 and got[2][1] - got[2][2] == 2 and got[3][2] == 0 and got[4][2] == 60


def test_empty(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None), (None, "a" * 100), (2, "a" * 100)])[0][2] == 0

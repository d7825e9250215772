from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from lotewise.llm import conversation_trie as trie

SCHEMA = "conv_id long, turn int, role string, text string, path string, key binary, depth int"


def brute(rows):
    """(conv_id, depth, parent, n_convs, n_children, n_leaves, saved, ends) of every node."""
    said = {}
    for c, turn, role, text in rows:
        if c is not None:
            step = (role or "", text or "")
            tie = hashlib.md5(f"{len(step[0].encode())}:{step[0]}{step[1]}".encode()).digest()
            said.setdefault(c, []).append((turn is not None, turn or 0, tie, step))
    said = {c: [t[-1] for t in sorted(turns)] for c, turns in said.items()}
    members, ends, below = {}, {}, {}
    for c in said:
        h = zlib.crc32(str(c).encode()) % 4
        path = tuple(said.get(c - c % 20, [])[:h] + said[c][h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
        ends.setdefault(path, []).append(c)
    for node in members:
        if node:
            below.setdefault(node[:-1], []).append(node)
    out = []

    def walk(node):
        inner = [walk(n) for n in below.get(node, [])]
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        saved = sum(s for s, _ in inner) + (len(members[node]) - 1) * words
        leaves = sum(n for _, n in inner) or 1
        ids = ",".join(map(str, sorted(ends.get(node, []))))
        parent = min(members[node[:-1]]) if node else None
        sha = hashlib.sha256(ids.encode()).hexdigest()
        out.append((min(members[node]), len(node), parent, len(members[node]), len(inner), leaves, saved, sha))
        return saved, leaves

    if members:
        walk(())
    return sorted(out, key=repr)


def found(spark, rows):
    table = spark.createDataFrame([(*r, "x", b"y", 1) for r in rows], SCHEMA)
    got = trie.prefix_trie(trie.with_shared_heads(trie.turns(table)))
    return sorted((tuple(r) for r in got.collect()), key=repr)


def rows(seed=1):
    rng = random.Random(seed)
    out = []
    for c in range(0, 130):
        for turn in range(rng.randrange(6)):
            out.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(["yes", "no way", "so  it\tis"])))
    out += [(1000 + c, t, "user", f"copy {t}") for c in range(60) for t in range(3)]  # one group of copies
    return out


ODD = [
    (None, 1, "user", "no conversation"),
    (1, None, None, None),
    (1, None, "user", ""),
    (1, 2, "user", "same turn"),
    (1, 2, "user", "same turn"),
    (1, 2, "assistant", "same turn"),
    (40, 0, "user", "head"),
    (41, None, "user", "own"),
    (60, 0, "user", "word " * 50_000),
    (61, 0, "user", "word " * 50_000),
]


@pytest.mark.parametrize("limit", [trie.BROADCAST, -1])
def test_against_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(trie, "BROADCAST", limit)  # the skeleton is broadcast, or joined to the shards
    monkeypatch.setattr(trie, "PIECE", 7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(spark, rows() + ODD) == brute(rows() + ODD)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_shards_share_copies(spark, monkeypatch):
    """A group of copies is cut into several shards and still is one node."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    table = [(c, t, "user", f"copy {t}") for c in range(1001, 1400) for t in range(3)]
    try:
        talks = trie.turns(spark.createDataFrame([(*r, "x", b"y", 1) for r in table], SCHEMA))
        paths = talks.selectExpr("conv_id", "turns.step as path").repartitionByRange("path", "conv_id")
        assert paths.selectExpr("spark_partition_id() as p").distinct().count() > 1
        assert found(spark, table) == brute(table)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 0, "user", "x")]) == []

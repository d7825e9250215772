from __future__ import annotations

import random

import xxhash

from lotewise.llm import simhash
from lotewise.llm.components import connected_components
from tests.llm.helpers import ODD, documents, prose


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lowered) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    bits = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (bits[i] ^ bits[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        if doc is not None:
            least[r] = min(least.get(r, doc), doc)
    return sorted(((d, f"{b:016x}", least.get(find(i))) for i, ((d, _), b) in enumerate(zip(rows, bits))), key=repr)


def test_every_pair_within_the_radius_shares_a_table():
    masks = simhash.masks()
    assert len(masks) == 31
    rng = random.Random(1)
    for _ in range(20_000):
        differing = sum(1 << i for i in rng.sample(range(64), simhash.RADIUS))
        assert any(m & differing == 0 for m in masks)


def rows():
    base = [(100 + i, prose(i, 400)) for i in range(12)]
    near = [(200 + i, t.replace("river", "stream", 1)) for i, (_, t) in enumerate(base[:6])]
    return base + near + [(300, base[0][1]), (301, base[0][1].upper())] + ODD


def test_against_brute_force(spark, rows=rows()):
    got = simhash.near_duplicates(documents(spark, rows))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_components(rows)


def test_crowded_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 2)
    rng = random.Random(3)
    bits = [sum(1 << i for i in rng.sample(range(6), rng.randint(0, 6))) for _ in range(60)]
    distinct = sorted(set(bits))
    edges = simhash.links(spark.createDataFrame([(b,) for b in distinct], "bits long"))
    found = {r.node: r.component for r in connected_components(edges).collect()}
    assert found == dict.fromkeys(distinct, 0)


def test_one_of_each_group_stays(spark):
    table = rows()
    docs = documents(spark, table)
    kept = [tuple(r)[:2] for r in simhash.drop_near_duplicates(docs).collect()]
    groups = {c for _, _, c in brute_components(table)}
    # two groups have the id 4
    assert len([r for r in kept if r[0] is not None]) == len(groups - {None}) + 1
    assert simhash.drop_near_duplicates(docs).columns == docs.columns
    assert (300, table[0][1]) not in kept and (100, table[0][1]) in kept
    assert kept.count((4, "twice")) == 1
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    assert simhash.drop_near_duplicates(documents(spark, [])).count() == 0


def test_components(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(200, 230)]
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        if find(a) != find(b):
            root[max(find(a), find(b))] = min(find(a), find(b))
    want = {n: find(n) for a, b in edges if a != b for n in (a, b)}
    got = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from lotewise.llm import packing
from tests.llm.helpers import ODD, documents, prose

SPECIAL = [(50, "before <|endoftext|> after"), (51, "数学 и кириллица"), (52, "a\x85b\x1cc"), (53, "naïve “quotes” — €5")]


def test_pieces_are_packed_whole(spark):
    table = ODD + SPECIAL + [(100 + i, prose(i, 40 * i)) for i in range(60)]
    got = packing.pack(documents(spark, table), with_ids=True).collect()
    exact = Tokenizer.from_file(packing.default_tokenizer())
    want = defaultdict(list)
    for doc, text in table:
        want[doc].append([*exact.encode(text or "", add_special_tokens=False).ids, 1])
    by_start = defaultdict(list)
    for r in got:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
        assert r.length == len(r.ids) <= 2048
        by_start[r.doc_id].append((r.start, r.ids, r.doc_tokens))
    for doc, texts in want.items():
        assert sum(len(p) for _, p, _ in by_start[doc]) == sum(map(len, texts))
        if len(texts) == 1:
            assert [t for _, p, _ in sorted(by_start[doc]) for t in p] == texts[0]
            assert {n for _, _, n in by_start[doc]} == {len(texts[0])}
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for inside in sequences.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= 2048
    used = sum(r.length for r in got)
    assert used / (2048 * len(sequences)) > 0.9
    assert packing.pack(documents(spark, [])).count() == 0


def test_shortest_pack_first():
    packed = packing.patterns({5: 2, 3: 3, 2: 2, 1: 4}, 8)
    used = defaultdict(int)
    for packs, inside in packed:
        assert sum(inside) <= 8
        for size in inside:
            used[size] += packs
    assert dict(used) == {5: 2, 3: 3, 2: 2, 1: 4}
    assert packing.patterns({}, 8) == []
    big = packing.patterns({i: 10_000_000_000 + i for i in range(1, 2049)})
    assert len(big) <= 2 * 2048
    table = packing.slots(packed)
    assert [tuple(r) for r in table] == sorted(tuple(r) for r in table)


def test_a_hot_length_is_numbered_without_gaps(spark):
    docs = documents(spark, [(i, "same text") for i in range(500)])
    got = packing.pack(docs)
    places = {(r.sequence_id, r.offset) for r in got.collect()}
    assert len(places) == 500

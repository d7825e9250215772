"""Sequence packing: shortest-pack-first over the histogram of piece lengths.

Documents are tokenised and cut into pieces of at most `LENGTH` tokens. Only the number of
pieces of each length goes to the driver (`LENGTH` counts at most). There lengths are
placed longest first, each into the packs that are shortest so far, many packs at a time,
which gives packing patterns and how often each is used. Pieces of a length are numbered,
and a piece finds its pattern, sequence and offset by its number.

Numbering is split by hash: a length that a third of all pieces have is numbered in about
sqrt(n) parts, shifted by the counts of the parts before. The pieces are written to the
shared folder before they are counted, so a lost executor cannot change the numbers.

Nulls: a null text is empty, an empty document is the end token alone, a null doc_id is
kept. Repeated rows are packed as often as they come. Further columns are left alone. No
documents give no rows. A text of any length is tokenised whole by one task.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lotewise.operators.joins import many_to_one
from lotewise.session import keep

LENGTH = 2048
END = 1


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Tokens:
    """Ids of a byte-level BPE file of the `tokenizers` library.

    The same merges run faster as ranks; that way is taken for texts of Latin letters and
    common signs, where both libraries split alike. Other texts, and those that hold the
    string of a special token, go through `tokenizers` itself.
    """

    _plain = re.compile("[^\t\n\r\x20-\x7e\xa0-ɏ‐-‧€]")

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in shown} | {
            chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)
        }
        ranks = {
            bytes(byte[c] for c in piece): rank
            for piece, rank in self.exact.get_vocab(with_added_tokens=False).items()
            if piece not in self.special
        }
        self.fast = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def __call__(self, text: str) -> list[int]:
        if not self._plain.search(text) and not any(s in text for s in self.special):
            return self.fast.encode_ordinary(text)
        return self.exact.encode(text, add_special_tokens=False).ids


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens) and, if asked for, `ids`."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(tokenizer)
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*tokens(text.as_py() or ""), END], dtype="<u4")
                for at in range(0, len(ids), length):
                    part = ids[at : at + length]
                    extra = (part.astype(np.int32),) if with_ids else ()
                    rows.append((doc, at, len(part), zlib.crc32(part.tobytes()), len(ids), *extra))
            kinds = [pa.int64()] * 5 + [pa.list_(pa.int32())] * with_ids
            columns = zip(*rows) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    schema = ", ".join(f"{n} {'array<int>' if n == 'ids' else 'long'}" for n in names)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


def patterns(histogram: dict[int, int], length: int = LENGTH) -> list[tuple[int, list[int]]]:
    """(times used, lengths in order), packing every piece of the histogram.

    Each step either uses up a length or moves a whole group of equal packs, so there are
    at most two groups for each length, however many pieces there are."""
    open_packs: list[tuple[int, int, int, list[int]]] = []  # fill, tie-break, packs, lengths
    ticket = 0
    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            fill, _, packs, inside = open_packs[0] if open_packs else (length, 0, 0, [])
            if fill + size > length:
                fill, packs, inside = 0, left, []
            else:
                heapq.heappop(open_packs)
            used = min(packs, left)
            if packs > used:
                ticket += 1
                heapq.heappush(open_packs, (fill, ticket, packs - used, inside))
            ticket += 1
            heapq.heappush(open_packs, (fill + size, ticket, used, [*inside, size]))
            left -= used
    return [(packs, inside) for _, _, packs, inside in sorted(open_packs)]


def slots(packed: list[tuple[int, list[int]]]) -> np.ndarray:
    """Rows (length, first number, packs, first sequence, offset), sorted by the first two.

    The n-th piece of a length belongs to the last row that starts at n or before: it goes
    to sequence (n - first) mod packs, behind (n - first) div packs pieces of its length."""
    rows, taken, sequence = [], {}, 0
    for packs, inside in packed:
        offset = 0
        for size, run in groupby(inside):
            times = len(list(run))
            first = taken.get(size, 0)
            rows.append((size, first, packs, sequence, offset))
            taken[size] = first + packs * times
            offset += size * times
        sequence += packs
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def numbered(cut: DataFrame) -> DataFrame:
    """Adds `number`, gapless from 0 for each length."""
    parts = max(1, math.isqrt(cut.count()))
    split = cut.withColumn("part", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(parts)))
    counts = split.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    shift = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    inside = W.partitionBy("length", "part").orderBy("doc_id", "start", "ids_crc32")
    ranked = split.withColumn("rank", F.row_number().over(inside))
    return many_to_one(ranked, shift, ["length", "part"]).withColumn("number", F.col("shift") + F.col("rank") - 1)


def pack(
    docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, with_ids: bool = False
) -> DataFrame:
    """The pieces of `docs` with `sequence_id` and `offset`; with `ids` if asked for."""
    cut = keep(pieces(docs, tokenizer or default_tokenizer(), length, with_ids), "pieces")
    histogram = {r.length: r.n for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = slots(patterns(histogram, length))

    def place(sizes: pa.Array, numbers: pa.Array) -> pa.Array:
        size, number = (x.to_numpy(zero_copy_only=False) for x in (sizes, numbers))
        wide = np.int64(1) << 50
        row = table[np.searchsorted(table[:, 0] * wide + table[:, 1], size * wide + number, side="right") - 1]
        inner = number - row[:, 1]
        sequence = row[:, 3] + inner % row[:, 2]
        offset = row[:, 4] + inner // row[:, 2] * size
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], names=["sequence_id", "offset"])

    kind = StructType([StructField("sequence_id", LongType()), StructField("offset", LongType())])
    placed = numbered(cut).withColumn("place", F.arrow_udf(place, kind)("length", "number"))
    return placed.select(*cut.columns, "place.sequence_id", "place.offset")

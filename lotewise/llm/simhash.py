"""SimHash near-duplicates, found by covering locality-sensitive hashing.

Fingerprints have 64 bits and link at `RADIUS` or fewer differing bits. Each bit position
gets a vector of RADIUS + 1 bits, and each non-zero vector v of that length gives one
table whose mask holds the positions that are not orthogonal to v. The vectors of up to RADIUS
differing positions never span the whole space, so some v is orthogonal to all of them:
its mask hides every difference and the pair shares a bucket there. No pair within the
radius is missed, whatever the data.

Nulls: a null text has no words; texts without words share fingerprint zero and link
like any other. A null doc_id takes part, and names a group only if the group has no
other id. Repeated rows share a fingerprint. Further columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from lotewise.llm.common import keep_one, text_key
from lotewise.llm.components import connected_components
from lotewise.operators.joins import many_to_one
from lotewise.session import keep

RADIUS = 4
SHINGLE = 4
#: Fingerprints of one bucket that are compared in one go; larger buckets are cut into
#: blocks of about this size, and every block meets every other.
BLOCK = 1024


def masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """The 2^(radius+1) - 1 masks. Position i has vector 1 + i mod (2^(radius+1) - 1), so
    that the vectors are spread evenly and each mask keeps about half of the positions."""
    size = (1 << (radius + 1)) - 1
    vectors = [1 + i % size for i in range(bits)]
    return [
        sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, size + 1)
    ]


def text_fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text, unsigned."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    first = max(len(words) - shingle + 1, 1)
    starts = np.concatenate(([0], ends[:-1] + 1))[:first].tolist()
    stops = ends[-first:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, stops)], dtype="<u8")
    return _majority(hashes)


def _majority(hashes: np.ndarray) -> int:
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):  # long texts: the bits of a slice at a time
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes(), "little")


def _fingerprints(texts: pa.Array) -> pa.Array:
    found = np.fromiter((text_fingerprint(t.as_py()) for t in texts), np.uint64, len(texts))
    return pa.array(found.view(np.int64))


def fingerprint(text: Column) -> Column:
    """The 64 bits as a long."""
    return F.arrow_udf(_fingerprints, LongType())(text)


def as_hex(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def links(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) that connect what is linked among the distinct fingerprints `bits`.

    Every pair within the radius is compared, but a bucket hands out one edge at most for
    each of its fingerprints: the one to the smallest it is connected with there.
    """
    cut = F.explode(F.array(*(F.struct(F.lit(t).alias("t"), F.lit(_signed(m)).alias("m")) for t, m in enumerate(masks()))))
    probes = distinct.select("bits", cut.alias("c")).select(
        "bits", F.col("c.t").cast("short").alias("t"), F.col("bits").bitwiseAND(F.col("c.m")).alias("rest")
    )
    crowded = probes.groupBy("t", "rest").agg(F.count(F.lit(1)).alias("n")).filter(f"n > {2 * BLOCK}")
    parts = F.coalesce(F.ceil(F.col("n") / BLOCK), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("bits"), "parts").cast("int")
    blocks = (
        many_to_one(probes, crowded, ["t", "rest"], "left")
        .withColumn("parts", parts)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("bits", "t", "rest", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )
    key = ["t", "rest", "i", "j"]
    return (
        blocks.repartition(*key)
        .sortWithinPartitions(*key, "bits")
        .mapInArrow(_connect, "a long, b long")
        .distinct()
    )


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket; the last bucket of a batch waits for the next batch."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(5)]
        if held is not None:
            now = [np.concatenate(x) for x in zip(held, now)]
        starts = _starts(now)
        whole = starts[-1]
        held = [x[whole:] for x in now]
        if whole:
            yield _edges(now[0][:whole], starts[:-1])
    if held is not None:
        yield _edges(held[0], _starts(held))


def _starts(columns: list[np.ndarray]) -> np.ndarray:
    change = np.zeros(len(columns[0]), bool)
    change[0] = True
    for c in columns[1:]:
        change[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(change)


def _edges(bits: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    x = bits.view(np.uint64)
    last = np.repeat(np.append(starts[1:], len(x)), np.diff(np.append(starts, len(x)))) - 1
    left, right = [], []
    alive = np.arange(len(x))
    shift = 0
    while True:
        shift += 1
        alive = alive[alive + shift <= last[alive]]
        if not len(alive):
            break
        near = alive[np.bitwise_count(x[alive] ^ x[alive + shift]) <= RADIUS]
        left.append(near)
        right.append(near + shift)
    label = np.arange(len(x))
    if left:
        i, j = np.concatenate(left), np.concatenate(right)
        while True:
            low = np.minimum(label[i], label[j])
            before = label.copy()
            np.minimum.at(label, i, low)
            np.minimum.at(label, j, low)
            label = label[label]
            if (label == before).all():
                break
    tied = np.flatnonzero(label != np.arange(len(x)))
    return pa.RecordBatch.from_arrays([pa.array(bits[label[tied]]), pa.array(bits[tied])], names=["a", "b"])


def groups(marked: DataFrame) -> DataFrame:
    """(bits, component) for the fingerprints of `marked` (doc_id, bits) that have links,
    component being a fingerprint; those without links are left out."""
    return connected_components(links(marked.select("bits").distinct())).withColumnRenamed("node", "bits")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row; component_id is the smallest
    doc_id reachable by links. No documents give no rows."""
    marked = keep(docs.select("doc_id", fingerprint(F.col("text")).alias("bits")), "simhash")
    least = marked.groupBy("bits").agg(F.min("doc_id").alias("least"))
    named = many_to_one(least, groups(marked), ["bits"], "left").withColumn(
        "root", F.coalesce("component", "bits")
    )
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_bits = many_to_one(named, ids, ["root"]).select("bits", "component_id")
    return many_to_one(marked, of_bits, ["bits"]).select(
        "doc_id", as_hex(F.col("bits")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of `docs` with one of each group: the one with the smallest doc_id, and of
    several with that id the one whose text hashes lowest. Ids that are null come last."""
    marked = keep(
        docs.select("doc_id", text_key(F.col("text")).alias("key"), fingerprint(F.col("text")).alias("bits")), "simhash"
    )
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    rows = marked.groupBy("bits", "doc_id", "key").agg(F.count(F.lit(1)).alias("copies"))
    best = rows.groupBy("bits").agg(F.min_by(F.struct("doc_id", "key", "copies"), rank).alias("best"))
    named = many_to_one(best, groups(marked), ["bits"], "left").withColumn("root", F.coalesce("component", "bits"))
    rank = F.struct(F.col("best.doc_id").isNull(), "best.doc_id", "best.key")
    winners = named.groupBy("root").agg(F.min_by("best", rank).alias("best")).select(
        F.col("best.doc_id").alias("w_id"), F.col("best.key").alias("w_key"), F.col("best.copies").alias("w_copies")
    )
    return keep_one(docs, winners)

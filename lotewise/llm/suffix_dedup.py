"""Exact repeats of 50 bytes, by suffix arrays with difference covers.

A byte goes if a 50-byte string that covers it also starts in a document with a smaller doc_id.
Suffixes are sorted only where a repeat can be, and in shards that equal strings share:

Texts that are wholly equal are known by their SHA-256: all but the smallest document go whole, and only
that one is looked at further.

1. `anchors`: every 50-byte window has an anchor, its 24-byte string of least hash. Equal windows have
   equal anchors, so the text falls into pieces, runs of windows with one anchor; pieces whose
   anchor hash stands in one document alone can't hold a repeat and go no further.
2. `recurring`: hashes are shuffled as sorted blocks of six bytes each; a bit for each goes back.
3. `pieces`: pieces that are left go to the shard of their anchor, equal ones of a bucket once, with
   the smallest document. An anchor of more than `HOT` pieces is split: its windows go to the
   shards of their own hashes, so a passage in a third of all texts is spread, however it goes on.
4. `repeats`: in each shard the suffix array of the pieces is built by difference cover: triples at
   places 1 and 2 mod 3 are sorted and named, names are sorted again by recursion until they
   reach over 50 bytes, the remaining suffixes are merged by their first byte and the rank
   behind it, and neighbours in the order are compared by their first 50 bytes.
5. Spans go back to the documents' buckets.

The texts are shuffled once, by a hash of document and text, and that exchange serves steps 1, 3 and
5. Within a bucket a text goes by document and SHA-256, so nothing depends on the order of rows. Work on
a bucket goes slice by slice, so memory follows the largest text, not its repeats.

Null text counts as empty. A null doc_id is smaller than none and none is smaller than it: nothing goes
from such a row and it takes nothing from others. Rows with one doc_id are judged alike, each on
its own text, and never take from each other; a row that stands twice gives two rows. Further columns
are left alone; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotewise.operators.joins import many_to_one

LENGTH = 50
GRAM = 24
#: Bytes of text in a bucket, hashes in a shard of step 2, bytes of all texts for each shard of step 4.
BUCKET, PRINTS, SHARD = 2 << 20, 1 << 21, 2 << 20
#: Windows that are hashed at once, and piece bytes that are compared at once.
SLICE, GATHERED = 1 << 18, 1 << 23
#: Pieces of one anchor, counted up to 127 in each bucket, beyond which its windows go apart.
HOT = 4096
# Odd multipliers of the hash: any will do.
FACTORS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93]


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number."""
    return np.ndarray(max(len(text) - 7, 0), "<u8", np.ascontiguousarray(text).data, strides=(1,)) if len(text) > 7 else np.zeros(0, "<u8")


def _mixed(parts: list[np.ndarray]) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = parts[0] * np.uint64(FACTORS[0])
        for part, factor in zip(parts[1:], FACTORS[1:] * len(parts)):
            h = (h ^ (h >> np.uint64(29))) * np.uint64(FACTORS[0]) + part * np.uint64(factor)
        h ^= h >> np.uint64(32)
        h *= np.uint64(FACTORS[3])
        return h ^ (h >> np.uint64(29))


def _anchored(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, count, print) of the pieces of joined texts that end at `ends`: the first
    window, the number of windows, 48 bits of the anchor's hash."""
    reach = LENGTH - GRAM + 1
    low = np.uint64((1 << 20) - 1)  # places within a slice
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for lo in range(0, len(text) - LENGTH + 1, SLICE):
        part = text[lo : lo + SLICE + LENGTH - 1]
        words = _words(part)
        grams = len(part) - GRAM + 1
        prints = _mixed([words[o : o + grams] for o in range(0, GRAM, 8)])
        least = (prints & ~low) | np.arange(grams, dtype=np.uint64)
        size = 1
        while 2 * size <= reach:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        least = np.minimum(least[: len(least) - (reach - size)], least[reach - size :])
        anchor = (least & low).astype(np.int64)
        inside = np.ones(len(anchor), bool)
        near = ends[np.searchsorted(ends, lo, "right") : np.searchsorted(ends, lo + len(part), "right")] - lo
        late = (near[:, None] - np.arange(1, LENGTH)).ravel()
        inside[late[(late >= 0) & (late < len(anchor))]] = False
        at = np.flatnonzero(inside)
        if not len(at):
            continue
        new = np.append(True, (np.diff(at) > 1) | (np.diff(anchor[at]) != 0))
        first = at[new]
        found.append((first + lo, np.diff(np.append(np.flatnonzero(new), len(at))), prints[anchor[first]] >> np.uint64(16)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _keys(table: pa.Table) -> list[tuple[int, bytes]]:
    """What tells the texts of a bucket apart: document and SHA-256; rows equal in both are one text."""
    return [(d, hashlib.sha256(b).digest()) for d, b in zip(table["doc_id"].to_pylist(), table["body"].to_pylist())]


def _copied(table: pa.Table) -> set[tuple[int, bytes]]:
    told = table.filter(pc.is_valid(table["copy"]))
    return set(zip(told["copy_of"].to_pylist(), told["copy"].to_pylist()))


def _known(table: pa.Table, copies: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts of a bucket that are looked at, in the order of their keys: joined bytes, where each
    text ends, documents. The copies of a smaller document's text are not among them."""
    bodies = dict(zip(_keys(table), table["body"].to_pylist()))
    kept = sorted(bodies.keys() - _copied(copies))
    text = np.frombuffer(b"".join(bodies[k] for k in kept), np.uint8)
    ends = np.cumsum([len(bodies[k]) for k in kept], dtype=np.int64)
    return text, ends, np.array([d for d, _ in kept], np.int64)


def _cut(values: np.ndarray, cuts: np.ndarray) -> list[bytes]:
    return [values[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]


def _by_shard(shard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shards that occur in sorted `shard` and the places where their rows begin and end."""
    cuts = np.append(np.flatnonzero(np.append(True, shard[1:] != shard[:-1])[: len(shard)]), len(shard))
    return shard[cuts[:-1]], cuts


def _distinct(prints: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct prints in order of shard and print, their shards, and the place of each piece's."""
    values, back = np.unique(prints, return_inverse=True)
    order = np.argsort(values % np.uint64(shards), kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return values[order], (values[order] % np.uint64(shards)).astype(np.int64), place[back]


def _anchors(shards: int):
    def run(table: pa.Table, copies: pa.Table) -> pa.Table:
        text, ends, ids = _known(table, copies)
        first, _, prints = _anchored(text, ends)
        values, shard, place = _distinct(prints, shards)
        docs = ids[np.searchsorted(ends, first, "right")] if len(first) else first
        low, high = np.full(len(values), np.iinfo(np.int64).max), np.full(len(values), np.iinfo(np.int64).min)
        np.minimum.at(low, place, docs)
        np.maximum.at(high, place, docs)
        count = np.minimum(np.bincount(place, minlength=len(values)), 127) | np.where(low < high, 128, 0)
        own, cuts = _by_shard(shard)
        return pa.table(
            {
                "shard": pa.array(own, pa.int64()),
                "bucket": pa.array([table["bucket"][0].as_py()] * len(own), pa.int64()),
                "prints": pa.array(_cut(values.view(np.uint8).reshape(-1, 8)[:, :6], cuts), pa.binary()),
                "counts": pa.array(_cut(count.astype(np.uint8), cuts), pa.binary()),
            }
        )

    return run


def _recurring(table: pa.Table) -> pa.Table:
    """A bit for each print: whether it stands in two documents, whether it is hot."""
    parts = [np.frombuffer(b, np.uint8) for b in table["counts"].to_pylist()]
    count = np.concatenate(parts)
    values = np.zeros((len(count), 8), np.uint8)
    values[:, :6] = np.frombuffer(b"".join(table["prints"].to_pylist()), np.uint8).reshape(-1, 6)
    values = values.view(np.uint64).ravel()
    order = np.argsort(values, kind="stable")
    starts = np.flatnonzero(np.append(True, np.diff(values[order]) != 0))
    sizes = np.diff(np.append(starts, len(order)))
    again = (sizes > 1) | (np.maximum.reduceat(count[order], starts) > 127)
    hot = np.add.reduceat((count[order] & 127).astype(np.int64), starts) > HOT
    bits = np.zeros((2, len(order)), bool)
    bits[:, order] = np.repeat(np.stack([again, hot]), sizes, axis=1)
    cuts = np.cumsum([0, *map(len, parts)])
    return pa.table(
        {
            "bucket": table["bucket"],
            "shard": table["shard"],
            "again": pa.array([np.packbits(bits[0, a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
            "hot": pa.array([np.packbits(bits[1, a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
        }
    )


def _chunks(sizes: np.ndarray) -> Iterator[slice]:
    """Slices of pieces of about `GATHERED` bytes."""
    total = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        upto = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + GATHERED, "right")))
        yield slice(at, upto)
        at = upto


PIECES = (
    "shard long, bucket long, body binary, sizes binary, docs binary, "
    "of binary, place binary, row binary, done_row binary, done_from binary, done_to binary"
)


def _pieces(print_shards: int, shards: int):
    """Pieces that may repeat, to the shards; what repeats inside the bucket is known here."""
    names = [c.split()[0] for c in PIECES.split(", ")]

    def run(table: pa.Table, states: pa.Table) -> pa.Table:
        bucket, (text, ends, ids) = table["bucket"][0].as_py(), _known(table, states)
        first, count, prints = _anchored(text, ends)
        values, shard, place = _distinct(prints, print_shards)
        bits = np.zeros((2, len(values)), bool)
        own, cuts = _by_shard(shard)
        at = {int(s): (a, b) for s, a, b in zip(own, cuts[:-1], cuts[1:])}
        states = states.filter(pc.is_null(states["copy"]))
        for s, again, hot in zip(*(states[c].to_pylist() for c in ("shard", "again", "hot"))):
            a, b = at[s]
            for bit, packed in zip(bits, (again, hot)):
                bit[a:b] = np.unpackbits(np.frombuffer(packed, np.uint8), count=b - a)
        again, hot = bits[0, place], bits[1, place]
        cool = again & ~hot
        # a hot piece is cut into its windows
        apart = first[again & hot]
        widths = count[again & hot]
        inner = np.repeat(apart - np.append(0, np.cumsum(widths)[:-1]), widths) + np.arange(widths.sum())
        key = prints[cool] % np.uint64(shards)
        if len(inner):
            words = _words(text)
            spans = [inner + o for o in (0, 8, 16, 24, 32, 40, LENGTH - 8)]
            key = np.concatenate([key, _mixed([words[s] for s in spans]) % np.uint64(shards)])
        first, size = np.concatenate([first[cool], inner]), np.concatenate([count[cool] + LENGTH - 1, np.full(len(inner), LENGTH)])
        out: list[dict] = []
        for chunk in _chunks(size):
            f, n, k = first[chunk], size[chunk], key[chunk].astype(np.int64)
            bounds = np.append(0, np.cumsum(n))
            flat = text[np.repeat(f - bounds[:-1], n) + np.arange(bounds[-1])]
            strings = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(flat)])
            coded = strings.dictionary_encode()
            of, bodies = coded.indices.to_numpy().astype(np.int64), coded.dictionary
            doc_at = np.searchsorted(ends, f, "right")
            doc, row, place = ids[doc_at], doc_at, f - np.append(0, ends)[doc_at]
            least = np.full(len(bodies), np.iinfo(np.int64).max)
            np.minimum.at(least, of, doc)
            home = np.empty(len(bodies), np.int64)
            home[of] = k
            later = doc > least[of]
            order = np.argsort(home, kind="stable")  # strings by shard
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            own, cuts = _by_shard(home[order])
            lengths = np.diff(np.frombuffer(bodies.buffers()[1], np.int32)[: len(bodies) + 1])
            bodies = bodies.take(pa.array(order)).to_pylist()
            keep = np.flatnonzero(~later)[np.argsort(rank[of[~later]], kind="stable")]
            gone = np.flatnonzero(later)[np.argsort(rank[of[later]], kind="stable")]
            keep_cuts = np.searchsorted(rank[of[keep]], cuts)
            gone_cuts = np.searchsorted(rank[of[gone]], cuts)
            for i, s in enumerate(own):
                a, b = cuts[i], cuts[i + 1]
                here, done = keep[keep_cuts[i] : keep_cuts[i + 1]], gone[gone_cuts[i] : gone_cuts[i + 1]]
                out.append(
                    dict(
                        shard=int(s), bucket=bucket, body=b"".join(bodies[a:b]),
                        sizes=lengths[order[a:b]].astype(np.int32).tobytes(), docs=least[order[a:b]].tobytes(),
                        of=(rank[of[here]] - a).astype(np.int32).tobytes(), place=place[here].tobytes(), row=row[here].tobytes(),
                        done_row=row[done].tobytes(), done_from=place[done].tobytes(), done_to=(place[done] + n[done]).tobytes(),
                    )
                )
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * (len(names) - 2)]
        return pa.table({c: pa.array([r[c] for r in out], kind) for c, kind in zip(names, kinds)})

    return run


def _packed(*columns: np.ndarray) -> np.ndarray:
    """Numbers in the order of the columns, first one first."""
    key, top = columns[0], int(columns[0].max(initial=0)) + 1
    for column in columns[1:]:
        size = int(column.max(initial=0)) + 1
        if top * size >= 1 << 63:
            key = np.unique(key, return_inverse=True)[1]
            top = int(key.max(initial=0)) + 1
        key, top = key * size + column, top * size
    return key


def _merged(keys: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the first `m` keys and the others, merged in one order: how many of the first are less
    than each of the first and of the others, and how many of the others than each of the first."""
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    first = np.append(0, np.cumsum(order < m))[starts]
    times = np.diff(np.append(starts, len(keys)))
    less = np.empty((2, len(keys)), np.int64)
    less[0, order] = np.repeat(first, times)
    less[1, order] = np.repeat(starts - first, times)
    return less[0, :m], less[0, m:], less[1, :m]


def ranks(symbols: np.ndarray, need: int) -> np.ndarray:
    """A rank for each suffix of `symbols` (from 1 on), in order of at least the first `need` of them.

    Suffixes that share the first `need` symbols stand together, in any order."""
    n = len(symbols)
    padded = np.append(symbols, np.zeros(4, np.int64))
    extra = n % 3 == 1  # an empty triple after the ones, so that no name reads on into the twos
    ones, twos, rest = np.arange(1, n, 3), np.arange(2, n, 3), np.arange(0, n, 3)
    sample = np.concatenate([ones, [n] if extra else [], twos]).astype(np.int64)
    triples, name, times = np.unique(
        _packed(padded[sample], padded[sample + 1], padded[sample + 2]), return_inverse=True, return_counts=True
    )
    less = (np.cumsum(times) - times)[name]
    if need > 3 and len(triples) < len(sample):
        name = less = ranks(name + 1, -(-need // 3))
    rank = np.zeros(n + 4, np.int64)
    rank[sample] = name + 1
    before = np.zeros(n + 4, np.int64)
    before[sample] = less - extra  # the empty triple is the least and no suffix
    out = np.empty(n, np.int64)
    both = np.append(rest, ones)
    own, ones_less, rest_less = _merged(_packed(padded[both], rank[both + 1]), len(rest))
    out[rest], out[ones] = own + rest_less, before[ones] + ones_less
    both = np.append(rest, twos)
    _, twos_less, rest_less = _merged(_packed(padded[both], padded[both + 1], rank[both + 2]), len(rest))
    out[rest] += rest_less
    out[twos] = before[twos] + twos_less
    return out


def _later(text: np.ndarray, sizes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, from, to): the runs of bytes in joined pieces that also stand in a smaller document's piece."""
    begin = np.append(0, np.cumsum(sizes)[:-1])
    widths = sizes - LENGTH + 1
    piece = np.repeat(np.arange(len(sizes)), widths)
    start = np.arange(len(piece)) + np.repeat(begin - np.append(0, np.cumsum(widths)[:-1]), widths)
    order = np.argsort(ranks(text.astype(np.int64) + 1, LENGTH)[start])
    sorted_start, words = start[order], _words(text)
    same = np.ones(len(order), bool)
    same[0] = False
    for o in (*range(0, LENGTH - 7, 8), LENGTH - 8):
        w = words[sorted_start + o]
        same[1:] &= w[1:] == w[:-1]
    groups = np.flatnonzero(~same)
    doc = docs[piece]
    least = np.minimum.reduceat(doc[order], groups)
    gone = np.empty(len(order), bool)
    gone[order] = doc[order] > np.repeat(least, np.diff(np.append(groups, len(order))))
    at = np.flatnonzero(gone)
    new = np.append(True, (np.diff(at) > 1) | (np.diff(piece[at]) != 0))[: len(at)]
    first = at[new]
    count = np.diff(np.append(np.flatnonzero(new), len(at)))
    lo = start[first] - begin[piece[first]]
    return piece[first], lo, lo + count + LENGTH - 1


def _numbers(column: pa.ChunkedArray, kind=np.int64) -> list[np.ndarray]:
    return [np.frombuffer(b, kind) for b in column.to_pylist()]


SPANS = "bucket long, row binary, begins binary, ends binary"


def _repeats(table: pa.Table) -> pa.Table:
    """The suffixes of a shard's pieces in order, and the spans that go, for each bucket."""
    sizes, docs = _numbers(table["sizes"], np.int32), np.concatenate(_numbers(table["docs"]))
    bounds = np.append(0, np.cumsum(np.concatenate(sizes), dtype=np.int64)).astype(np.int32)
    text = pa.py_buffer(b"".join(table["body"].to_pylist()))
    coded = pa.Array.from_buffers(pa.binary(), len(docs), [None, pa.py_buffer(bounds), text]).dictionary_encode()
    code = coded.indices.to_numpy()
    least = np.full(len(coded.dictionary), np.iinfo(np.int64).max)
    np.minimum.at(least, code, docs)
    ends = np.frombuffer(coded.dictionary.buffers()[1], np.int32)[: len(least) + 1]
    distinct = np.frombuffer(coded.dictionary.buffers()[2], np.uint8)[: ends[-1]]
    piece, lo, hi = _later(distinct, np.diff(ends).astype(np.int64), least)
    shift, out = 0, {"row": [], "begins": [], "ends": []}
    known = (_numbers(table[c]) for c in ("place", "row", "done_row", "done_from", "done_to"))
    for n, of, place, row, *done in zip(map(len, sizes), _numbers(table["of"], np.int32), *known):
        own = code[of + shift]
        whole = docs[of + shift] > least[own]  # the same piece stands in a smaller document
        done[0], done[1] = np.append(done[0], row[whole]), np.append(done[1], place[whole])
        done[2] = np.append(done[2], place[whole] + (ends[own + 1] - ends[own])[whole])
        own, place, row = own[~whole], place[~whole], row[~whole]
        a, b = np.searchsorted(piece, own, "left"), np.searchsorted(piece, own, "right")
        times = b - a
        at = np.repeat(a - np.append(0, np.cumsum(times)[:-1]), times) + np.arange(times.sum())
        start = np.repeat(place, times)
        for name, old, new in zip(out, done, (np.repeat(row, times), start + lo[at], start + hi[at])):
            out[name].append(np.append(old, new).astype(np.int64).tobytes())
        shift += n
    return pa.table({"bucket": table["bucket"], **{k: pa.array(v, pa.binary()) for k, v in out.items()}})


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _rest(table: pa.Table, spans: pa.Table) -> pa.Table:
    """What is left of each text of a bucket."""
    keys, bodies, copied = _keys(table), table["body"].to_pylist(), _copied(spans)
    index = {key: i for i, key in enumerate(sorted(set(keys) - copied))}
    told = spans.filter(pc.is_null(spans["copy"]))
    row, begins, upto = (
        np.concatenate([np.zeros(0, np.int64), *_numbers(told[c])]) for c in ("row", "begins", "ends")
    )
    by = np.lexsort((begins, row))
    row, begins, upto = row[by], begins[by], upto[by]
    cuts = np.searchsorted(row, np.arange(len(index) + 1))
    out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
    for key, body in zip(keys, bodies):
        if key in copied:
            runs = [(0, len(body))] if len(body) >= LENGTH else []
        else:
            a, b = cuts[index[key]], cuts[index[key] + 1]
            lo, hi = begins[a:b], np.maximum.accumulate(upto[a:b])
            new = np.append(True, lo[1:] > hi[:-1])[: len(lo)]
            runs = list(zip(lo[new].tolist(), hi[np.append(new[1:], True)[: len(new)]].tolist()))
        sha, at = hashlib.sha256(), 0
        for lo, hi in runs:
            sha.update(body[at:lo])
            at = hi
        sha.update(body[at:])
        for name, value in zip(out, (len(body), sum(hi - lo for lo, hi in runs), len(runs), sha.hexdigest())):
            out[name].append(value)
    return pa.table({"doc_id": table["doc_id"], **out})


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for each row of `docs` (doc_id, text)."""
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("body")
    )
    size = docs.select(F.sum(F.octet_length("body"))).first()[0] or 0
    shards = size // SHARD + 1
    print_shards = 2 * size // ((LENGTH - GRAM + 2) * PRINTS) + 1  # two of so many windows begin a piece
    placed = docs.filter("doc_id is not null").withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "body"), F.lit(size // BUCKET + 1))
    )
    by_bucket, copies = placed.repartition("bucket").groupBy("bucket"), _copies(placed)
    prints = by_bucket.cogroup(copies.groupBy("bucket")).applyInArrow(
        _anchors(print_shards), "shard long, bucket long, prints binary, counts binary"
    )
    states = prints.groupBy("shard").applyInArrow(_recurring, "bucket long, shard long, again binary, hot binary")
    states = states.unionByName(copies, allowMissingColumns=True)
    dealt = by_bucket.cogroup(states.groupBy("bucket")).applyInArrow(_pieces(print_shards, shards), PIECES)
    spans = dealt.groupBy("shard").applyInArrow(_repeats, SPANS).unionByName(copies, allowMissingColumns=True)
    whole = docs.filter("doc_id is null").select(
        "doc_id", F.octet_length("body").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2("body", 256).alias("kept_sha256"),
    )
    return by_bucket.cogroup(spans.groupBy("bucket")).applyInArrow(_rest, RESULT).unionByName(whole)


def _copies(placed: DataFrame) -> DataFrame:
    """(bucket, copy_of, copy): texts, by document and SHA-256, that are wholly those of a smaller document."""
    sums = placed.select("bucket", "doc_id", F.unhex(F.sha2("body", 256)).alias("copy"))
    first = sums.groupBy("copy").agg(F.min("doc_id").alias("least"))
    later = many_to_one(sums, first, ["copy"]).filter("doc_id > least")
    return later.select(F.col("bucket").alias("home"), F.col("doc_id").alias("copy_of"), "copy").distinct().withColumnRenamed(
        "home", "bucket"
    )

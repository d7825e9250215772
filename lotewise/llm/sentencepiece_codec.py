"""SentencePiece encoding and decoding by batched Viterbi in numpy.

A text becomes pieces of a model file such that the sum of the pieces' scores is the
largest. A file of the BPE kind has only an order of pieces; the score of the n-th is then the
logarithm of its share under Zipf's law, 1 / n, so that fewer and commoner pieces win. No piece of the file reaches over the start of a word, so words are segmented
one by one, and each distinct word of a task once. Words of equal length advance
together: the hashes of all their substrings are differences of prefix hashes, a binary
search among the sorted keys of the pieces of that length tells which are pieces, and for
each end position the best of all starts is kept with a back-pointer. A character that is
no piece is spelled in bytes, which costs 10 more than the worst piece. Segmentations are
compared with the word they came from, so a clash of hashes cannot change a text.

A word of more than `LONG` characters, as in text without spaces, is cut first at every place that no
piece found in it reaches over, where the best path must pass; the parts then advance together like
words. A part that is still long is walked alone, from place to place over the pieces found there, block by block.

As in the library, a space goes before a text, spaces are written as U+2581, and decoding
takes the first space away again. That sign itself is written as its three bytes, so every text comes back
as it was (in the library it would come back as a space). The highest sum of scores is not what merging pairs
gives for a file of the BPE kind (README has how often the two agree).

Nulls: a null text has no ids (null) and decodes to null; an empty one has none (an empty list). Repeated
rows get equal results; further columns are left alone. A text is encoded whole by one task.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

SPACE = "▁"
#: Characters of the distinct words whose ids a task keeps.
KEPT = 1 << 23
#: Characters from which on a word is cut, and of a block of it in which pieces are looked up at once.
LONG, BLOCK = 256, 1 << 16
#: Characters of equally long words that are segmented at once.
CHUNK = 1 << 18

_WORDS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _prefixes(codes: np.ndarray) -> np.ndarray:
    """Prefix hashes of rows of code points, the empty prefix first."""
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
    for j in range(codes.shape[1]):
        out[:, j + 1] = out[:, j] * _BASE + codes[:, j] + np.uint64(1)
    return out


def _codes(words: list[str], size: int) -> np.ndarray:
    raw = "".join(words).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(raw, "<u4").reshape(len(words), size).astype(np.uint64)


def _long_prefixes(codes: np.ndarray) -> np.ndarray:
    """`_prefixes` of one long row, put together from blocks, whose hashes follow from each other."""
    width = 256
    rows = -(-len(codes) // width)
    padded = np.zeros(rows * width, np.uint64)
    padded[: len(codes)] = codes
    inner = _prefixes(padded.reshape(rows, width))
    powers = np.array([pow(int(_BASE), n, 1 << 64) for n in range(width + 1)], np.uint64)
    carry = np.zeros(rows + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(rows):
            carry[i + 1] = carry[i] * powers[width] + inner[i, width]
        joined = carry[:-1, None] * powers[None, 1:] + inner[:, 1:]
    return np.append(np.zeros(1, np.uint64), joined.ravel()[: len(codes)])


class Pieces:
    """The pieces of a model file, by length, with sorted keys."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        model = SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        plain = [i for i in every if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i))]
        self.text = {i: model.id_to_piece(i) for i in plain}
        self.byte = {int(model.id_to_piece(i)[3:5], 16): i for i in every if model.is_byte(i)}
        self.bytes_of = [b""] * len(every)
        for i, t in self.text.items():
            self.bytes_of[i] = t.replace(SPACE, " ").encode()
        for b, i in self.byte.items():
            self.bytes_of[i] = bytes([b])
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model.serialized_model_proto())
        score = {i: model.get_score(i) for i in plain}
        if proto.trainer_spec.model_type == proto.trainer_spec.BPE:
            ranked = sorted(plain, key=lambda i: (-score[i], i))
            total = math.log(sum(1 / n for n in range(1, len(ranked) + 1)))
            score = {i: -math.log(n) - total for n, i in enumerate(ranked, 1)}
        self.spelled = min(score.values()) - 10.0
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in sorted({len(t) for t in self.text.values()}):
            ids = np.array([i for i in plain if len(self.text[i]) == size])
            keys = _prefixes(_codes([self.text[i] for i in ids], size))[:, -1]
            order = np.argsort(keys)
            self.by_size[size] = (keys[order], ids[order], np.array([score[i] for i in ids])[order])

    def _hits(self, word: str, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, id, score) of the pieces that start from `low` to `high` in a word, by start, longest first."""
        most = max(self.by_size)
        part = word[low : high + most]
        prefix = _prefixes(_codes([part], len(part)))[0] if len(part) < LONG else _long_prefixes(_codes([part], len(part))[0])
        found = []
        for length, (keys, ids, scores) in self.by_size.items():
            if length > len(part):
                break
            power = np.uint64(pow(int(_BASE), length, 1 << 64))
            hashed = (prefix[length:] - prefix[:-length] * power)[: high - low]
            at = np.minimum(np.searchsorted(keys, hashed), len(keys) - 1)
            start = np.flatnonzero(keys[at] == hashed)
            found.append((start + low, np.full(len(start), length), ids[at[start]], scores[at[start]]))
        start, length, ids, scores = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((-length, start))
        return start[order], length[order], ids[order], scores[order]

    def segment_long(self, word: str) -> bytes:
        """The ids of one long word, cut where no piece reaches over."""
        over = np.zeros(len(word) + 1, np.int32)
        for low in range(0, len(word), BLOCK):
            start, length, _, _ = self._hits(word, low, min(low + BLOCK, len(word)))
            np.add.at(over, start[length > 1] + 1, 1)
            np.add.at(over, (start + length)[length > 1], -1)
        cuts = np.flatnonzero(np.cumsum(over)[1:-1] == 0) + 1
        bounds = [0, *cuts.tolist(), len(word)]
        parts = [word[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        by_size: dict[int, list[str]] = {}
        for part in set(parts):
            by_size.setdefault(len(part), []).append(part)
        known: dict[str, bytes] = {}
        for size, some in by_size.items():
            step = max(1, CHUNK // size)
            for at in range(0, len(some), step):
                chunk = some[at : at + step]
                known.update(zip(chunk, self.segment(chunk) if size <= LONG else map(self._walked, chunk)))
        return b"".join([known[part] for part in parts])

    def _walked(self, word: str) -> bytes:
        """The ids of one word in which pieces overlap everywhere."""
        best = array("d", [-math.inf]) * (len(word) + 1)
        back, piece = array("i", [1]) * (len(word) + 1), array("i", [-1]) * (len(word) + 1)
        best[0], at = 0.0, 0
        for low in range(0, len(word), BLOCK):
            high = min(low + BLOCK, len(word))
            for start, length, chosen, score in zip(*(x.tolist() for x in self._hits(word, low, high))):
                while at < start:  # a character that no piece starts at is spelled
                    if best[at] + self.spelled >= best[at + 1]:
                        best[at + 1], back[at + 1], piece[at + 1] = best[at] + self.spelled, 1, -1
                    at += 1
                if best[start] + score >= best[start + length]:
                    best[start + length], back[start + length], piece[start + length] = best[start] + score, length, chosen
        while at < len(word):
            if best[at] + self.spelled >= best[at + 1]:
                best[at + 1], back[at + 1], piece[at + 1] = best[at] + self.spelled, 1, -1
            at += 1
        pieces, ends, at = [], [], len(word)
        while at:
            pieces.append(piece[at])
            ends.append(at)
            at -= back[at]
        ids = self._with_bytes(word, pieces[::-1], ends[::-1])
        return ids if self._spells(ids, word) else self._bytes(word)

    def segment(self, words: list[str]) -> list[bytes]:
        """The ids of words of one length, each as packed 32-bit integers."""
        size = len(words[0])
        prefix = _prefixes(_codes(words, size))
        rows = np.arange(len(words))
        found = []
        for length, (keys, ids, scores) in self.by_size.items():
            if length > size:
                break
            power = np.uint64(pow(int(_BASE), length, 1 << 64))
            hashed = prefix[:, length:] - prefix[:, :-length] * power
            at = np.minimum(np.searchsorted(keys, hashed), len(keys) - 1)
            hit = keys[at] == hashed
            found.append((length, np.where(hit, scores[at], -np.inf), np.where(hit, ids[at], -1)))
        best = np.full((len(words), size + 1), -np.inf)
        best[:, 0] = 0.0
        back = np.ones((len(words), size + 1), np.int32)
        piece = np.full((len(words), size + 1), -1, np.int32)
        for end in range(1, size + 1):
            best[:, end] = best[:, end - 1] + self.spelled
            for length, scores, ids in found:
                if length > end:
                    break
                total = best[:, end - length] + scores[:, end - length]
                better = total > best[:, end]
                best[better, end] = total[better]
                back[better, end] = length
                piece[better, end] = ids[better, end - length]
        end, live, walked = np.full(len(words), size), rows, []
        while len(live):
            chosen = piece[live, end[live]]
            walked.append((live, chosen, end[live]))
            end[live] -= back[live, end[live]]
            live = live[end[live] > 0]
        owner, chosen, at = (np.concatenate(x[::-1]) for x in zip(*walked))
        order = np.argsort(owner, kind="stable")  # the walk went from the end to the start
        chosen, at = chosen[order].astype(np.int32), at[order]
        stops = np.cumsum(np.bincount(owner, minlength=len(words))).tolist()
        odd = set(owner[order][chosen < 0].tolist())
        raw, start, done = chosen.tobytes(), 0, []
        for row, (word, stop) in enumerate(zip(words, stops)):
            ids = raw[4 * start : 4 * stop]
            if row in odd:
                ids = self._with_bytes(word, chosen[start:stop].tolist(), at[start:stop].tolist())
            done.append(ids if self._spells(ids, word) else self._bytes(word))
            start = stop
        return done

    def _with_bytes(self, word: str, pieces: list[int], ends: list[int]) -> bytes:
        out: list[int] = []
        for p, e in zip(pieces, ends):
            out.extend([p] if p >= 0 else [self.byte[b] for b in word[e - 1].encode("utf-8", "replace")])
        return array("i", out).tobytes()

    def _spells(self, ids: bytes, word: str) -> bool:
        spelled = b"".join([self.bytes_of[i] for i in array("i", ids)])
        return spelled == word.replace(SPACE, " ").encode("utf-8", "replace")

    def _bytes(self, word: str) -> bytes:
        raw = word.replace(SPACE, " ").encode("utf-8", "replace")
        return array("i", [self.byte[b] for b in raw]).tobytes()

    def decode(self, ids: Iterable[int]) -> str:
        raw = b"".join([self.bytes_of[i] for i in ids])
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


class Encoder:
    def __init__(self, path: str) -> None:
        self.pieces = Pieces(path)
        self.known: dict[str, bytes] = {}
        self.kept = 0
        # the key that stands for the sign itself, which no word has
        self.sign = array("i", [self.pieces.byte[b] for b in SPACE.encode()]).tobytes()

    def words(self, text: str) -> list[str]:
        """The words of a text; an empty one stands for each U+2581 in it."""
        first, *rest = text.split(SPACE)
        out = _WORDS.findall(SPACE + first.replace(" ", SPACE))
        for part in rest:
            out.append("")
            out += _WORDS.findall(part.replace(" ", SPACE))
        return out

    def __call__(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """The ids of each text."""
        split = [self.words(t) if t else [] for t in texts]
        if self.kept > KEPT:
            self.known.clear()
            self.kept = 0
        self.known[""] = self.sign
        by_size: dict[int, list[str]] = {}
        for word in {w for words in split for w in words}:
            if word not in self.known:
                by_size.setdefault(len(word), []).append(word)
                self.kept += len(word)
        for size, words in by_size.items():
            step = max(1, CHUNK // size)
            for at in range(0, len(words), step):
                some = words[at : at + step]
                self.known.update(zip(some, self.pieces.segment(some) if size <= LONG else map(self.pieces.segment_long, some)))
        known = self.known
        return [
            None if t is None else np.frombuffer(b"".join([known[w] for w in words]), np.int32)
            for t, words in zip(texts, split)
        ]


def _lists(ids: list[np.ndarray | None]) -> pa.Array:
    sizes = np.array([0 if x is None else len(x) for x in ids], np.int64)
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    values = np.concatenate([np.zeros(0, np.int32), *(x for x in ids if x is not None)])
    missing = pa.array([x is None for x in ids], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=missing)


def encode(text: Column, model: str | None = None) -> Column:
    """The ids of a text, array<int>."""
    path = model or default_model()

    def run(texts: pa.Array) -> pa.Array:
        encoder = Encoder(path)
        out: list = []
        for at in range(0, len(texts), 1000):
            out.extend(encoder(texts.slice(at, 1000).to_pylist()))
        return _lists(out)

    return F.arrow_udf(run, ArrayType(IntegerType()))(text)


def decode(ids: Column, model: str | None = None) -> Column:
    """The text of ids."""
    path = model or default_model()

    def run(lists: pa.Array) -> pa.Array:
        pieces = Pieces(path)
        return pa.array([None if x is None else pieces.decode(x.tolist()) for x in lists.to_numpy(zero_copy_only=False)], pa.string())

    return F.arrow_udf(run, StringType())(ids)


def round_trip(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, ids, n_pieces, exact) for each of `docs`; `exact`: decoding gives the text."""
    path = model or default_model()

    def run(texts: pa.Array) -> pa.Array:
        encoder, ids, exact = Encoder(path), [], []
        for at in range(0, len(texts), 1000):
            some = texts.slice(at, 1000).to_pylist()
            coded = encoder(some)
            ids.extend(coded)
            exact.extend(t is None or encoder.pieces.decode(x.tolist()) == t for t, x in zip(some, coded))
        return pa.StructArray.from_arrays([_lists(ids), pa.array(exact, pa.bool_())], names=["ids", "exact"])

    kind = StructType([StructField("ids", ArrayType(IntegerType())), StructField("exact", BooleanType())])
    return docs.select("doc_id", F.arrow_udf(run, kind)("text").alias("r")).select(
        "doc_id", "r.ids", F.size("r.ids").alias("n_pieces"), "r.exact"
    )

"""Language-model scores by online logistic context mixing.

A text is a row of tokens: its words, A-Z in lower case, and one end. A token of the
vocabulary (the `VOCABULARY` most frequent of the training texts, of at most 64 bytes) is
coded by its Huffman path, one binary decision a node; any other by an escape and then by what
share of all escaped tokens it is or, as a new word, by the paths of its bytes, both added up.
Counters predict each decision: for words without context, by the last very frequent token,
which tells languages apart, and by hashes of the word before and of the two words before;
for bytes by the last one, two and four. Their log-odds are combined with weights that a gate
chooses by how much each counter has seen, and an adaptive map corrects the result by how
often such predictions came true. The probabilities of all decisions make that of the text,
so those of all texts add up to one at most.

Every word counts, however rare: as a context by itself, as a token by the table of all
tokens, which has no bound and is joined. Contexts of words have no bound either: all tokens
of all texts are shuffled once, by the word before them, so that a part has all that ever followed its
contexts. There the counters of the training texts are counts of ranges of sorted tokens, since what lies
below a node of the tree is a range of leaves. A word before that holds more than `SPLIT`
tokens is taken apart by the word before it; parts grow in number, not in size.

Training is by sums over all training texts. One pass counts tokens, one counts vocabulary
tokens by the last frequent one (at most `STATES` x `VOCABULARY` sums), one deals them out by context.
The byte counters take up every distinct token once, as a new word is like the rare ones.
The weights are learnt online: nine tenths of the texts (of the tokens, for bytes), chosen by hash,
fill the counters, each decision of the last tenth is predicted and moves the weights against its
error, and is taken up then too. The weights over contexts are learnt in each part by itself.

The model that goes to the executors has a fixed size (about 30 MB). What a
decision costs depends on few things, so it is worked out once: a token by its
contexts in its part, a spelled word by itself.

Nulls: a null text is empty and has the end alone. A null doc_id counts as empty text, whose crc32 is 0: it is held out.
Repeated rows score alike. Further columns are left alone. No training texts leave untrained
counters, which call each decision even. All texts that follow one word pair are scored by one task.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotewise.operators.joins import many_to_one
from lotewise.session import keep

VOCABULARY = 1 << 17
WORD_BYTES = 64
#: Contexts of words: the last of so many most frequent tokens.
STATES = 16
#: Counters by the last one, two and four bytes, as powers of two; a block is summed at once.
SIZES = (18, 20, 22)
BLOCK = 16
#: One in so many texts, or tokens, moves the weights.
TUNED = 10
#: Documents that are worked through at once, and their bytes (one longer text goes alone).
SLICE = 256
SLICE_BYTES = 1 << 19
GATES = 512
STEPS = 33
FINE = 170.0  # steps of a stored log-odds
#: What is turned into decisions at once, some 15 or 60 each.
PAIRS_AT_ONCE = 1 << 14
WORDS_AT_ONCE = 1 << 12
#: Bytes of words spelled at once (one longer word goes alone).
SPELLED_BYTES = 1 << 16
#: What scoring turns into decisions at once; sums by token and word do not depend on it.
SCORED_AT_ONCE = 1 << 11
#: Spelled words whose cost a task keeps.
KEPT = 1 << 17
#: Tokens that are dealt out at once, those a part has on average, and those of one word before that stay together.
DEALT = 1 << 19
PART = 1 << 19
SPLIT = 1 << 18
LEAF = 18  # bits of a leaf
#: Distinct tokens in context whose decisions are worked out at once.
MIXED_AT_ONCE = 1 << 14
#: So many texts that move the weights are worth as much as the weights before.
TRUSTED = 300
#: Moves of the weights by what is worked out at once.
TURNS = 16
END = b""


def tokens(text: str | None) -> list[bytes]:
    """Words, then the end."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    words.append(END)
    return words


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()

    def out() -> pa.RecordBatch:
        kinds = [pa.array(list(seen.keys()), pa.binary()), pa.array(list(seen.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(kinds, names=["word", "n"])

    for batch in batches:
        for text in batch.column(0):
            seen.update(tokens(text.as_py()))
            if len(seen) > 200_000:
                yield out()
                seen.clear()
    yield out()


def token_counts(texts: DataFrame) -> DataFrame:
    """(word, n): how often each token occurs; added up in each task first."""
    parts = texts.select("text").mapInArrow(_counted, "word binary, n long")
    return keep(parts.groupBy("word").agg(F.sum("n").alias("n")), "tokens")


def huffman(counts: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each symbol the start and end of its path, and the paths as node * 2 + bit.

    Node 0 is the root; a code of n symbols has n - 1 nodes."""
    n = len(counts)
    heap = [(c, i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    parent = np.zeros(2 * n - 1, np.int64)
    side = np.zeros(2 * n - 1, np.int64)
    for new in range(n, 2 * n - 1):
        a, i = heapq.heappop(heap)
        b, j = heapq.heappop(heap)
        parent[i], parent[j], side[j] = new, new, 1
        heapq.heappush(heap, (a + b, new))
    root = 2 * n - 2
    paths, start = [], [0]
    for symbol in range(n):
        at, path = symbol, []
        while at != root:
            path.append((root - parent[at]) * 2 + side[at])
            at = parent[at]
        paths.extend(reversed(path))
        start.append(len(paths))
    bounds = np.array(start, np.int32)
    return bounds[:-1], bounds[1:], np.array(paths, np.int32)


class Coder:
    """Turns tokens into binary decisions and the counters that predict them."""

    def __init__(self, words: list[bytes], codes: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        """`words` by falling count; `codes`: the paths of words, the escape last, and of bytes."""
        self.index = {w: i for i, w in enumerate(words)}
        self.escape = len(words)
        self.codes = codes

    def read(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes], np.ndarray]:
        """Token ids, their states, the document of each, the words outside, their documents."""
        flat = [w for t in texts for w in t]
        index, escape = self.index, self.escape
        ids = np.array([index.get(w, escape) for w in flat], np.int64)
        doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        last = np.maximum.accumulate(np.where(ids < STATES, np.arange(len(ids)), 0))
        state = np.concatenate(([0], ids[last][:-1]))  # an end, 0, is among them and starts anew
        outside = np.flatnonzero(ids == escape)
        return ids, np.where(state < STATES, state, 0), doc, [flat[i] for i in outside.tolist()], doc[outside]

    def word_decisions(self, states: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Bits, the slots of the counters, and the token of each decision."""
        path, of = self._paths(0, ids)
        node = path >> 1
        return path & 1, [node, (states[of] + 1) * (self.escape + 1) + node], of

    def byte_decisions(self, words: list[bytes]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """The same for words spelled out; the last array gives the word of each decision."""
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        word = np.repeat(np.arange(len(words)), size)
        symbols = np.full(len(word), 256, np.int64)
        inside = np.ones(len(word), bool)
        inside[np.cumsum(size) - 1] = False
        symbols[inside] = np.frombuffer(b"".join(words), np.uint8)
        at = np.arange(len(word)) - np.repeat(np.cumsum(size) - size, size)

        def back(k: int) -> np.ndarray:
            moved = np.concatenate((np.full(k, 256), symbols))[: len(symbols)]
            return np.where(at >= k, moved, 257)

        pair = back(1) + 259 * back(2)
        path, of = self._paths(1, symbols)
        node = (path >> 1).astype(np.uint32) * np.uint32(2654435761)
        slots = []
        for context, power in zip([back(1), pair, pair + 67081 * (back(3) + 259 * back(4))], SIZES):
            mixed = ((context.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32)
            x = mixed[of] + node
            x ^= x >> np.uint32(15)
            x *= np.uint32(2246822519)
            slots.append(x >> np.uint32(32 - power))
        return path & 1, slots, word[of]

    def _paths(self, kind: int, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """node * 2 + bit of each decision, and the symbol it belongs to."""
        start, end, paths = self.codes[kind]
        first, size = start[symbols], end[symbols] - start[symbols]
        of = np.repeat(np.arange(len(symbols)), size)
        step = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
        return paths[first[of] + step], of


def squeezed(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """A counter as 16 bits: its log-odds in 12, how much it has seen in 4."""
    n0, n1 = zeros.astype(np.float32), ones.astype(np.float32)
    odds = np.clip(np.log((n1 + 0.2) / (n0 + 0.2)), -12, 12)
    seen = np.minimum(np.log2(1 + n0 + n1), 15).astype(np.uint16)
    return ((np.rint(odds * FINE) + 2048).astype(np.uint16) << np.uint16(4)) | seen


_ODDS = ((np.arange(1 << 16) >> 4) - 2048).astype(np.float32) / np.float32(FINE)


class Mixer:
    """Gated weights and the adaptive map for decisions of one kind."""

    def __init__(self, inputs: int) -> None:
        self.inputs = inputs
        self.weights = np.full((inputs + 1, GATES), 1 / inputs, np.float32)
        self.weights[inputs] = 0
        self.seen = np.zeros(GATES)
        self.map = np.zeros((2, STEPS))

    def mix(self, stored: list[np.ndarray]):
        odds = [_ODDS[v] for v in stored]
        gate = np.zeros(len(stored[0]), np.int64)
        for v in stored:
            gate = (gate << 3) | ((v & 15) >> 1)
        z = self.weights[self.inputs][gate]
        for k, x in enumerate(odds):
            z += self.weights[k][gate] * x
        return np.clip(z, -12, 12), odds, gate

    def learn(self, stored: list[np.ndarray], bits: np.ndarray, n: np.ndarray, rate: float = 0.02) -> None:
        """Moves the weights of each gate against the error of its decisions, `n` times each."""
        z, odds, gate = self.mix(stored)
        error = (bits - 1 / (1 + np.exp(-z))) * n
        count = np.bincount(gate, n, GATES)
        self.seen += count
        scale = rate * np.minimum(count, 30) / np.maximum(count, 1)
        for k, x in enumerate(odds):
            self.weights[k] += scale * np.bincount(gate, error * x, GATES)
        self.weights[self.inputs] += scale * np.bincount(gate, error, GATES)
        at = self._step(z)
        self.map[0] += np.bincount(at, (1 - bits) * n, STEPS)
        self.map[1] += np.bincount(at, bits * n, STEPS)

    @staticmethod
    def _step(z: np.ndarray) -> np.ndarray:
        return np.rint(z * ((STEPS // 2) / 12)).astype(np.int64) + STEPS // 2

    def odds(self, stored: list[np.ndarray]) -> np.ndarray:
        """The mixed log-odds, corrected by the map."""
        z, _, _ = self.mix(stored)
        prior = 1 / (1 + np.exp(-np.linspace(-12, 12, STEPS)))
        ones = (self.map[1] + 20 * prior) / (self.map.sum(0) + 20)
        refined = np.log(ones / (1 - ones)).astype(np.float32)
        return np.clip((z + refined[self._step(z)]) / 2, -12, 12)

    def cost(self, stored: list[np.ndarray], bits: np.ndarray) -> np.ndarray:
        """The natural logarithm of the probability of each decision."""
        z = self.odds(stored)
        return -np.log(1 + np.exp(np.where(bits == 1, -z, z)))

    def dump(self) -> bytes:
        return np.concatenate([(self.weights * self.seen).ravel(), self.seen, self.map.ravel()]).tobytes()

    def load(self, data: bytes) -> None:
        """The mean of the weights whose sums, weighted by use, `dump` has given."""
        flat = np.frombuffer(data)
        cut = (self.inputs + 1) * GATES
        self.seen = flat[cut : cut + GATES]
        mean = flat[:cut].reshape(-1, GATES) / np.maximum(self.seen, 1)
        self.weights = np.where(self.seen > 0, mean, self.weights).astype(np.float32)
        self.map = flat[cut + GATES :].reshape(2, STEPS)


def _texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[list[list[bytes]], pa.RecordBatch]]:
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        for at, end in _portions(sizes, SLICE, SLICE_BYTES):
            part = batch.slice(at, end - at)
            yield [tokens(t.as_py()) for t in part.column(column)], part


def _portions(sizes: list[int], rows: int, size: int) -> Iterator[tuple[int, int]]:
    """Starts and ends of runs of at most `rows` items and, unless it is one item, `size` in all."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and (i - start == rows or total + n > size):
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def _paired(coder: Coder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pair, n) of a task: how often each vocabulary token stands in each state."""
    seen = np.zeros(STATES * (coder.escape + 1), np.int32)
    for texts, _ in _texts(batches, 0):
        ids, states, *_ = coder.read(texts)
        at, times = np.unique(states * (coder.escape + 1) + ids, return_counts=True)
        seen[at] += times.astype(np.int32)
    at = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at].astype(np.int64))], names=["pair", "n"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _block(0, b"".join(c.to_numpy().astype(np.int64).tobytes() for c in batch.columns))


def _pairs(sent, texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The pair counts of some texts: at most one for each state and vocabulary token."""
    counted = texts.select("text").mapInArrow(lambda b: _paired(Coder(*sent.value), b), "pair long, n long")
    summed = counted.groupBy("pair").agg(F.sum("n").alias("n"))
    rows = [np.frombuffer(r.data, np.int64).reshape(2, -1) for r in summed.mapInArrow(_packed, "block int, data binary").collect()]
    both = np.concatenate([np.zeros((2, 0), np.int64), *rows], axis=1)
    return both[:, np.argsort(both[0], kind="stable")]


def _word_model(coder: Coder, others: np.ndarray, tuned: np.ndarray) -> tuple[list[np.ndarray], Mixer]:
    width = coder.escape + 1
    totals = [np.zeros((width, 2)), np.zeros(((STATES + 1) * width, 2))]
    mixer = Mixer(2)

    def decisions(pairs: np.ndarray):
        mixed = pairs[:, np.argsort(pairs[0] * 2654435761 % (1 << 32), kind="stable")]  # as if texts came along
        for at in range(0, mixed.shape[1], PAIRS_AT_ONCE):
            pair, n = mixed[:, at : at + PAIRS_AT_ONCE]
            bits, slots, of = coder.word_decisions(pair // width, pair % width)
            yield bits, slots, n[of].astype(np.float64)

    def take(bits: np.ndarray, slots: list[np.ndarray], n: np.ndarray) -> None:
        for total, slot in zip(totals, slots):
            total += np.bincount(slot * 2 + bits, n, 2 * len(total)).reshape(-1, 2)

    for row in decisions(others):
        take(*row)
    known = [squeezed(t[:, 0], t[:, 1]) for t in totals]
    for bits, slots, n in decisions(tuned):
        mixer.learn([k[s] for k, s in zip(known, slots)], bits, n)
    for row in decisions(tuned):
        take(*row)
    return [squeezed(t[:, 0], t[:, 1]) for t in totals], mixer


def _spelled(coder: Coder, batches: Iterator[pa.RecordBatch], known: list | None = None) -> Iterator[pa.RecordBatch]:
    """The byte counters of a task's words in blocks and, where those of the other words are
    `known`, weights and map."""
    counters = [np.zeros(2 << p, np.int32) for p in SIZES]
    mixer = Mixer(3)
    for batch in batches:
        words = batch.column(0).to_pylist()
        for start, end in _portions([len(w) for w in words], WORDS_AT_ONCE, SPELLED_BYTES):
            bits, slots, _ = coder.byte_decisions(words[start:end])
            if known:
                mixer.learn([c[s] for c, s in zip(known, slots)], bits, np.ones(len(bits)))
            for counter, slot in zip(counters, slots):
                at, times = np.unique((slot.astype(np.int64) << 1) | bits, return_counts=True)
                counter[at] += times.astype(np.int32)
    pack = zstandard.ZstdCompressor(level=1).compress
    for table, counter in enumerate(counters):
        for block, part in enumerate(counter.reshape(-1, 2 << BLOCK)):
            if part.any():
                yield _block(table * 1000 + block, pack(part.tobytes()))
    if known:
        yield _block(-1, mixer.dump())


def _block(number: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([data], pa.binary())], names=["block", "data"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the blocks of one number, which come one after another; one sum is held."""
    unpack, pack = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=1).compress
    held, total = None, None

    def out() -> pa.RecordBatch:
        return _block(held, total.tobytes() if held == -1 else pack(total.astype(np.int32).tobytes()))

    for batch in batches:
        for number, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            part = np.frombuffer(data.as_py()) if number == -1 else np.frombuffer(unpack(data.as_py()), np.int32)
            if number != held:
                if held is not None:
                    yield out()
                held, total = number, np.zeros(len(part), np.float64 if number == -1 else np.int64)
            total = np.minimum(total + part, 2**31 - 1) if number >= 0 else total + part
    if held is not None:
        yield out()


def _sums(learned: DataFrame) -> DataFrame:
    """One row for each block. Blocks of one number, one from each task, are added up in
    two steps, the first in as many parts as keep a task's share of them small."""
    kind = "block int, data binary"
    salted = learned.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(64)))
    once = salted.repartition("block", "salt").sortWithinPartitions("block", "salt").select("block", "data")
    return once.mapInArrow(_summed, kind).repartition("block").sortWithinPartitions("block").mapInArrow(_summed, kind)


def _fetched(sums: DataFrame) -> tuple[list[np.ndarray], bytes | None]:
    """The squeezed counters, at most 2 bytes each, and the row of weights if there is one."""

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = None if number == -1 else np.frombuffer(unpack(data), np.int32)
                yield _block(number, data if number == -1 else squeezed(counts[::2], counts[1::2]).tobytes())

    counters = [np.full(1 << p, 2048 << 4, np.uint16) for p in SIZES]
    rest = None
    for r in sums.mapInArrow(squeeze, "block int, data binary").collect():
        if r.block == -1:
            rest = bytes(r.data)
            continue
        table, block = divmod(r.block, 1000)
        counters[table][block << BLOCK : (block + 1) << BLOCK] = np.frombuffer(r.data, np.uint16)
    return counters, rest


def train(texts: DataFrame, counts: DataFrame):
    """Counts of the vocabulary, the coder's arguments, counters and mixer of words and of bytes.

    Tokens outside the vocabulary are counted too, in `counts`, and told by it (`score_texts`)."""
    known = counts.filter((F.length("word") > 0) & (F.length("word") <= WORD_BYTES))
    top = known.orderBy(F.col("n").desc(), "word").limit(VOCABULARY - 1).toArrow()
    totals = counts.agg(F.sum("n").alias("n"), F.sum(F.when(F.length("word") == 0, F.col("n"))).alias("ends")).first()
    words = [END, *top.column("word").to_pylist()]
    seen = [totals.ends or 0, *top.column("n").to_pylist()]
    letters = np.zeros(257, np.int64)
    for w in words[1:]:
        letters[:256] += np.bincount(np.frombuffer(w, np.uint8), minlength=256)
    letters[256] = len(words)
    other = (totals.n or 0) - sum(seen)
    made = [words, [huffman([c + 1 for c in [*seen, other]]), huffman([c + 1 for c in letters.tolist()])]]
    context = texts.sparkSession.sparkContext
    sent = context.broadcast(made)
    coder = Coder(*made)

    tenth = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(TUNED)) == 0
    of_words = _word_model(coder, _pairs(sent, texts.filter(~tenth)), _pairs(sent, texts.filter(tenth)))

    kind = "block int, data binary"
    new = counts.filter(F.length("word") > 0)
    tenth = F.pmod(F.xxhash64("word"), F.lit(TUNED)) == 0
    others = new.filter(~tenth).select("word").mapInArrow(lambda b: _spelled(Coder(*sent.value), b), kind)
    first = keep(_sums(others), "counters")
    before = context.broadcast(_fetched(first)[0])
    last = new.filter(tenth).select("word").mapInArrow(lambda b: _spelled(Coder(*sent.value), b, before.value), kind)
    counters, rest = _fetched(_sums(first.unionByName(last)))
    mixer = Mixer(3)
    if rest is not None:
        mixer.load(rest)
    return seen, made, of_words, (counters, mixer)


class Scorer:
    """Natural logarithms of probabilities; each (state, token) and spelled word once."""

    def __init__(self, made: list, of_words: tuple, of_bytes: tuple) -> None:
        self.coder = Coder(*made)
        self.of_words, self.of_bytes = of_words, of_bytes
        self.pairs = np.full(STATES * (self.coder.escape + 1) if of_words else 0, np.nan, np.float32)
        self.words: dict[bytes, float] = {}

    def tokens(self, states: np.ndarray, ids: np.ndarray) -> np.ndarray:
        pair = states * (self.coder.escape + 1) + ids
        new = np.unique(pair[np.isnan(self.pairs[pair])])
        counters, mixer = self.of_words
        for at in range(0, len(new), SCORED_AT_ONCE):
            some = new[at : at + SCORED_AT_ONCE]
            bits, slots, of = self.coder.word_decisions(some // (self.coder.escape + 1), some % (self.coder.escape + 1))
            self.pairs[some] = np.bincount(of, mixer.cost([c[s] for c, s in zip(counters, slots)], bits), len(some))
        return self.pairs[pair]

    def spelled(self, words: list[bytes]) -> list[float]:
        if len(self.words) > KEPT:
            self.words.clear()
        new = list({w for w in words if w not in self.words})
        counters, mixer = self.of_bytes
        for at, end in _portions([len(w) for w in new], SCORED_AT_ONCE, SPELLED_BYTES):
            some = new[at:end]
            bits, slots, of = self.coder.byte_decisions(some)
            cost = np.bincount(of, mixer.cost([c[s] for c, s in zip(counters, slots)], bits), len(some))
            self.words.update(zip(some, cost.tolist()))
        return [self.words[w] for w in words]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def last_hash(splits: np.ndarray, last: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Of the word before; its tokens are taken apart by the word before it, `splits` times."""
    last, before = last.astype(np.uint64), before.astype(np.uint64)
    known = np.minimum(last, np.uint64(len(splits) - 1)).astype(np.int64)
    times = np.where(last < len(splits), splits[known], 1).astype(np.uint64)
    return _mixed((last << np.uint64(16)) + _mixed(before + np.uint64(1)) % times + np.uint64(1 << 50))


def both_hash(last: np.ndarray, before: np.ndarray) -> np.ndarray:
    return _mixed((last.astype(np.uint64) << np.uint64(32)) | before.astype(np.uint64))


class Contexts:
    """The words before a token as hashed contexts, and what they say of its decisions.

    `code`: the Huffman paths of the vocabulary; `base`: a stored log-odds for each state and
    node, from the counters without these contexts; `splits`: how often the tokens after a word are taken apart."""

    def __init__(self, code: tuple[np.ndarray, np.ndarray, np.ndarray], base: np.ndarray, splits: np.ndarray) -> None:
        self.first, end, self.paths = code
        self.base, self.splits = base, splits
        self.size = end - self.first
        self.width = len(self.size)
        of = np.repeat(np.arange(self.width), self.size)
        depth = np.arange(len(of)) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        #: The bits of each path from the left, and the leaves from left to right.
        self.bits = np.zeros(self.width, np.uint64)
        np.bitwise_or.at(self.bits, of, (self.paths & 1).astype(np.uint64) << (63 - depth).astype(np.uint64))
        self.leaf = np.empty(self.width, np.uint64)
        self.leaf[np.argsort(self.bits, kind="stable")] = np.arange(self.width)
        few = np.arange(256)
        self.few = squeezed(np.repeat(few, 256), np.tile(few, 256))

    def stored(self, zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
        """`squeezed`, of small counts by a table."""
        out = self.few.take(np.minimum(zeros, 255) * 256 + np.minimum(ones, 255))
        many = np.flatnonzero((zeros > 255) | (ones > 255))
        out[many] = squeezed(zeros[many], ones[many])
        return out

    def counters(self, new: np.ndarray, ids: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Step by step down the tree: the tokens that go on, their bits and the counters of their node.

        The tokens stand in the order of context and leaf, `new` tells where a context begins, `n` how often each one counts. Those
        of a context below a node stand together, so its counter is a sum over a run."""
        live, size, code = np.arange(len(ids)), self.size.take(ids), self.bits.take(ids)
        for step in range(int(size.max(initial=0))):
            on = np.flatnonzero(size > step)  # whole runs end
            if len(on) < len(size):
                live, size, code, n, new = (x.take(on) for x in (live, size, code, n, new))
            bit = (code >> np.uint64(63 - step)).astype(np.int64) & 1
            start = np.flatnonzero(new)
            ones = np.add.reduceat(n * bit, start)
            stored = self.stored(np.add.reduceat(n, start) - ones, ones)
            yield live, bit, np.repeat(stored, np.diff(start, append=len(new)))
            new = new.copy()
            new[1:] |= bit[1:] != bit[:-1]

    def decisions(self, tables: list[tuple[np.ndarray, np.ndarray, np.ndarray]], up: np.ndarray, states: np.ndarray):
        """Bits, stored log-odds of each kind of counter, and the token of each decision.

        `tables`: (new, ids, n) by the word before and by both words, `up`: the place in the first of each token of the second."""
        (wide, _, _), (_, ids, _) = tables
        steps = int(self.size[ids].max(initial=0))
        above = np.zeros((steps, len(wide)), np.uint16)
        for row, (live, _, stored) in zip(above, self.counters(*tables[0])):
            row[live] = stored
        bits, kinds, of = [], ([], [], []), []
        at, row = self.first[ids], states * self.width
        for step, (live, bit, stored) in enumerate(self.counters(*tables[1])):
            kinds[0].append(self.base.take(row.take(live) + (self.paths.take(at.take(live) + step) >> 1)))
            kinds[1].append(above[step].take(up.take(live)))
            kinds[2].append(stored)
            bits.append(bit)
            of.append(live)
        return np.concatenate(bits), [np.concatenate(k) for k in kinds], np.concatenate(of)

    def costs(
        self, last: np.ndarray, before: np.ndarray, states: np.ndarray, ids: np.ndarray, kind: np.ndarray, tuned_texts: int
    ) -> np.ndarray:
        """The logarithm of the probability of each token; `kind`: 0 counts, 1 moves the weights and counts then, 2 does neither.

        What few texts have taught is trusted little: the tokens of one text hang together."""
        if not len(ids):
            return np.zeros(0)
        hashed = np.unique(last_hash(self.splits, last, before), return_inverse=True)[1].astype(np.uint64)
        room = np.uint64(int(hashed.max()).bit_length())
        both = (hashed << (np.uint64(63) - room)) | (both_hash(last, before) >> (room + np.uint64(1)))
        both = np.unique(both, return_inverse=True)[1].astype(np.uint64)
        key = (both << np.uint64(LEAF + 4)) | (self.leaf[ids] << np.uint64(4)) | states.astype(np.uint64)
        _, at, back = np.unique(key, return_index=True, return_inverse=True)
        hashed, both, ids, states = hashed[at], both[at], ids[at].astype(np.int64), states[at].astype(np.int64)
        del key
        known, found, up = np.unique((hashed << np.uint64(LEAF)) | self.leaf[ids], return_index=True, return_inverse=True)
        first = lambda x: np.concatenate(([True], x[1:] != x[:-1]))
        counted = [np.bincount(back[kind == k], minlength=len(at)) for k in (0, 1)]
        summed = [np.bincount(up, n, len(known)).astype(np.int64) for n in counted]
        one = (first(hashed[found]), ids[found])

        def portions(some: np.ndarray, size: int):
            """Whole contexts of the word before at a time: places in the table by it, and `some` of those by both words."""
            of = hashed[some]
            starts = np.append(np.flatnonzero(first(of)), len(some))
            cuts = np.unique(np.append(np.searchsorted(starts, np.arange(0, len(some), size)), len(starts) - 1))
            for a, b in zip(starts[cuts[:-1]].tolist(), starts[cuts[1:]].tolist()):
                edge = np.array([of[a], of[b - 1] + np.uint64(1)]) << np.uint64(LEAF)
                yield slice(*np.searchsorted(known, edge).tolist()), some[a:b]

        def told(n: list[np.ndarray], r: slice, q: np.ndarray):
            tables = [(*(x[r] for x in one), n[0][r]), (first(both[q]), ids[q], n[1][q])]
            return self.decisions(tables, up[q] - r.start, states[q])

        mixer = Mixer(3)
        mixer.weights[0], mixer.weights[1:] = 1, 0  # until something is learnt, nothing changes
        begin = np.flatnonzero(first(both))
        tuned = np.repeat(np.add.reduceat(counted[1], begin) > 0, np.diff(begin, append=len(at)))
        for r, q in portions(np.flatnonzero(tuned), MIXED_AT_ONCE // 2):
            bits, stored, of = told([summed[0], counted[0]], r, q)
            n = counted[1][q]
            turn = np.where(n > 0, np.arange(len(q)) % TURNS, -1)[of]
            for k in range(TURNS):
                moves = np.flatnonzero(turn == k)
                mixer.learn([x[moves] for x in stored], bits[moves], n[of[moves]].astype(np.float64))
        trust = tuned_texts / (tuned_texts + TRUSTED)
        mixer.weights *= trust
        mixer.weights[0] += 1 - trust
        mixer.map *= trust
        cost, all_of = np.zeros(len(at)), [summed[0] + summed[1], counted[0] + counted[1]]
        for r, q in portions(np.arange(len(at)), MIXED_AT_ONCE):
            bits, stored, of = told(all_of, r, q)
            cost[q] = np.bincount(of, mixer.cost(stored, bits), len(q))
        return cost[back]


_COLUMNS = (np.uint32, np.uint32, np.uint32, np.uint32, np.uint8)  # last, before, id, step to the next text, state and kind


def _pack(columns: list[np.ndarray]) -> bytes:
    """Equal bytes of a column side by side, compressed."""
    flat = [c.astype(t).view(np.uint8).reshape(len(c), -1).T.tobytes() for c, t in zip(columns, _COLUMNS)]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(flat))


def _unpack(data: bytes) -> list[np.ndarray]:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    widths = [np.dtype(t).itemsize for t in _COLUMNS]
    n, at, out = len(flat) // sum(widths), 0, []
    for t, width in zip(_COLUMNS, widths):
        out.append(np.ascontiguousarray(flat[at : at + n * width].reshape(width, n).T).view(t).ravel())
        at += n * width
    return out


def _groups(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[int, list[tuple]]]:
    """Rows that share the value of a column and come one after another."""
    held, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[column] != held:
                if rows:
                    yield held, rows
                held, rows = row[column], []
            rows.append(row)
    if rows:
        yield held, rows


DEAL = "part int, batch long, data binary"
SHARE = "batch long, part int, data binary"


def _dealt(words: list[bytes], seen: list[int], splits: np.ndarray, spell: Scorer, mass: float, parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tokens of the texts by part, and under a number below 0 the texts themselves, some texts at a time."""
    coder = spell.coder
    counted = np.array([*seen, 0])
    base = np.log10((counted + 0.1) / mass)
    base[-1] = 0.0
    number = TaskContext.get().partitionId() << 32
    rows, tokens_held, dealt = [], [], 0

    def out() -> Iterator[pa.RecordBatch]:
        *columns, part = (np.concatenate(c) for c in zip(*tokens_held))
        order = np.argsort(part, kind="stable")
        ends = np.cumsum(np.bincount(part, minlength=parts))
        columns = [c[order] for c in columns]
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
            for r in rows:
                stream.write_batch(r)
        yield _deal(-1 - number % parts, number, sink.getvalue().to_pybytes())
        for p, (start, end) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist())):
            if end > start:
                some = [c[start:end] for c in columns]
                some[3] = np.diff(some[3], prepend=some[3].dtype.type(0))
                yield _deal(p, number, _pack(some))

    for texts, part in _texts(batches, 3):
        n = len(texts)
        ids, states, doc, outside, owner = coder.read(texts)
        kind = part.column(2).to_numpy(zero_copy_only=False)
        names = ids.copy()
        names[ids == coder.escape] = np.fromiter(map(zlib.crc32, outside), np.int64, len(outside)) % ((1 << 32) - len(words)) + len(words)
        last = np.concatenate(([0], names[:-1]))
        before = np.where(last == 0, 0, np.concatenate(([0], last[:-1])))  # an end starts anew
        slot = doc + sum(r.num_rows for r in rows)
        where = ((last_hash(splits, last, before) >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)
        marks = states | kind[doc].astype(np.int64) << 4
        tokens_held.append((*(c.astype(t) for c, t in zip((last, before, ids, slot, marks), _COLUMNS)), where))
        rest = Counter(zip(owner.tolist(), outside))  # texts come one after another
        others = [w for _, w in rest]
        held = [kind[d] == 2 for d, _ in rest]
        # a held-out word may be in no table
        spelled = iter(spell.spelled([w for w, h in zip(others, held) if h]))
        rest_of = pa.ListArray.from_arrays(
            pa.array(np.concatenate(([0], np.cumsum(np.bincount([d for d, _ in rest], minlength=n)))).astype(np.int32)),
            pa.StructArray.from_arrays(
                [
                    pa.array(others, pa.binary()),
                    pa.array(list(rest.values()), pa.int64()),
                    pa.array([next(spelled) if h else None for h in held], pa.float64()),
                ],
                names=["word", "n", "spelled"],
            ),
        )
        rows.append(
            pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(1),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([len((t.as_py() or "").encode("utf-8", "surrogatepass")) for t in part.column(3)], pa.int64()),
                    pa.array(np.bincount(doc, counted[ids] > 0, n).astype(np.int64)),
                    pa.array(np.bincount(doc, base[ids], n)),
                    rest_of,
                ],
                names=["doc_id", "held_out", "n_tokens", "n_bytes", "known", "base", "rest"],
            )
        )
        dealt += len(ids)
        if dealt >= DEALT:
            yield from out()
            rows, tokens_held, dealt = [], [], 0
            number += 1
            pa.default_memory_pool().release_unused()
    if rows:
        yield from out()


def _deal(part: int, number: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([number], pa.int64()), pa.array([data], pa.binary())], names=["part", "batch", "data"]
    )


def _shares(contexts: Contexts, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each part the sums of its tokens' costs by text; the texts themselves go on as they are."""

    def share(part: int, number: int, data: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([part], pa.int32()), pa.array([data], pa.binary())], names=["batch", "part", "data"]
        )

    for part, rows in _groups(batches, 0):
        if part < 0:
            for _, number, data in rows:
                yield share(-1, number, data)
            continue
        dealt = [_unpack(data) for _, _, data in rows]
        numbers = [number for _, number, _ in rows]
        slots = [np.cumsum(d[3].astype(np.int64)) for d in dealt]
        last, before, ids, _, marks = (np.concatenate(c) for c in zip(*dealt))
        tuned = sum(len(np.unique(slot[d[4] >> 4 == 1])) for slot, d in zip(slots, dealt))
        del rows, dealt
        cost = contexts.costs(last, before, marks & 15, ids, marks >> 4, tuned)
        del last, before, ids, marks
        at = 0
        for number, slot in zip(numbers, slots):
            found, where = np.unique(slot, return_inverse=True)
            sums = np.bincount(where, cost[at : at + len(slot)], len(found))
            at += len(slot)
            yield share(part, number, found.astype(np.uint32).tobytes() + sums.astype(np.float32).tobytes())


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts with the shares of all parts, in the order of the parts."""
    for _, rows in _groups(batches, 0):
        texts = list(pa.ipc.open_stream(rows[0][2]))
        nats = np.zeros(sum(t.num_rows for t in texts))
        for _, _, data in rows[1:]:
            n = len(data) // 8
            nats[np.frombuffer(data, np.uint32, n)] += np.frombuffer(data, np.float32, n, 4 * n)
        at = 0
        for t in texts:
            columns = dict(zip(t.schema.names, t.columns)) | {"nats": pa.array(nats[at : at + t.num_rows])}
            at += t.num_rows
            yield pa.RecordBatch.from_arrays([columns[c] for c in SCORED_NAMES], names=SCORED_NAMES)


SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_bytes long, known long, base double, nats double, "
    "rest array<struct<word:binary,n:long,spelled:double>>"
)
SCORED_NAMES = ["doc_id", "held_out", "n_tokens", "n_bytes", "known", "base", "nats", "rest"]


def score_texts(docs: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) for
    each of `docs`; the model learns from those of which `held_out` is false."""
    tuned = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(TUNED)) == 0
    kind = F.when(F.col("held_out"), 2).when(tuned, 1).otherwise(0)
    rows = docs.select("doc_id", held_out.alias("held_out"), "text").select("doc_id", "held_out", kind.alias("kind"), "text")
    texts = rows.filter(~F.col("held_out")).select("text")
    counts = token_counts(texts)
    size = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    mass = size.n + 0.1 * (size.v + 1)
    seen, made, of_words, of_bytes = train(texts, counts)
    context = docs.sparkSession.sparkContext
    words, (path_codes, _) = made
    width = len(words) + 1
    stored, mixer = of_words
    nodes = np.arange(width)
    base = np.concatenate([
        (np.rint(mixer.odds([stored[0], k]) * FINE) + 2048).astype(np.uint16) << np.uint16(4) | (k & np.uint16(15))
        for k in (stored[1][(state + 1) * width + nodes] for state in range(STATES))
    ])
    splits = np.maximum(np.array(seen, np.int64) // SPLIT, 0) + 1
    sent = context.broadcast((words, seen, made, of_bytes, splits))
    mixed = context.broadcast((path_codes, base, splits))
    parts = size.n // PART + 1

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen, made, of_bytes, splits = sent.value
        return _dealt(words, seen, splits, Scorer(made, None, of_bytes), mass, parts, batches)

    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value[2], None, sent.value[3])
        for batch in batches:
            spelled = scorer.spelled(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spelled, pa.float64())], names=["word", "n", "spelled"])

    dealt = rows.mapInArrow(deal, DEAL).repartition(parts, "part").sortWithinPartitions("part", "batch")
    shares = dealt.mapInArrow(lambda b: _shares(Contexts(*mixed.value), b), SHARE)
    whole = shares.repartition("batch").sortWithinPartitions("batch", "part").mapInArrow(_scored, SCORED)
    scored = keep(whole.withColumn("row", F.monotonically_increasing_id()), "scored")
    rest = scored.select("row", F.explode("rest").alias("r")).select(
        "row", F.col("r.word").alias("word"), F.col("r.n").alias("k"), F.col("r.spelled").alias("new")
    )
    # words of the vocabulary are asked for by none
    coded = docs.sparkSession.createDataFrame(pa.table({"word": pa.array(words, pa.binary())}))
    outside = counts.join(coded, "word", "left_anti").mapInArrow(price, "word binary, n long, spelled double")
    outside = keep(outside, "outside")
    escaped = outside.agg(F.sum("n").alias("n"), F.count_if(F.col("n") == 1).alias("once")).first()
    new = (escaped.once + 1) / ((escaped.n or 0) + 2)  # the share of new words among them, as of those seen once
    found = many_to_one(rest, outside, ["word"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    told = (1 - new) * F.col("n") / F.lit(max(escaped.n or 0, 1)) + new * F.exp(F.coalesce("spelled", "new"))
    # the logarithm of the sum, also of words too long for their probability
    nats = F.greatest(F.log(told), math.log(new) + F.coalesce("spelled", "new"))
    of_row = found.groupBy("row").agg(
        F.sum(F.col("k") * F.log10((F.col("n") + 0.1) / mass)).alias("base_rest"),
        F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("known_rest"),
        F.sum(F.col("k") * nats).alias("nats_rest"),
    )
    nats = F.col("nats") + F.coalesce("nats_rest", F.lit(0.0))
    return scored.join(of_row, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("known_rest", F.lit(0))).alias("n_known"),
        F.lit(size.n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_rest", F.lit(0.0))).alias("base_score"),
        (nats / math.log(10)).alias("score"),
        F.when(F.col("n_bytes") > 0, -nats / math.log(2) / F.col("n_bytes")).alias("bits_per_byte"),
    )

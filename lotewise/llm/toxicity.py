"""Toxicity by multiple-instance learning: documents are labelled, sentences are scored.

A sentence is a bag of hashed features: its words, and the first four and five letters of
each. A linear score s of a sentence becomes the probability that it is toxic, and a
document is toxic if any of its sentences is: 1 - prod(1 - p), the noisy-or. The weights
are fitted to document labels through the noisy-or, so the model itself finds out which
sentences carry the label; afterwards it points at them. A sentence's probability is measured from that
of a sentence without any sign, 1 - p = (1 - sigmoid(s)) / (1 - sigmoid(constant)): sentences that show nothing
add nothing. Faint signs stand in clean texts too, the more the longer they are: `CALM` times what they come to in a
sentence of the clean documents is taken off for each sentence, but never below the strongest sentence alone. So
a clean text may be of any length, and one toxic sentence tells in a text of any length.

Training uses a bounded sample: of each label the `PER_LABEL` documents whose hashed id is
lowest, of any length, one row for each, as long as their features together are no more than
`FEATURES`. These hashed features are all that reaches the driver. Every text is scored whole, whatever its length.

Nulls: null and empty texts have no sentence and score 0. A null doc_id is scored and
never matches a label; null labels are ignored, and of several labels of a document the
largest counts. Repeated rows score alike. Further columns are left alone. Without labels of
both kinds every score is 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType
from lotewise.session import keep

PER_LABEL = 2000
#: Hashed features of the sample, for each label; a document that would go beyond is not trained on.
FEATURES = 12_000_000
BITS = 18
#: So many times the evidence of clean documents' sentences is taken off the sum over a document's.
CALM = 2.0
#: What a document is toxic by without any sign, in training alone; spread over the sentences it sets their constant.
LEAK = 0.1
#: From this probability on a document counts as toxic; a sentence from a half on.
TOXIC = 0.7
SENTENCE = 0.5

_SENTENCES = re.compile(r"[^.!?\n]+")
_EDGES = ".,;:!?\"'()[]*-_"


def features(word: str) -> list[int]:
    """Hashed features of a lower-case word."""
    bare = word.strip(_EDGES) or word
    names = [bare, *(f"{bare[:n]}*" for n in (4, 5) if len(bare) > n)]
    return [crc32(n.encode("utf-8", "surrogatepass")) >> (32 - BITS) for n in names]


def sentences(text: str) -> list[tuple[int, int]]:
    """Stretches without an end mark or line end that hold more than white space."""
    return [m.span() for m in _SENTENCES.finditer(text) if not m.group().isspace()]


def sample(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> list:
    """(toxic, features of all sentences, features in each sentence, weight) of the sampled
    documents, the features as packed 32-bit integers.

    Ids are picked from the labels alone, at most `per_label` for each, so the ids that are
    sent to the documents have a fixed bound and no text is shuffled."""
    known = labels.filter("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = None
    for toxic in (0, 1):
        part = known.filter(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label)
        picked = part if picked is None else picked.unionByName(part)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, sizes = [], []
            for text in batch.column(1).to_pylist():
                low = text.lower()
                bags = [sorted({f for w in low[a:b].split() for f in features(w)}) for a, b in sentences(low)]
                flat.append(np.array([f for bag in bags for f in bag], np.int32).tobytes())
                sizes.append(np.array([len(bag) for bag in bags], np.int32).tobytes())
            columns = [batch.column(0), batch.column(2), pa.array(flat, pa.binary()), pa.array(sizes, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "toxic", "flat", "sizes"])

    of_both = docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(picked), "doc_id").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("toxic").cast("int").alias("toxic")
    )
    bags = of_both.mapInArrow(hashed, "doc_id long, toxic int, flat binary, sizes binary")
    one_each = bags.groupBy("doc_id", "toxic").agg(F.min(F.struct("flat", "sizes")).alias("b")).filter("length(b.sizes) > 0")
    upto = W.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(W.unboundedPreceding, 0)
    within = keep(one_each, "sampled").withColumn("total", F.sum(F.length("b.flat") / 4).over(upto))
    rows = within.filter(F.col("total") <= FEATURES).select("toxic", "b.flat", "b.sizes").toArrow().to_pylist()
    got = Counter(r["toxic"] for r in rows)
    return [
        (r["toxic"], np.frombuffer(r["flat"], np.int32), np.frombuffer(r["sizes"], np.int32), counts[r["toxic"]] / got[r["toxic"]])
        for r in rows
    ]


def train(rows: list, least: int = 5, rounds: int = 60, cost: float = 0.2) -> np.ndarray:
    """Weights of the features and, last, the constant and the evidence of a sentence of clean documents.

    Only signs of toxicity get a weight: it is never negative, each unit of it costs
    `cost`, and a feature must stand in `least` toxic documents, twice as densely as in
    clean ones. So the many rare words of a small sample cannot be learnt by heart. All
    rows take part in each round; a step is scaled by how common its feature is."""
    if {t for t, *_ in rows} != {0, 1}:
        return np.append(np.zeros(1 << BITS), [-np.inf, 0.0])
    toxic = np.array([t for t, *_ in rows])
    weight = np.array([x for *_, x in rows])
    of_doc = np.repeat(np.arange(len(rows), dtype=np.int32), [len(sizes) for _, _, sizes, _ in rows])
    count = len(of_doc)
    of_bag = np.repeat(np.arange(count, dtype=np.int32), np.concatenate([sizes for _, _, sizes, _ in rows]))
    feature = np.concatenate([flat for _, flat, _, _ in rows])

    once = np.unique((of_doc[of_bag].astype(np.int64) << BITS) | feature)
    doc, f = once >> BITS, once & ((1 << BITS) - 1)
    seen = np.bincount(f, toxic[doc] * 1.0, 1 << BITS)
    clean_seen = np.bincount(f, (1 - toxic[doc]) * weight[doc], 1 << BITS)
    share, clean_share = seen / toxic.sum(), clean_seen / (weight * (1 - toxic)).sum()
    used = np.flatnonzero((seen >= least) & (share > 2 * clean_share))
    place = np.full(1 << BITS, -1)
    place[used] = np.arange(len(used))
    known = place[feature] >= 0
    feature, of_bag = place[feature[known]], of_bag[known]

    w = np.zeros(len(used))
    constant = math.log(LEAK * len(rows) / count)
    rest = 1 / (1 + math.exp(-constant))
    for _ in range(rounds):
        z = constant + np.bincount(of_bag, w[feature], count)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        clean = (1 - LEAK) * np.exp(np.bincount(of_doc, np.log1p(-np.minimum(p, 1 - 1e-9)) - math.log1p(-rest), len(rows)))
        # of the noisy-or: a toxic document pulls its likeliest sentences up, a clean one pushes all down
        pull = np.where(toxic == 1, -clean / np.maximum(1 - clean, 1e-9), 1.0) * weight
        slope = pull[of_doc] * p
        grad = np.bincount(feature, slope[of_bag], len(used)) + cost
        w = np.maximum(0, w - grad / (0.1 * seen[used] + 5))
    evidence = np.logaddexp(0, constant + np.bincount(of_bag, w[feature], count)) - np.logaddexp(0, constant)
    quiet = np.where(toxic == 0, weight, 0.0)[of_doc]
    full = np.zeros((1 << BITS) + 2)
    full[used], full[-2:] = w, (constant, (quiet * evidence).sum() / quiet.sum())
    return full


class Scorer:
    """Scores whole texts; what a word adds is worked out once and kept, within a bound."""

    KEPT = 1 << 20

    def __init__(self, weights: np.ndarray) -> None:
        self.constant, self.usual = float(weights[-2]), float(weights[-1])
        self.rest = math.log1p(math.exp(self.constant))

        class Added(dict):
            def __missing__(self, word: str) -> float:
                if len(self) >= Scorer.KEPT:
                    self.clear()
                self[word] = value = float(sum(weights[f] for f in features(word)))
                return value

        self.added = Added()

    def __call__(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """The probability that a text is toxic, and its toxic sentences (start, end, p)."""
        low = text.lower()
        if len(low) != len(text):  # a letter that grows in lower case would shift places
            low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
        most, total, found, added = 0.0, 0.0, [], self.added
        for a, b in sentences(low):
            total -= CALM * self.usual
            signs = sum(added[w] for w in set(low[a:b].split()))
            if not signs:
                continue
            z = self.constant + signs
            evidence = (math.log1p(math.exp(z)) if z < 30 else z) - self.rest
            most, total = max(most, evidence), total + evidence
            if z >= 0:
                found.append((a, b, 1 / (1 + math.exp(-z))))
        return -math.expm1(-max(most, total)), found


SCORED = StructType(
    [
        StructField("score", DoubleType()),
        StructField(
            "toxic_sentences",
            ArrayType(
                StructType(
                    [StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("p", DoubleType())]
                )
            ),
        ),
    ]
)


def scored(text: Column, weights: np.ndarray) -> Column:
    """Struct (score, toxic_sentences) of a text."""
    slim = weights.astype(np.float32)

    def score(texts: pa.Array) -> pa.Array:
        scorer = Scorer(slim)
        rows = [scorer(t.as_py() or "") for t in texts]
        found = [[{"start": a, "end": b, "p": p} for a, b, p in f] for _, f in rows]
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
        return pa.StructArray.from_arrays(
            [pa.array([p for p, _ in rows], pa.float64()), pa.array(found, kind)], names=["score", "toxic_sentences"]
        )

    return F.arrow_udf(score, SCORED)(text)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score, predicted, toxic_sentences) for each of `docs`, learned from `labels`."""
    weights = train(sample(docs, labels))
    return docs.select("doc_id", scored(F.col("text"), weights).alias("s")).select(
        "doc_id", "s.score", (F.col("s.score") >= TOXIC).cast("int").alias("predicted"), "s.toxic_sentences"
    )

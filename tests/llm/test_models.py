from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lotewise.llm import lm_scoring, sentencepiece_codec, toxicity
from lotewise.llm.common import bucket_of
from tests.llm.helpers import ODD, documents, prose


def test_language_model_base(spark):
    table = ODD + [(100 + i, prose(i % 30, 60 + i)) for i in range(60)] + [(900, "Unknownword zzz\x1cqq É")]
    held = F.coalesce(F.col("doc_id") % 5 == 0, F.lit(False))
    got = lm_scoring.score_texts(documents(spark, table), held).collect()
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    tokens = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", low(t)), ""]
    seen = Counter(w for d, t in table if d is None or d % 5 for w in tokens(t))
    n, v = sum(seen.values()), len(seen)
    want = []
    for d, t in table:
        base = sum(math.log10((seen[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t))
        want.append((d, d is not None and d % 5 == 0, len(tokens(t)), sum(w in seen for w in tokens(t)), n, round(base, 6)))
    found = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert all(r.score < 0 for r in got)
    prose_rows = [r for r in got if r.held_out and r.doc_id and r.doc_id >= 100 and r.doc_id != 900]
    assert sum(r.score for r in prose_rows) > sum(r.base_score for r in prose_rows)
    assert lm_scoring.score_texts(documents(spark, []), held).count() == 0


def test_probabilities_add_up_to_one():
    words = [lm_scoring.END, b"the", b"of", b"river"]
    codes = [lm_scoring.huffman([9, 7, 5, 2, 3]), lm_scoring.huffman([1 + i % 7 for i in range(257)])]
    coder = lm_scoring.Coder(words, codes)
    pairs = np.array([[0, 1, 2, 6, 8], [5, 9, 4, 3, 2]])
    of_words = lm_scoring._word_model(coder, pairs, pairs[:, :2])
    even = [np.full(1 << p, 2048 << 4, np.uint16) for p in lm_scoring.SIZES]
    scorer = lm_scoring.Scorer([words, codes], of_words, (even, lm_scoring.Mixer(3)))
    for state in range(3):
        cost = scorer.tokens(np.full(5, state), np.arange(5))
        assert abs(np.exp(cost).sum() - 1) < 1e-5
    # after any prefix, the next byte and the end of the word share all of the probability
    spelled = sum(math.exp(scorer.spelled([bytes([b])])[0]) for b in range(256))
    assert spelled < 1


def test_toxicity(spark):
    rude = ["idiot", "scum", "clown"]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        text = prose(i, 48)
        if toxic:
            sentences = text.split(". ")
            sentences.insert(i % 4 + 1, f"You are such a {rude[i % 3]} today")
            text = ". ".join(sentences)
        rows.append((i, text))
        labels.append((i, int(toxic)))
    held = F.coalesce(bucket_of(F.col("doc_id"), 3) == 1, F.lit(False))
    marks = spark.createDataFrame([*labels, (5, None), (None, 1)], "doc_id long, toxic int")
    got = {
        r.doc_id: r for r in toxicity.score_documents(documents(spark, rows), marks.filter(~held)).collect()
    }
    for i, text in rows:
        assert got[i].predicted == int(i % 4 == 0), (i, got[i])
        for s in got[i].toxic_sentences:
            assert any(w in text[s.start : s.end] for w in rude)
    odd = toxicity.score_documents(documents(spark, ODD), marks).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)
    none = toxicity.score_documents(documents(spark, ODD), marks.filter("toxic = 1")).collect()
    assert {r.score for r in none} == {0.0}
    assert toxicity.score_documents(documents(spark, []), marks).count() == 0
    assert toxicity.sample(documents(spark, rows + rows), marks)[0][0] in (0, 1)
    assert len(toxicity.sample(documents(spark, rows + rows), marks)) == len(rows)  # one row of an id
    # clean texts joined to any length stay clean, one toxic sentence inside still tells
    clean = " ".join(t for i, t in rows if i % 4 and got[i].score < 0.7)
    joined = [(k, " ".join([clean] * k)) for k in (1, 10, 12)] + [(99, " ".join([clean] * 3) + " You are such a scum today. " + clean)]
    assert len(joined[2][1]) > 1_000_000
    weights = toxicity.train(toxicity.sample(documents(spark, rows), marks.filter(~held)))
    scored = documents(spark, joined).select("doc_id", toxicity.scored(F.col("text"), weights).alias("s")).collect()
    long = {r.doc_id: r.s for r in scored}
    assert [long[k].score >= toxicity.TOXIC for k in (1, 10, 12, 99)] == [False, False, False, True]
    assert len(long[99].toxic_sentences) == 1


def test_toxicity_of_a_text_by_hand():
    """Noisy-or over sentences, measured from a sentence without signs, against plain arithmetic."""
    weights = np.zeros((1 << toxicity.BITS) + 2)
    weights[toxicity.features("scum")[0]], weights[toxicity.features("rat")[0]] = 6.0, 3.0
    weights[-2:] = -5.0, 0.001
    scorer = toxicity.Scorer(weights)
    sigmoid = lambda z: 1 / (1 + math.exp(-z))
    p = lambda z: 1 - (1 - sigmoid(z)) / (1 - sigmoid(-5.0))
    assert scorer("nothing here. nor here.") == (0.0, [])
    score, found = scorer("You scum! A rat. So.")
    off = math.exp(3 * 0.001 * toxicity.CALM)
    assert math.isclose(score, 1 - (1 - p(1.0)) * (1 - p(-2.0)) * off, rel_tol=1e-9)
    assert [(a, b) for a, b, _ in found] == [(0, 8)] and math.isclose(found[0][2], sigmoid(1.0))
    assert math.isclose(scorer("scum. " + "so. " * 5000)[0], p(1.0))  # never below the strongest sentence


def test_sentencepiece_round_trip(spark):
    odd = ["", " ", "  two  spaces ", "tab\tline\n", "É über 数学 😀", "x" * 3000, "a" * 17 + " b", "<s> <unk>", "\x00nul"]
    rows = ODD + [(100 + i, t) for i, t in enumerate(odd)] + [(200 + i, prose(i, 80)) for i in range(20)]
    got = sentencepiece_codec.round_trip(documents(spark, rows)).collect()
    assert len(got) == len(rows) and all(r.exact for r in got)
    assert {r.doc_id: r.ids for r in got}[1] is None
    assert {r.doc_id: r.ids for r in got}[2] == []
    coded = documents(spark, rows).withColumn("ids", sentencepiece_codec.encode(F.col("text")))
    back = coded.withColumn("back", sentencepiece_codec.decode(F.col("ids"))).collect()
    assert all(r.back == r.text for r in back)
    assert sorted((r.doc_id or 0, r.ids or []) for r in back) == sorted((r.doc_id or 0, r.ids or []) for r in got)
    assert sentencepiece_codec.round_trip(documents(spark, [])).count() == 0


def test_segmentation_has_the_highest_score():
    pieces = sentencepiece_codec.Pieces(sentencepiece_codec.default_model())
    scores = {}
    for keys, ids, values in pieces.by_size.values():
        scores |= {pieces.text[i]: float(s) for i, s in zip(ids.tolist(), values)}

    def best(word):
        table = [0.0] + [-math.inf] * len(word)
        for e in range(1, len(word) + 1):
            table[e] = table[e - 1] + pieces.spelled
            for b in range(max(0, e - 16), e):
                if word[b:e] in scores:
                    table[e] = max(table[e], table[b] + scores[word[b:e]])
        return table[-1]

    by_size: dict[int, list[str]] = {}
    for w in {sentencepiece_codec.SPACE + w for w in prose(3, 400).split()} | {"▁Êx", "▁▁▁", "▁数学"}:
        by_size.setdefault(len(w), []).append(w)
    for words in by_size.values():
        for word, ids in zip(words, pieces.segment(words)):
            total, spelled = 0.0, b""
            for i in np.frombuffer(ids, np.int32).tolist():
                if i in pieces.text:
                    total += scores[pieces.text[i]]
                else:
                    spelled += pieces.bytes_of[i]
            total += pieces.spelled * len(spelled.decode())
            assert abs(total - best(word)) < 1e-6, word


def test_long_words_are_cut_exactly():
    """Words without spaces: cut where no piece reaches over, or walked alone, as the batched walk has it."""
    pieces = sentencepiece_codec.Pieces(sentencepiece_codec.default_model())
    scores = {i: s for _, ids, values in pieces.by_size.values() for i, s in zip(ids.tolist(), values.tolist())}
    total = lambda ids: sum(scores.get(i, 0.0) for i in np.frombuffer(ids, np.int32).tolist())
    rng = np.random.default_rng(4)
    for trial in range(20):
        letters = list("etaoinsh中é") if trial % 2 else ["ab", "the", "=-"]
        word = "".join(rng.choice(letters, 600))[:600]
        whole, cut = pieces.segment([word])[0], pieces.segment_long(word)
        assert pieces._walked(word) == whole
        # sums of parts are rounded apart, so of two equally good segmentations either may come out
        assert math.isclose(total(cut), total(whole), rel_tol=1e-12)
        assert pieces.decode(np.frombuffer(cut, np.int32).tolist()) == word


def test_signs_and_text_without_spaces_come_back(spark):
    rows = [(1, "a▁b"), (2, "▁"), (3, " ▁▁ x ▁"), (4, "中文字" * 100_000), (5, "a" * 300_000), (6, "x▁" * 2000)]
    got = sentencepiece_codec.round_trip(documents(spark, rows)).collect()
    assert len(got) == len(rows) and all(r.exact for r in got)
    pieces = sentencepiece_codec.Pieces(sentencepiece_codec.default_model())
    assert {r.doc_id: pieces.decode(r.ids) for r in got} == dict(rows)


def test_long_texts_are_worked_through_few_at_once():
    """256 texts of 20,000 words used to be cut into tokens together, whatever their bytes."""
    texts = ["word " * 20_000, None, "a b", *["word " * 20_000] * 12]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    parts = list(lm_scoring._texts(iter([batch]), 0))
    assert sum((part.column(0).to_pylist() for _, part in parts), []) == texts
    assert max(part.nbytes for _, part in parts) <= lm_scoring.SLICE_BYTES + 1000
    assert list(lm_scoring._portions([9, 1, 1, 1, 1], 3, 5)) == [(0, 1), (1, 4), (4, 5)]
    assert list(lm_scoring._portions([], 3, 5)) == []


def test_counters_of_the_words_before_by_hand():
    """Only the last very frequent token used to be a context of words."""
    rng = np.random.default_rng(3)
    code = lm_scoring.huffman([40, 20, 9, 9, 5, 2, 1])
    n = 400
    contexts = lm_scoring.Contexts(code, np.full(16 * 7, 2048 << 4, np.uint16), np.ones(6, np.int64))
    both, ids, times = rng.integers(0, 30, n), rng.integers(0, 7, n), rng.integers(0, 400, n)
    order = np.lexsort((contexts.leaf[ids], both))
    both, ids, times = both[order], ids[order], times[order]
    new = np.concatenate(([True], both[1:] != both[:-1]))
    paths = [code[2][code[0][i] : code[1][i]].tolist() for i in range(7)]
    seen = 0
    for step, (live, bits, stored) in enumerate(contexts.counters(new, ids, times)):
        for at, bit, got in zip(live.tolist(), bits.tolist(), stored.tolist()):
            path = paths[ids[at]]
            assert bit == path[step] & 1
            same = [j for j in range(n) if both[j] == both[at] and paths[ids[j]][:step] == path[:step]]
            ones = sum(int(times[j]) for j in same if paths[ids[j]][step] & 1)
            zeros = sum(int(times[j]) for j in same) - ones
            assert got == lm_scoring.squeezed(np.array([zeros]), np.array([ones]))[0]
            seen += 1
    assert seen == sum(len(paths[i]) for i in ids)


def test_words_before_and_words_outside_the_vocabulary_count(spark, monkeypatch):
    """The word before told nothing, and a word outside the vocabulary forgot how often it was seen."""
    monkeypatch.setattr(lm_scoring, "VOCABULARY", 40)
    rng = np.random.default_rng(5)
    # each word tells the next one; 30 words in no order are more frequent than the others
    follows = {i: int(j) for i, j in enumerate(rng.permutation(40))}
    rows = []
    for d in range(1500):
        at, words = int(rng.integers(0, 40)), []
        for _ in range(20):
            words.append(f"w{at}")
            at = follows[at]
        rows.append((d, " ".join(words)))
    rows += [(2000 + d, "seldom") for d in range(2)] + [(3000 + d, "oftener") for d in range(200)]
    got = {r.doc_id: r for r in lm_scoring.score_texts(documents(spark, rows), F.col("doc_id") % 5 == 0).collect()}
    held = [r for r in got.values() if r.held_out and r.doc_id < 2000]
    gain = sum(r.score - r.base_score for r in held) / sum(r.n_tokens for r in held)
    assert gain > 0.4
    assert got[3000].score > got[2000].score + 1

from __future__ import annotations

import random
import re
from collections import Counter

from lotewise.llm import quality, weak
from tests.llm.helpers import ODD, documents, prose


def measured(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    marked = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(words) < 50 or 100 * len(marked) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(marked), failed


def bad(i, text):
    words = text.split()
    kinds = [
        " ".join(w.upper() + "!!" for w in words),
        " ".join(w + random.Random(i).choice(["%%%", "&&&", "###"]) for w in words),
        " ".join(w for w in words[:8] for _ in range(12)),
        " | ".join(words),
    ]
    return kinds[i % 4]


def test_measures(spark):
    rng = random.Random(2)
    table = ODD + [(100 + i, " ".join(rng.choice("abcd") for _ in range(n))) for i, n in enumerate((0, 1, 2, 3, 4, 5, 9, 40))]
    table += [(200, "x\ny\nx\n\n \nx"), (201, "a b c a b c a"), (202, "é𝒳 # <b>\x0b\x0c|")]
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = quality.digest(quality.judged(documents(spark, table).select("doc_id", "text")))
    want = sorted(((d, *measured(t)) for d, t in table), key=repr)
    assert sorted((tuple(r) for r in got.select("doc_id", *columns).collect()), key=repr) == want
    assert got.filter("base_failed and kept").count() == 0
    assert quality.judged(documents(spark, [])).count() == 0


def test_bad_documents_go_and_clean_ones_stay(spark):
    good = [(i, prose(i, 120)) for i in range(400)]
    poor = [(1000 + i, bad(i, prose(i, 120))) for i in range(60)]
    docs = documents(spark, good + poor + ODD)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert {i for i, _ in good} <= ids
    assert not ids & {i for i, _ in poor}


def test_estimated_accuracies():
    rng = random.Random(4)
    rows = Counter()
    for _ in range(4000):
        truth = 1 if rng.random() < 0.7 else -1
        rows[tuple(0 if rng.random() < 0.2 else truth if rng.random() < p else -truth for p in (0.95, 0.9, 0.85, 0.5))] += 1
    model = weak.estimate(sorted(rows.items()), 4, prior=0.6)
    assert model.when_yes[0] > model.when_yes[1] > model.when_yes[2] > 1
    assert abs(model.when_yes[3]) < 0.4
    assert weak.estimate([], 4).log_odds((1, 1, 0, -1)) > 0

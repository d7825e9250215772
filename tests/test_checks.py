import random

import pytest
from pyspark.sql import functions as F

from lotewise.operators.audit import accuracy_by_field, reconcile
from lotewise.operators.checks import (
    canary_sample,
    field_checks,
    foreign_labels,
    foreign_text,
    random_sample,
    verdict,
)
from lotewise.operators.load import Check, check_table
from lotewise.operators.quality import quality_of_table


def test_problems_per_report(spark, rows):
    df = spark.createDataFrame([("a", None, 5), ("b", "x", None), ("c", "x", -1)], "k string, t string, n int")
    got = field_checks(df, "k", {"empty": F.col("t").isNull(), "absurd": F.col("n") < 0})
    assert rows(got) == [("a", "empty"), ("c", "absurd")]


def test_foreign_text_against_brute_force(spark, rows):
    rng = random.Random(2)
    vocabulary = ["casa", "rua", "bairro", "cep", "área", "padrão", "x", "ab", "abc", "N°", "valor"]
    gap = [" ", "  ", "\n", "\t"]

    def text(n):
        return "".join(rng.choice(vocabulary) + rng.choice(gap if rng.random() < 0.3 else [" "]) for _ in range(n))

    texts = [(i, text(rng.randrange(0, 40))) for i in range(150)] + [(900, None), (901, "")]
    labels = [(0, "casa"), (1, "ab"), (2, "rua bairro"), (3, "casa rua x"), (4, "asa rua bai"), (5, "a"), (6, " "), (7, None), (8, "cep área padrão x"), (9, "valor\nN°"), (10, "zzz"), (11, "ua\tx"), (12, "bairro")]
    labels += [(20 + i, texts[i][1][3:25]) for i in range(40)]
    got = foreign_text(
        spark.createDataFrame(texts, "k int, t string").repartition(3), "k", "t",
        spark.createDataFrame(labels, "lk int, label string"), "lk", "label",
    )
    expected = [(k, lk) for k, t in texts for lk, label in labels if t and label and label.strip() and label in t]
    assert rows(got) == sorted(expected, key=repr)
    assert len(expected) > 100


def test_foreign_text_makes_no_cross_join(spark):
    texts = spark.createDataFrame([(1, "a b c")], "k int, t string")
    labels = spark.createDataFrame([(1, "a b c"), (2, "b")], "lk int, label string")
    plan = foreign_text(texts, "k", "t", labels, "lk", "label")._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_samples_repeat_and_do_not_overlap(spark, rows):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 37).alias("day"))
    sample = canary_sample(df, "k", "day")
    assert sample.count() == 60 == sample.select("k").distinct().count()
    assert {r.day for r in sample.filter("draw = 'recent'").collect()} == {36}
    assert rows(sample) == rows(canary_sample(df.repartition(7), "k", "day"))
    assert random_sample(df, "k", 500).count() == 500
    assert random_sample(df, "k", None).count() == 1000
    assert rows(random_sample(df, "k", 5, seed=1)) != rows(random_sample(df, "k", 5, seed=2))
    assert canary_sample(df.limit(10), "k", "day").count() == 10


@pytest.mark.parametrize("limit, expected", [(0.5, ("may run", 0, 1)), (0.4, ("do not run yet", 1, 1))])
def test_verdict(spark, limit, expected):
    df = spark.range(10)
    checks = check_table(df, [Check("odd", F.col("id") % 2 == 1, limit)])
    assert tuple(verdict(checks).head()) == expected


def test_three_outcomes(spark, rows):
    stored = spark.createDataFrame([("1", 10.0, "Alto"), ("2", 10.0, "alto "), ("3", 10.0, "x"), ("4", None, None), ("5", 1.0, "a")], "k string, n double, t string")
    printed = spark.createDataFrame([("1", 10.0, "Alto"), ("2", 10.0, "alto"), ("3", 12.0, "x"), ("4", 4.0, "y")], "k string, n double, t string")
    second = spark.createDataFrame(
        [("1", "b", 99.0, None), ("1", "a", 10.005, "ALTO"), ("2", "a", None, "Álto"), ("2", "b", 11.0, "no"), ("3", "b", 11.0, "Y"), ("4", "a", 4.0, None), ("3", "unknown", 10.0, "x")],
        "k string, source string, n double, t string",
    )
    got = reconcile(stored, printed, second, ["k"], {"n": "number", "t": "text"}, ["a", "b"])
    assert rows(got, "k", "field", "source", "outcome") == [
        ("1", "n", "a", "match"),
        ("1", "t", "a", "match"),
        ("2", "n", "b", "inconsistent report"),
        ("2", "t", "a", "match"),
        ("3", "n", "b", "extraction error"),
        ("3", "t", "b", "inconsistent report"),
        ("4", "n", "a", "extraction error"),
    ]
    assert rows(accuracy_by_field(got)) == [("n", 4, 1, 1, 2, 0.5), ("t", 3, 2, 1, 0, 1.0)]
    with pytest.raises(ValueError):
        reconcile(stored, printed, second, ["k"], {"n": "date"}, ["a"])


def test_a_common_word_brings_no_text_and_label_together(spark, rows):
    from lotewise.operators.checks import foreign_text

    texts = [(str(i), f"start with apartment number {i} here") for i in range(200)]
    texts.append(("hit", "see also apartment river seven close by"))
    labels = [(str(i), f"the apartment odd{i} end") for i in range(50)] + [("l", "also apartment river seven close")]
    found = foreign_text(
        spark.createDataFrame(texts, "k string, v string"), "k", "v",
        spark.createDataFrame(labels, "lk string, label string"), "lk", "label",
    )
    assert rows(found, "k", "lk") == [("hit", "l")]
    found.collect()


def test_labels_of_other_columns(spark, rows):
    df = spark.createDataFrame(
        [("a", "Casa de vila", "Padrão Alto"), ("b", "Idade: 10 anos", "normal"), ("c", None, "IDADE do imóvel")],
        "k string, tipo string, padrao string",
    )
    labels = spark.createDataFrame([("Padrão", "padrao"), ("Idade", "idade"), ("Tipo", "tipo")], "label string, field string")
    assert rows(foreign_labels(df, "k", ["tipo", "padrao"], labels)) == [("b", "tipo", "Idade"), ("c", "padrao", "Idade")]


def test_words_are_cut_once_and_not_shuffled(spark):
    """With few labels the only shuffles are those of the small index."""
    texts = spark.range(200).selectExpr("id as k", "concat('x', id, ' one two three ', id) as t")
    labels = spark.createDataFrame([(1, "x1 one two"), (2, "three")], "lk int, label string")
    found = foreign_text(texts, "k", "t", labels, "lk", "label")
    assert found.count() == 200 + 1
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 200") == 1  # the index is kept: texts are read again for the containment only


def test_quality_of_a_table_in_one_reading(spark, rows):
    table = spark.createDataFrame([(str(i), "a", 10.0 + i % 3) for i in range(30)] + [("99", "a", 500.0), ("98", " ", 0.0)], "k string, t string, v double")
    got = quality_of_table(table, ["k"], {"low": F.col("v") < 1, "never": F.col("v") < -1}, {"v": ["t"]})
    assert rows(got.filter("section <> 'empty'"), "section", "check", "key", "value") == [
        ("incoherent", "low", "98", None), ("outlier", "v a", "99", "500.0"), ("rule", "low", "rows", "1"), ("rule", "never", "rows", "0")
    ]
    assert rows(got.filter("section = 'empty' and value <> '0'"), "check", "key", "value") == [("t", "empty", "1"), ("v", "zero", "1")]

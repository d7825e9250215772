import random

import pytest
from pyspark.sql import functions as F

from lotewise.operators.load import (
    BatchRejected,
    Check,
    check_table,
    gate,
    key_integrity,
    move_column,
    replace_children,
    rewrite_verified,
    rows_with_parent,
    same_content,
    staged_gate,
    upsert,
)
from lotewise.session import shared_dir
from lotewise.sources import snapshot
from lotewise.sources.catalog import publish_tables
from lotewise.sources.files import report_files

SCHEMA = "codigo_laudo string, numero_amostra int, at int, v double"


def random_rows(seed, n=200):
    rng = random.Random(seed)
    return [(f"r{rng.randrange(12)}", rng.randrange(4), rng.randrange(5), rng.choice([None, 1.0, 2.0])) for _ in range(n)]


KEYS = ["codigo_laudo", "numero_amostra"]


def test_upsert_is_idempotent_and_keys_are_unique(spark, rows):
    target = upsert(spark.createDataFrame([], SCHEMA), spark.createDataFrame(random_rows(1), SCHEMA), KEYS, ["at"])
    updates = spark.createDataFrame(random_rows(2), SCHEMA)
    once = upsert(target, updates, KEYS, ["at"])
    assert rows(upsert(once, updates, KEYS, ["at"])) == rows(once)
    assert once.groupBy(*KEYS).count().filter("count > 1").count() == 0
    best = {}
    for r in [*target.collect(), *updates.collect()]:
        k, rank = (r[0], r[1]), (r[2], -1 if r[3] is None else r[3])
        best[k] = max(best.get(k, (-1, -1)), rank)
    assert {(r[0], r[1]): (r[2], -1 if r[3] is None else r[3]) for r in once.collect()} == best


def test_without_an_order_the_update_wins(spark, rows):
    target = spark.createDataFrame([("a", 1, 9, 9.0), ("b", 1, 9, 9.0)], SCHEMA)
    updates = spark.createDataFrame([("a", 1, 1, None)], SCHEMA)
    assert rows(upsert(target, updates, KEYS)) == [("a", 1, 1, None), ("b", 1, 9, 9.0)]


@pytest.mark.parametrize("order_by", [(), ("at",)])
def test_a_stored_table_is_upserted_alike(spark, rows, order_by):
    target = upsert(spark.createDataFrame([], SCHEMA), spark.createDataFrame(random_rows(3), SCHEMA), KEYS, ["at"])
    updates = spark.createDataFrame([r for r in random_rows(4) if r[0] in ("r1", "r2", "r99")] + [("new", 1, 1, 1.0)], SCHEMA)
    assert rows(upsert(target, updates, KEYS, order_by, unique_target=True)) == rows(upsert(target, updates, KEYS, order_by))


def test_children_of_a_report_read_again(spark, rows):
    target = spark.createDataFrame([("a", 1, 0, 1.0), ("a", 2, 0, 1.0), ("b", 1, 0, 1.0), ("c", 1, 0, 1.0)], SCHEMA)
    updates = spark.createDataFrame([("a", 1, 0, 5.0)], SCHEMA)
    parents = spark.createDataFrame([("a",), ("c",)], "codigo_laudo string")
    assert rows(replace_children(target, updates, parents, "codigo_laudo", KEYS)) == [("a", 1, 0, 5.0), ("b", 1, 0, 1.0)]


def addresses(spark, missing):
    return spark.createDataFrame([(i, None if i < missing else "Rua A") for i in range(10)], "k int, rua string")


def no_address(limit=0.05):
    return [Check("no address", F.col("rua").isNull(), limit)]


def test_gate_rejects_the_whole_batch(spark):
    with pytest.raises(BatchRejected) as refused:
        gate(addresses(spark, 1), no_address())
    assert refused.value.report[0]["n_bad"] == 1
    assert "no address" in str(refused.value) and "Rua A" not in str(refused.value)


def test_gate_passes_within_the_limit_when_empty_or_overridden(spark):
    assert gate(addresses(spark, 1), no_address(0.1))[0]["ok"]
    assert gate(addresses(spark, 0).limit(0), no_address())[0]["share"] == 0.0
    assert not gate(addresses(spark, 1), no_address(), ignore=True)[0]["ok"]


def test_staged_gate_says_the_same(spark, rows):
    staged, report = staged_gate(addresses(spark, 1), no_address(0.1), shared_dir(spark, "t"))
    assert report == gate(addresses(spark, 1), no_address(0.1))
    assert rows(staged) == rows(addresses(spark, 1))
    with pytest.raises(BatchRejected):
        staged_gate(addresses(spark, 1), no_address(), shared_dir(spark, "t"))
    _, report = staged_gate(addresses(spark, 1).limit(0), no_address(), shared_dir(spark, "t"))
    assert report[0]["ok"]


def test_checks_per_lot(spark, rows):
    df = addresses(spark, 3).withColumn("lot", F.col("k") % 2)
    assert rows(check_table(df, no_address(0.3), ["lot"]), "lot", "n_rows", "n_bad", "ok") == [(0, 5, 2, False), (1, 5, 1, True)]


def test_key_problems(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("z", 1), ("z", 1)], "codigo_laudo string, numero_amostra int")
    reports = spark.createDataFrame([("a", "x")], "codigo_laudo string, tipo string")
    assert rows(key_integrity(df, KEYS, reports, "codigo_laudo")) == [("duplicate_key", 2, 4), ("orphan", 1, 2)]
    assert rows(key_integrity(df, KEYS)) == [("duplicate_key", 2, 4), ("orphan", 0, 0)]
    assert rows_with_parent(df, reports, "codigo_laudo").count() == 3


def test_same_content_counts_copies(spark):
    a = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    b = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "x string")
    assert tuple(same_content(a, b).head()) == (1, 1, False)
    assert tuple(same_content(a, a.orderBy("x")).head()) == (0, 0, True)
    assert tuple(same_content(a.limit(0), a.limit(0)).head()) == (0, 0, True)
    with pytest.raises(ValueError):
        same_content(a, b.withColumnRenamed("x", "y"))


def test_column_goes_after_its_anchor(spark, rows):
    assert move_column(["a", "b", "c"], "a", "b") == ["b", "a", "c"]
    assert move_column(["a", "b", "c"], "c", "a") == ["a", "c", "b"]
    for bad in (("x", "a"), ("a", "x"), ("a", "a")):
        with pytest.raises(ValueError):
            move_column(["a", "b"], *bad)
    df = spark.createDataFrame([(1, "x", 2.0)], "a int, b string, c double")
    moved = rewrite_verified(df, "a", "c", shared_dir(spark, "t"))
    assert moved.columns == ["b", "c", "a"] and rows(moved, "a", "b", "c") == rows(df)


def test_snapshot_commits_both_tables_together(spark, rows):
    path = shared_dir(spark, "t")
    reports = spark.createDataFrame([("a", "1"), ("b", "1")], "codigo_laudo string, tipo string")
    samples = spark.createDataFrame([("a", 1, 0, 1.0), ("a", 2, 0, 2.0), ("b", 1, 0, 1.0)], SCHEMA)
    keys = {"r": ["codigo_laudo"], "s": KEYS}

    def put(r, s, **more):
        return snapshot.load_batch(spark, path, {"r": r, "s": s}, keys, "codigo_laudo", buckets=8, **more)

    assert snapshot.read_table(spark, path, "r", reports.schema).count() == 0
    assert put(reports, samples) == 1
    again = spark.createDataFrame([("a", "2"), ("c", "2")], "codigo_laudo string, tipo string")
    fewer = spark.createDataFrame([("c", 1, 0, 3.0)], SCHEMA)
    # report a lost all its samples
    assert put(again, fewer, replaced={"s": again}) == 2
    assert rows(snapshot.read_table(spark, path, "r", reports.schema)) == [("a", "2"), ("b", "1"), ("c", "2")]
    assert rows(snapshot.read_table(spark, path, "s", samples.schema), *KEYS) == [("b", 1), ("c", 1)]
    assert put(reports.limit(0), samples.limit(0)) == 2
    # written but never committed: not seen
    reports.write.parquet(f"{path}/r/load=3/bucket=0")
    assert snapshot.read_table(spark, path, "r", reports.schema).count() == 3
    held = snapshot.current(spark, path)[1]["r"]
    assert 1 in held.values() and 2 in held.values()


def test_catalog_tables_are_bucketed_alike_and_analysed(spark, rows):
    reports = spark.createDataFrame([("a", ["x", "y"]), ("b", [])], "codigo_laudo string, servicos_publicos array<string>")
    samples = spark.createDataFrame([("a", 1, 0, 1.0)], SCHEMA)
    publish_tables(reports, samples, "t_publish", buckets=4)
    assert rows(spark.table("t_publish.laudos")) == [("a", "x;y"), ("b", "")]
    stats = spark.sql("describe extended t_publish.laudos").filter("col_name = 'Statistics'").head()
    assert "2 rows" in stats["data_type"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("t_publish.laudos").join(spark.table("t_publish.laudos_amostras"), "codigo_laudo")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_report_folder(spark, tmp_path, rows):
    (tmp_path / "sub").mkdir()
    for name in ("laudo_10.pdf", "sub/laudo_11.pdf", "notes.txt"):
        (tmp_path / name).write_bytes(b"abc")
    got = report_files(spark, str(tmp_path))
    assert rows(got, "codigo_laudo", "file_name", "length") == [("10", "laudo_10.pdf", 3), ("11", "laudo_11.pdf", 3)]
    hashed = report_files(spark, str(tmp_path), with_hash=True).head()
    assert hashed["sha256"] == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"

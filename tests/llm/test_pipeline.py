from __future__ import annotations

import corpus_pipeline
from lotewise.llm.queries import ORACLE, QUERIES
from tests.llm.helpers import ODD, prose

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def run_stages(spark, rows, tmp_path):
    path = str(tmp_path / "sf")
    full = [(d, t, "en", "src0", len(t) if t is not None else None) for d, t in rows]
    spark.createDataFrame(full, SCHEMA).write.parquet(f"{path}/documents.parquet")
    docs, after = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, docs, path).write.parquet(out)
        docs = spark.read.parquet(out)
        after[name] = docs
    return path, after


def test_each_stage_takes_effect(spark, tmp_path):
    clean = [(i, prose(i, 160)) for i in range(60)]
    copies = [(100 + i, clean[i][1]) for i in range(5)]
    near = [(200 + i, clean[i][1].replace("river", "stream", 1) + " Quite so.") for i in range(5, 8)]
    shouted = [(300 + i, clean[i][1].upper().replace(" ", "!! ")) for i in range(8)]
    private = [(400, prose(400, 160) + " Mail to jane.doe@mail.example.com or call +1 (543) 555-2415 now.")]
    path, after = run_stages(spark, clean + copies + near + shouted + private + ODD, tmp_path)
    ids = {name: {r.doc_id for r in docs.select("doc_id").collect()} for name, docs in after.items()}
    assert not ids["quality_rules"] & {d for d, _ in shouted}
    assert {d for d, _ in clean} <= ids["quality_rules"]
    texts = {r.doc_id: r.text for r in after["line_dedup"].collect()}
    assert texts[100] == "" and texts[0] == clean[0][1]
    assert {d for d, _ in clean} <= ids["near_duplicates"]
    assert len(ids["near_duplicates"] & {d for d, _ in copies}) <= 1
    masked = {r.doc_id: r for r in after["personal_data"].collect()}
    assert masked[400].text.endswith("Mail to [EMAIL] or call [PHONE] now.")
    assert masked[400].n_chars == len(masked[400].text)
    for name in list(after)[:-1]:
        assert after[name].columns == ["doc_id", "text", "lang", "source", "n_chars"]
    packed = after["packing"]
    assert {r.doc_id for r in packed.select("doc_id").collect()} == ids["personal_data"]
    assert corpus_pipeline.run(spark, path).count() == packed.count()


def test_an_empty_table_goes_through(spark, tmp_path):
    _, after = run_stages(spark, [], tmp_path)
    assert all(docs.count() == 0 for docs in after.values())


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)

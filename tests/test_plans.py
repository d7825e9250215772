from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lotewise.operators.audit import align_samples, reconcile_samples
from lotewise.operators.coordinates import geocode
from lotewise.operators.load import BatchRejected, Check
from lotewise.plans.audits import accuracy_audit, quick_test
from lotewise.plans.full_load import (
    extract,
    fill_coordinates,
    for_storage,
    load,
    plan_photos,
    run,
    stage,
    stored_tables,
    write_coordinates,
)
from lotewise.schemas import GAZETTEER, PHOTOS, WORDS
from lotewise.session import shared_dir
from lotewise.sources import snapshot
from lotewise.sources.ledger import read_ledger, write_entries

ADDRESS = "Rua A, 10, Centro - Recife/PE - CEP 50000-000"


def page(code, number, lines):
    """Lines of [(x, phrase)], 14 points apart, as positioned words."""
    out = []
    for i, phrases in enumerate(lines):
        for x, phrase in phrases:
            for word in phrase.split(" "):
                out.append((code, number, float(x), x + 5.0 * len(word), 50.0 + 14 * i, 60.0 + 14 * i, word))
                x += 5 * len(word) + 3
    return out


def cover(order_label, kind, form, address=ADDRESS, area="61.800"):
    form_line = [(0, "01 - Tipo do Imóvel Avaliado")] if form else [(0, "AVM")]
    return [
        [(0, "DADOS DO PEDIDO")],
        [(0, order_label), (200, "Tipo do Imóvel"), (400, "Data da Avaliação")],
        [(0, "1.234.567"), (200, kind), (400, "05/03/2025")],
        [(0, "Endereço")],
        [(0, address)],
        [(0, "Área Privativa"), (200, "Valor de Avaliação"), (400, "Coordenadas")],
        [(0, area), (200, "R$ 618.000,00"), (400, "-8,050000 / -34,900000" if form else "-")],
        form_line,
        [(0, kind if form else "-")],
    ]


def sample(heading, *pairs):
    return [[(0, heading)], *([(0, f"{label}: {value}")] for label, value in pairs)]


@pytest.fixture(scope="module")
def words(spark):
    data = page("1", 1, cover("N° do Pedido", "Apartamento", True))
    data += page("1", 2, sample("AMOSTRA 1", ("Área Privativa", "50,00"), ("Valor", "R$ 500.000,00")) + sample("AMOSTRA 2", ("Área Privativa", "60.000")))
    # the second sample goes on over the page
    data += page("1", 3, [[(0, "Valor: R$ 660.000,00")], [(0, "URL: https://x.example/1")]])
    data += page("2", 1, cover("N° da Proposta", "Casa", False))
    data += page("2", 2, sample("Amostra 0.0", ("Cidade", "Recife"), ("UF", "PE"), ("Valor", "R$ 1.000")) + sample("Amostra 1.0", ("Cidade", "Olinda")))
    data += page("3", 1, cover("N° do Pedido", "Múltiplas Unidades", True))
    data += page("3", 2, sample("AMOSTRA 1", ("Valor", "R$ 1.000")))
    data += page("4", 1, [[(0, "LAUDO ANTIGO VISTORIA")], [(0, "Matricula 998 area 70,5 fim")]])
    return spark.createDataFrame(data, WORDS)


LEGACY = {"fisico": {"matricula": r"Matricula (\d+)", "area_privativa": r"area ([\d.,]+)"}, "digital": {"matricula": r"M=(\d+)"}}


def test_words_become_typed_rows(spark, words, rows):
    read = extract(words, legacy=LEGACY)
    got = {r.codigo_laudo: r for r in read.reports.collect()}
    assert set(got) == {"1", "2", "4"}
    one = got["1"]
    assert (one.modelo, one.numero_pedido, one.tipo, one.data_avaliacao) == ("fisico", "1234567", "Apartamento", date(2025, 3, 5))
    assert (one.area_privativa, one.valor_avaliacao, one.valor_m2) == (Decimal("61.80"), Decimal("618000.00"), Decimal("10000.00"))
    assert (one.logradouro, one.numero, one.bairro, one.municipio, one.uf, one.cep) == ("Rua A", "10", "Centro", "Recife", "PE", "50000-000")
    assert (one.latitude, one.longitude, one.origem_coordenada) == (-8.05, -34.9, "laudo")
    assert (got["2"].modelo, got["2"].numero_pedido, got["2"].latitude, got["2"].origem_coordenada) == ("digital", "1234567", None, None)
    assert (got["4"].modelo, got["4"].matricula, got["4"].area_privativa) == ("legacy", "998", Decimal("70.50"))
    assert rows(read.excluded) == [("3",)]
    assert rows(read.samples, "codigo_laudo", "numero_amostra", "area_privativa", "valor", "valor_m2", "cidade", "url") == [
        ("1", 1, Decimal("50.00"), Decimal("500000.00"), Decimal("10000.00"), None, None),
        ("1", 2, Decimal("60.00"), Decimal("660000.00"), Decimal("11000.00"), None, "https://x.example/1"),
        ("2", 1, None, Decimal("1000.00"), None, "Recife", None),
        ("2", 2, None, None, None, "Olinda", None),
    ]
    failures = {r.field: (r.n_present, r.n_unparsed) for r in read.failures.collect()}
    assert failures["coordenadas"] == (3, 1) and failures["endereco"] == (3, 0)


def test_ticked_boxes_fill_the_lists(spark, words):
    options = spark.createDataFrame([("2", "servicos_publicos", ["Escola", "Ônibus"])], "codigo_laudo string, grupo string, opcoes array<string>")
    got = {r.codigo_laudo: r.servicos_publicos for r in extract(words, options).reports.collect()}
    assert got["2"] == ["Escola", "Ônibus"] and got["1"] is None


def test_boxes_on_the_pages_fill_the_lists(spark, words):
    """The heading opens on page 3, its boxes follow on page 4."""
    drawn = page("2", 3, [[(0, "Serviços Públicos")]]) + page("2", 4, [[(20, "Escola"), (120, "Ônibus")]])
    place = "codigo_laudo string, page int, x0 double, x1 double, top double, bottom double, fill_ratio double"
    boxes = spark.createDataFrame([("2", 4, 5.0, 13.0, 52.0, 60.0, 0.9), ("2", 4, 105.0, 113.0, 52.0, 60.0, 0.1)], place)
    read = extract(words.unionByName(spark.createDataFrame(drawn, WORDS)), boxes=boxes)
    assert {r.codigo_laudo: r.servicos_publicos for r in read.reports.collect()}["2"] == ["Escola"]


def few_without_value(limit):
    return lambda: [Check("no value", F.col("valor_avaliacao").isNull(), limit)]


def test_gate_then_both_tables_in_one_commit(spark, words, rows):
    path = shared_dir(spark, "t")
    batch = extract(words, legacy=LEGACY)
    schemas = [df.schema for df in for_storage(batch.reports, batch.samples)]
    with pytest.raises(BatchRejected):  # report 4 has no value
        load(spark, batch, path, few_without_value(0.1))
    assert snapshot.current(spark, path) == (0, {})
    assert load(spark, batch, path, few_without_value(0.5)) == 1
    reports, samples = stored_tables(spark, path, *schemas)
    assert (reports.count(), samples.count()) == (3, 4)
    # an apartment has no land; a physical sample no city; a digital one no URL
    assert rows(reports.filter("codigo_laudo = '1'"), "area_terreno", "servicos_publicos") == [(Decimal("0.00"), None)]
    assert rows(samples, "codigo_laudo", "numero_amostra", "cidade", "url") == [("1", 1, "", ""), ("1", 2, "", "https://x.example/1"), ("2", 1, "Recife", ""), ("2", 2, "Olinda", "")]
    # read again: rows are updated, not doubled, and a lost sample goes
    again = extract(words.filter("codigo_laudo <> '1' or page < 2"), legacy=LEGACY)
    assert load(spark, again, path, few_without_value(0.1), ignore=True) == 2
    reports, samples = stored_tables(spark, path, *schemas)
    assert (reports.count(), rows(samples, "codigo_laudo", "numero_amostra")) == (3, [("2", 1), ("2", 2)])


def test_photos_after_the_load(spark, rows):
    data = [
        ("1", 1, 1, 60.0, 60.0, 100.0, 100.0, None, "front", "jpg"),
        ("1", 4, 1, 30.0, 30.0, 100.0, 100.0, "Sala", "s1", "jpg"),
        ("1", 4, 2, 30.0, 30.0, 100.0, 100.0, "Sala de jantar", "s2", "jpg"),
        ("1", 5, 1, 30.0, 30.0, 100.0, 100.0, "Sala", "s1", "jpg"),
        ("1", 6, 1, 99.0, 99.0, 100.0, 100.0, None, "scan", "jpg"),
        ("2", 1, 1, 30.0, 30.0, 100.0, 100.0, "Fachada", "d1", "png"),
        ("2", 1, 2, 30.0, 30.0, 100.0, 100.0, "Quarto", "d2", "png"),
    ]
    photos = spark.createDataFrame(data, PHOTOS)
    models = spark.createDataFrame([("1", "fisico"), ("2", "digital")], "codigo_laudo string, modelo string")
    existing = spark.createDataFrame(
        [("1", "s1", "sala", "laudo_1_sala.jpg"), ("2", "d2", "quarto", "laudo_2_quarto.png"), ("9", "x", "sala", "laudo_9_sala.jpg")],
        "codigo_laudo string, sha256 string, label string, file_name string",
    )
    assert rows(plan_photos(photos, models, existing)) == [
        ("1", "front", "fachada", "add", "laudo_1_img.jpg"),
        ("1", "s1", "sala", "keep", "laudo_1_sala.jpg"),
        ("1", "s2", "sala", "add", "laudo_1_sala_2.jpg"),
        ("2", "d1", "fachada", "add", "laudo_2_img.png"),
        ("2", "d2", "quarto", "remove", "_removidas/laudo_2_quarto.png"),
    ]


def test_coordinates_after_the_load(spark, words):
    reports = extract(words, legacy=LEGACY).reports
    places = spark.createDataFrame([("PE", "Recife", "Rua A", "11", "50000-000", -8.1, -34.8)], GAZETTEER)
    empty = spark.createDataFrame([], "endereco_chave string, logradouro string, numero string, municipio string, uf string, cep string, lat double, lon double, origem string")
    filled, cache = fill_coordinates(reports, empty, places)
    got = {r.codigo_laudo: (r.latitude, r.origem_coordenada) for r in filled.collect()}
    assert got == {"1": (-8.05, "laudo"), "2": (-8.1, "calculada_rua"), "4": (None, None)}
    assert cache.count() == 2


def test_quick_test_judges_a_sample(spark, words):
    files = spark.createDataFrame([("1", 3), ("2", 2), ("4", 1)], "codigo_laudo string, modified_at int")
    rules = {"no value": F.col("valor_avaliacao").isNull(), "no type": F.col("tipo").isNull()}
    problems, verdict, _ = quick_test(files, words, rules)
    assert sorted(map(tuple, problems.collect())) == [("4", "no type"), ("4", "no value")]
    assert verdict.head()["verdict"] == "do not run yet"
    _, verdict, _ = quick_test(files, words, rules, n=2)
    assert verdict.head()["n_checks"] == 2


def test_audit_of_drawn_reports(spark, rows):
    stored = spark.range(50).select(F.col("id").cast("string").alias("codigo_laudo"), F.lit(1.0).alias("v"))
    second = stored.withColumn("source", F.lit("a")).withColumn("v", F.when(F.col("codigo_laudo") == "7", 2.0).otherwise(1.0))
    rates, wrong, verdict = accuracy_audit(stored, stored, second, {"v": "number"}, ["a"], n=None)
    assert rows(rates) == [("v", 50, 49, 1, 0, 1.0)]
    assert rows(wrong, "codigo_laudo", "outcome") == [("7", "inconsistent report")]
    assert verdict.head()["verdict"] == "may run"
    assert accuracy_audit(stored, stored, second, {"v": "number"}, ["a"], n=10)[0].head()["n_comparable"] == 10


def test_words_are_read_once_for_all_outputs(spark, words, tmp_path):
    path = str(tmp_path / "positioned-words")
    words.write.parquet(path)
    batch = extract(spark.read.parquet(path), legacy=LEGACY)
    for output in (batch.reports, batch.samples, batch.excluded, batch.failures):
        plan = output._jdf.queryExecution().executedPlan().toString()
        assert "positioned-words" not in plan
        assert output.count() >= 0


def test_sample_values_over_several_lines(spark, rows):
    """Text runs on over lines and the end of a page; of numbers the first line counts; what has no label is counted."""
    first = [[(0, "AMOSTRA 1")], [(0, "Endereço: Rua Y, 5,")], [(0, "Boa Viagem - Recife/PE")], [(0, "Valor:")], [(0, "R$ 500.000,00")], [(0, "à vista")]]
    first += [[(0, "URL: https://x.example/")]]
    data = page("1", 1, cover("N° do Pedido", "Casa", True)) + page("1", 2, first)
    data += page("1", 3, [[(0, "longe/1")], [(0, "AMOSTRA 2")], [(0, "sem rótulo aqui")], [(0, "Valor: abc")], [(0, "Obs: nada")]])
    read = extract(spark.createDataFrame(data, WORDS))
    assert rows(read.samples, "numero_amostra", "endereco", "valor", "url", "nao_lidos") == [
        (1, "Rua Y, 5, Boa Viagem - Recife/PE", Decimal("500000.00"), "https://x.example/ longe/1", []),
        (2, None, None, None, ["valor"]),
    ]
    assert {r.field: (r.n_present, r.n_unparsed) for r in read.sample_failures.collect()}["valor"] == (2, 1)
    assert {r.place: r.n_words for r in read.left_out.collect()}["samples"] == 3


def test_a_far_line_ends_a_sample_value(spark, rows):
    data = page("1", 1, [[(0, "AMOSTRA 1")], [(0, "Conservação: Boa")], [(0, "Valor: 10")], [(0, "Endereço: Rua A")]])
    data += [("1", 1, 0.0, 30.0, 190.0, 200.0, "rodapé")]
    read = extract(spark.createDataFrame(data, WORDS))
    assert rows(read.samples, "endereco") == [("Rua A",)]
    assert {r.place: r.n_words for r in read.left_out.collect()}["samples"] == 1


def test_one_gate_for_both_tables(spark, words):
    """The reports pass; a sample without its report rejects the whole batch."""
    path = shared_dir(spark, "t")
    batch = extract(words, legacy=LEGACY)
    stray = batch.samples.limit(1).withColumn("codigo_laudo", F.lit("99"))
    batch.samples = batch.samples.unionByName(stray)
    with pytest.raises(BatchRejected, match="laudos_amostras: no report") as rejected:
        load(spark, batch, path, few_without_value(0.5))
    assert {(r["table"], r["check"]): r["n_bad"] for r in rejected.value.report} == {
        ("laudos", "no value"): 1, ("laudos_amostras", "no value"): 1 if stray.filter("valor is null").isEmpty() else 2, ("laudos_amostras", "no report"): 1
    }
    assert snapshot.current(spark, path) == (0, {})
    folders = {name: shared_dir(spark, name) for name in ("laudos", "laudos_amostras")}
    staged, _, counts = stage(batch, folders, [], [], ignore=True)
    assert counts["laudos"]["coordenadas"] == 1 and counts["laudos_amostras"]["n_rows"] == 5
    assert "orphan" not in staged["laudos_amostras"].columns


def test_coordinates_written_back_and_kept(spark, words, rows):
    path = shared_dir(spark, "t")
    batch = extract(words, legacy=LEGACY)
    schema = for_storage(batch.reports, batch.samples)[0].schema
    load(spark, batch, path, few_without_value(1.0))
    places = spark.createDataFrame([("PE", "Recife", "Rua A", "11", "50000-000", -8.1, -34.8)], GAZETTEER)
    assert write_coordinates(spark, path, schema, lambda asked: geocode(asked, places)) == 2
    where = ["codigo_laudo", "latitude", "origem_coordenada"]
    filled = [("1", -8.05, "laudo"), ("2", -8.1, "calculada_rua"), ("4", None, None)]
    assert rows(snapshot.read_table(spark, path, "laudos", schema), *where) == filled
    load(spark, extract(words, legacy=LEGACY), path, few_without_value(1.0))  # read again: it stays
    assert rows(snapshot.read_table(spark, path, "laudos", schema), *where) == filled
    other = words.withColumn("text", F.when((F.col("codigo_laudo") == "2") & (F.col("text") == "A,"), "B,").otherwise(F.col("text")))
    load(spark, extract(other, legacy=LEGACY), path, few_without_value(1.0))  # another address: it goes
    assert rows(snapshot.read_table(spark, path, "laudos", schema), *where)[1] == ("2", None, None)
    nothing = spark.createDataFrame([], GAZETTEER)
    version = snapshot.current(spark, path)[0]
    assert write_coordinates(spark, path, schema, lambda asked: geocode(asked, nothing)) == version


def test_two_runs_read_nothing_twice(spark, words, rows):
    """The second run reads only what is new; the excluded report stays excluded, whatever the mode."""
    path, ledger = shared_dir(spark, "t"), shared_dir(spark, "ledger")
    files = spark.createDataFrame([("1",), ("2",), ("3",), ("4",)], "codigo_laudo string")
    first = run(spark, files.filter("codigo_laudo <> '2'"), words, path, ledger, 1, legacy=LEGACY, ignore=True)
    assert rows(first.read) == [("1",), ("3",), ("4",)] and rows(first.excluded, "codigo_laudo") == [("3",)]
    second = run(spark, files, words, path, ledger, 2, legacy=LEGACY, ignore=True)
    assert rows(second.read) == [("2",)] and second.version == 2
    assert rows(run(spark, files, words, path, ledger, 3, mode="all", legacy=LEGACY, ignore=True).read) == [("1",), ("2",), ("4",)]
    # a run that is repeated under its number chooses as it did
    again = run(spark, files.filter("codigo_laudo = '3'"), words, path, ledger, 1, mode="all", legacy=LEGACY, ignore=True)
    assert rows(again.read) == [("3",)]
    assert rows(read_ledger(spark, ledger), "codigo_laudo", "status") == [("3", "excluded")]


def test_a_ledger_keeps_the_newest_entry(spark, rows):
    path = shared_dir(spark, "ledger")
    entry = lambda *r: spark.createDataFrame(list(r), "codigo_laudo string, status string, checked_at timestamp")
    day = [datetime(2025, 1, n) for n in (1, 2, 3)]
    assert read_ledger(spark, path).count() == 0
    write_entries(entry(("a", "old", day[0]), ("b", "x", day[1])), path, 1)
    write_entries(entry(("a", "new", day[2])), path, 2)
    write_entries(entry(("a", "new", day[2])), path, 2)  # the batch comes again
    assert rows(read_ledger(spark, path), "codigo_laudo", "status") == [("a", "new"), ("b", "x")]
    assert rows(read_ledger(spark, path, before=2), "codigo_laudo", "status") == [("a", "old"), ("b", "x")]


def test_samples_of_two_sources_meet(spark, rows):
    kind = "c string, n int, valor double, area double, rua string, padrao string"
    stored = [("1", 1, 10.0, 5.0, "A", "x"), ("1", 2, 10.0, 5.0, "A", "x"), ("1", 3, 20.0, 6.0, "B", "y"), ("1", 4, 30.0, None, "C", "y"), ("2", 1, 10.0, 5.0, "A", "x")]
    second = [("1", 9, 10.0, 5.0, "a", "X"), ("1", 8, 10.0, 5.0, "A", "x"), ("1", 7, 21.0, 6.0, "B", "y"), ("1", 6, 30.0, 7.0, "C", "y"), ("1", 5, 99.0, 1.0, "Z", "w"), ("3", 1, 10.0, 5.0, "A", "x")]
    fields = {"valor": "number", "area": "number", "rua": "text", "padrao": "text"}
    one, other = spark.createDataFrame(stored, kind), spark.createDataFrame(second, kind)
    pairs = align_samples(one, other, "c", "n", fields, least=3)
    assert rows(pairs, "c", "n", "second_number") == [("1", 1, 8), ("1", 2, 9), ("1", 3, 7), ("1", 4, 6)]
    compared = reconcile_samples(one, one, other.withColumn("source", F.lit("s")), "c", "n", fields, ["s"])
    off = compared.filter("outcome <> 'match'")
    assert rows(off, "n", "field", "outcome") == [(3, "valor", "inconsistent report"), (4, "area", "extraction error")]

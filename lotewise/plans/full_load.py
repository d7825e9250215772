"""From words on pages to the two stored tables, the photos and the coordinates."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lotewise.functions.numbers import unit_value
from lotewise.functions.text import fold, fold_label, fold_label_py
from lotewise.operators.coordinates import (
    address_key,
    carry_coordinates,
    coordinate_patch,
    geocode_cached,
    merge_coordinates,
    needs_coordinate,
)
from lotewise.operators.extraction import SAMPLE_HEADING, legacy_fields, options_on_pages
from lotewise.operators.joins import many_to_one
from lotewise.operators.layout import (
    PAGE,
    apart,
    cells,
    cluster_lines,
    fields_of_cells,
    resolve_labels,
    route_layout,
    texts_of_cells,
)
from lotewise.operators.load import Check, GatedTable, flag_orphans, staged_gates
from lotewise.operators.normalise import fill_not_applicable, normalise
from lotewise.operators.photos import (
    classify_caption,
    name_photos,
    photo_plan,
    select_photos,
)
from lotewise.operators.ranking import running_total
from lotewise.operators.selection import select_reprocess, split_excluded
from lotewise.plans import form
from lotewise.schemas import REPORT_KEY, REPORTS, SAMPLE_KEY, SAMPLES
from lotewise.session import drop_dir, keep, shared_dir
from lotewise.sources import snapshot
from lotewise.sources.catalog import stored_form
from lotewise.sources.ledger import read_ledger, write_entries

REPORT_TABLE, SAMPLE_TABLE = "laudos", "laudos_amostras"
#: The fields of a row that are printed but could not be read.
UNREAD = "nao_lidos"
STORED_ADDRESS = StructType([f for f in REPORTS.fields if f.name in ("codigo_laudo", "logradouro", "municipio")])
PLANNED = "codigo_laudo string, sha256 string, label string, file_name string"
LISTS = ("infraestrutura", "infraestrutura_urbana", "servicos_publicos")


@dataclass
class Extracted:
    """What one reading of a batch gives.

    Reports and samples have, beside the columns of their tables, `nao_lidos`: the fields that are printed but
    could not be read. `failures` and `sample_failures` count them; `left_out` (place, n_words) counts the words
    below labels, and the lines of samples, that became part of no value.
    """

    reports: DataFrame
    samples: DataFrame
    excluded: DataFrame
    failures: DataFrame
    sample_failures: DataFrame | None = None
    left_out: DataFrame | None = None


def extract(
    words: DataFrame,
    options: DataFrame | None = None,
    legacy: dict[str, dict[str, str]] | None = None,
    boxes: DataFrame | None = None,
) -> Extracted:
    """Words of the pages to typed reports and samples.

    The words are read and shuffled once, into cells in the shared folder; the lines put together from them and the printed fields
    of the reports are kept there too, so that what is excluded, the failures and the samples do
    not read them anew.

    `boxes` are the drawn checkboxes, whose ticked options fill the three lists of digital reports;
    `options` (codigo_laudo, grupo, opcoes) are such lists read elsewhere; `legacy` the patterns for layouts
    that have no grid.
    """
    if boxes is not None:
        drawn_on = many_to_one(words, boxes.select("codigo_laudo").distinct(), ["codigo_laudo"], "left_semi")
        ticked = options_on_pages(boxes, drawn_on, form.OPTION_HEADINGS, form.BOX_FILLED)
        options = ticked if options is None else options.unionByName(ticked)
    joined = keep(cells(cluster_lines(apart(words, *PAGE)), placed=True), "cells")
    lines = keep(texts_of_cells(joined), "lines")
    models = route_layout(
        lines, "codigo_laudo", "text", form.COVER_MARKER, form.FORM_FIELD
    )
    printed = fields_of_cells(joined, [label for label, _, _ in form.COVER])
    cover = resolve_labels(printed, form.COVER)
    fields = list(dict.fromkeys(field for _, field, _ in form.COVER))
    raw = models.join(
        cover.groupBy("codigo_laudo").pivot("field", fields).agg(F.first("value")),
        "codigo_laudo",
        "left",
    )
    if legacy:
        raw = _with_legacy(raw, lines, models, legacy, fields)
    raw = keep(raw, "printed")
    typed, failures = normalise(raw, {f: k for f, k in form.KINDS.items() if f in fields}, UNREAD)
    if options is not None:
        typed = _with_options(typed, options)
    reports = _as(REPORTS, _spread_out(typed))
    kept, excluded = split_excluded(reports, fold("tipo") == fold(F.lit(form.MULTIPLE_UNITS)))
    left_out = excluded.select("codigo_laudo")
    lines_of_kept = many_to_one(lines, left_out, ["codigo_laudo"], "left_anti")
    samples, sample_failures, lost = _samples(lines_of_kept)
    cut = printed.select(F.lit("labels").alias("place"), F.sum("left_out").alias("n_words"))
    return Extracted(kept, samples, excluded.select("codigo_laudo"), failures, sample_failures, cut.unionByName(lost))


def _with_legacy(raw, lines, models, patterns, fields) -> DataFrame:
    """Old layouts: every page is read by the patterns, the first page that has a field counts."""
    old = models.filter("modelo = 'legacy'")
    in_order = F.array_sort(F.collect_list(F.struct("line", "text")))
    pages = (
        many_to_one(lines, old.select("codigo_laudo"), ["codigo_laudo"], "left_semi")
        .groupBy("codigo_laudo", "page")
        .agg(F.array_join(F.transform(in_order, lambda x: x["text"]), "\n").alias("text"))
    )
    # the two old models share one routing mark: the page tells which patterns apply
    kind = F.when(F.contains(F.col("text"), F.lit("VISTORIA")), "fisico").otherwise("digital")
    read = legacy_fields(pages.withColumn("modelo", kind), "text", patterns)
    found = [f for f in fields if f in read.columns]
    first = read.groupBy("codigo_laudo").agg(
        *(
            F.min(F.when(F.col(f).isNotNull(), F.struct("page", f)))[f].alias(f"__old_{f}")
            for f in found
        )
    )
    joined = raw.join(first, "codigo_laudo", "left")
    filled = {f: F.coalesce(F.col(f), F.col(f"__old_{f}")) for f in found}
    return joined.withColumns(filled).drop(*(f"__old_{f}" for f in found))


def _with_options(typed: DataFrame, options: DataFrame) -> DataFrame:
    ticked = options.groupBy("codigo_laudo").pivot("grupo", list(LISTS)).agg(F.first("opcoes"))
    renamed = ticked.select("codigo_laudo", *(F.col(c).alias(f"__on_{c}") for c in LISTS))
    joined = typed.join(renamed, "codigo_laudo", "left")
    return joined.withColumns(
        {c: F.coalesce(F.col(c), F.col(f"__on_{c}")) for c in LISTS}
    ).drop(*(f"__on_{c}" for c in LISTS))


def _spread_out(typed: DataFrame) -> DataFrame:
    """Address and coordinate taken apart; the coordinate's origin when it is printed."""
    return typed.select(
        *(c for c in typed.columns if c not in ("endereco", "coordenadas")),
        "endereco.*",
        "coordenadas.*",
    ).withColumns(
        {
            "origem_coordenada": F.when(F.col("latitude").isNotNull(), "laudo"),
            "valor_m2": unit_value(
                "valor_m2",
                "valor_avaliacao",
                "area_privativa",
                "area_terreno",
                _is_lot(F.col("tipo")),
            ),
        }
    )


def _is_lot(tipo: Column) -> Column:
    return F.coalesce(F.lower(tipo).rlike("terreno|lote"), F.lit(False))


def _as(schema, df: DataFrame) -> DataFrame:
    """The columns of a target schema, by name, typed; those not read are NULL."""
    return df.select(
        *(
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ),
        UNREAD,
    )


def _samples(lines: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Comparables under the sample headings of each report: (typed, failures, what is in no value).

    A `label: value` line opens a value; lines without a label go on with it, down to the next
    label or heading or to a space of more than twice the page's usual step. Text runs over all its
    lines; of numbers and dates the first line that has anything counts. Headings are counted and values numbered page by page,
    so a report with very many pages is spread; a block may run over the end of a page, and so may a value, into the next one.
    """
    page = ["codigo_laudo", "page"]
    heading = F.col("text").rlike(f"^(?:{SAMPLE_HEADING})")
    numbered = running_total(
        lines,
        ["codigo_laudo"],
        [F.col("page"), F.col("line")],
        F.col("page"),
        F.when(heading, 1).otherwise(0),
        "numero_amostra",
    ).filter(F.col("numero_amostra") > 0)
    pair = r"^([^:]{1,60}):(?!//)\s*(.*)$"
    down = W.partitionBy(*page).orderBy("line")
    usual = F.percentile_approx("__step", 0.5).over(W.partitionBy(*page))
    far = F.col("__step") > F.greatest(F.lit(18.0), 2 * usual)
    opens = F.when(heading | F.col("text").rlike(pair) | F.coalesce(far, F.lit(False)), 1).otherwise(0)
    placed = (
        numbered.withColumn("__step", F.col("top") - F.lag("top").over(down))
        .withColumn("__opens", opens)
        .withColumn("__value", F.sum("__opens").over(down.rowsBetween(W.unboundedPreceding, W.currentRow)))
    )
    # what stands above the first label of a page goes with the last one of the page before
    last = placed.groupBy(*page).agg(F.max("__value").alias("__last")).select(
        "codigo_laudo", (F.col("page") + 1).alias("page"), "__last"
    )
    above = F.col("__value") == 0
    owned = placed.join(last, page, "left").select(
        "codigo_laudo",
        F.when(above, F.col("page") - 1).otherwise(F.col("page")).alias("__page"),
        F.when(above, F.col("__last")).otherwise(F.col("__value")).alias("__value"),
        F.struct("page", "line", "text", "numero_amostra").alias("__line"),
    )
    values = owned.groupBy("codigo_laudo", "__page", "__value").agg(
        F.array_sort(F.collect_list("__line")).alias("__lines")
    )
    first = F.col("__lines")[0]
    label = F.when(F.col("__value") > 0, F.nullif(F.regexp_extract(first["text"], pair, 1), F.lit("")))
    further = F.transform(F.slice("__lines", 2, F.greatest(F.size("__lines") - 1, F.lit(0))), lambda x: x["text"])
    parts = F.filter(F.concat(F.array(F.regexp_extract(first["text"], pair, 2)), further), lambda x: F.trim(x) != "")
    read = values.select(
        "codigo_laudo",
        first["numero_amostra"].alias("numero_amostra"),
        label.alias("label"),
        parts.alias("__parts"),
        first["text"].alias("__first"),
        first["text"].rlike(f"^(?:{SAMPLE_HEADING})").alias("__heading"),
    )
    in_one_line = [fold_label_py(x) for x, field, _ in form.SAMPLE if form.KINDS.get(field, "text") not in ("text", "address")]
    value = F.when(fold_label("label").isin(in_one_line), F.get("__parts", F.lit(0))).otherwise(F.array_join("__parts", " "))
    raw = read.filter("label is not null").select(*SAMPLE_KEY, "label", value.alias("value"))
    words = lambda text: F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))
    lost = read.filter("label is null").agg(
        F.lit("samples").alias("place"),
        F.sum(F.reduce("__parts", F.lit(0), lambda n, x: n + words(x)) + F.when(F.col("__heading"), 0).otherwise(words("__first"))).alias(
            "n_words"
        ),
    )
    fields = [field for _, field, _ in form.SAMPLE]
    wide = (
        resolve_labels(raw, form.SAMPLE, SAMPLE_KEY)
        .groupBy(*SAMPLE_KEY)
        .pivot("field", fields)
        .agg(F.first("value"))
    )
    kinds = {f: k for f, k in form.KINDS.items() if f in fields and k != "address"}
    typed, failures = normalise(wide, {**kinds, "endereco": "text"}, UNREAD)
    valued = typed.withColumn(
        "valor_m2",
        unit_value("valor_m2", "valor", "area_privativa", "area_terreno", _is_lot(F.col("tipo"))),
    )
    return _as(SAMPLES, valued), failures, lost


def for_storage(reports: DataFrame, samples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """C8 and `;` lists: the tables as they are stored."""
    reports, samples = reports.drop(UNREAD), samples.drop(UNREAD)
    land = _is_lot(F.col("tipo"))
    flat = F.coalesce(F.lower("tipo").rlike("apartamento"), F.lit(False))
    rooms = ["quartos", "banheiros", "vagas", "idade"]
    reports = fill_not_applicable(
        stored_form(reports), [(land, rooms), (flat, ["area_terreno"])]
    )
    samples = fill_not_applicable(
        samples,
        [
            (land, rooms),
            (flat, ["area_terreno"]),
            (F.col("cidade").isNull(), ["cidade", "uf"]),
            (F.col("url").isNull(), ["url"]),
        ],
    )
    return reports, samples


def load(
    spark: SparkSession,
    batch: Extracted,
    path: str,
    checks: Callable[[], Sequence[Check]] = form.report_checks,
    ignore: bool = False,
    sample_checks: Callable[[], Sequence[Check]] = form.sample_checks,
) -> int:
    """One gate over both tables, then their upsert in one commit; returns the stored version.

    Reports and samples are staged once in the shared folder, and counted, with samples that
    have no report, while they are written; a batch that fails in either table
    raises before anything is written to the tables, and its staging folders stay to be looked at.
    The samples of a report that is read again replace the old ones; its coordinate is kept as
    `carry_coordinates` says.
    """
    folders = {name: shared_dir(spark, f"staged-{name}") for name in (REPORT_TABLE, SAMPLE_TABLE)}
    staged, _, _ = stage(batch, folders, checks(), sample_checks(), ignore)
    reports, samples = for_storage(staged[REPORT_TABLE], staged[SAMPLE_TABLE])
    version = snapshot.load_batch(
        spark,
        path,
        {REPORT_TABLE: reports, SAMPLE_TABLE: samples},
        {REPORT_TABLE: REPORT_KEY, SAMPLE_TABLE: SAMPLE_KEY},
        "codigo_laudo",
        replaced={SAMPLE_TABLE: reports.select("codigo_laudo")},
        prepare={REPORT_TABLE: carry_coordinates},
    )
    for folder in folders.values():
        drop_dir(spark, folder)
    return version


def stage(
    batch: Extracted,
    folders: dict[str, str],
    checks: Sequence[Check],
    sample_checks: Sequence[Check],
    ignore: bool = False,
) -> tuple[dict[str, DataFrame], list, dict[str, dict[str, int]]]:
    """D2 over both tables: (tables as staged, the report, unread values per field of each table)."""

    def unread(table: DataFrame) -> dict[str, Column]:
        known = [c for c in (*table.columns, "endereco", "coordenadas") if c in form.KINDS]
        return {c: F.count_if(F.array_contains(UNREAD, c)) for c in dict.fromkeys(known)}

    def with_flag(staged: dict[str, DataFrame]) -> DataFrame:
        return flag_orphans(batch.samples, staged[REPORT_TABLE], "codigo_laudo")

    tables = {
        REPORT_TABLE: GatedTable(batch.reports, checks, unread(batch.reports)),
        SAMPLE_TABLE: GatedTable(with_flag, sample_checks, unread(batch.samples), ["orphan"]),
    }
    return staged_gates(tables, folders, ignore)


@dataclass
class Run:
    """What one run did: the reports it read, the stored version, the photo plan."""

    read: DataFrame
    excluded: DataFrame
    version: int
    photos: DataFrame | None


def run(
    spark: SparkSession,
    files: DataFrame,
    words: DataFrame,
    path: str,
    excluded_dir: str,
    batch: int,
    mode: str = "new",
    keys: DataFrame | None = None,
    boxes: DataFrame | None = None,
    legacy: dict[str, dict[str, str]] | None = None,
    photos: DataFrame | None = None,
    existing_photos: DataFrame | None = None,
    answer: Callable[[DataFrame], DataFrame] | None = None,
    checks: Callable[[], Sequence[Check]] = form.report_checks,
    sample_checks: Callable[[], Sequence[Check]] = form.sample_checks,
    ignore: bool = False,
) -> Run:
    """A whole run: choose the reports, read them, gate, store, photos, coordinates.

    `files` (codigo_laudo, ...) are the reports at hand; A7 chooses by `mode` those to read, never one that
    the ledger in `excluded_dir` lists. Words and boxes of the others are not read. Reports of whole
    developments go into the ledger under the number `batch` (a run that is repeated keeps its number) once the
    load is committed; a rejected batch raises before that, and photos are planned for no report of it. `answer`
    looks up addresses, as `geocode` does; its coordinates are written back last.
    """
    stored = snapshot.read_table(spark, path, REPORT_TABLE, STORED_ADDRESS).select("codigo_laudo", "logradouro", "municipio")
    listed = read_ledger(spark, excluded_dir, before=batch)
    chosen = keep(select_reprocess(files, stored, listed, mode, keys).select("codigo_laudo").distinct(), "chosen")

    def of_chosen(table: DataFrame) -> DataFrame:
        return many_to_one(table, chosen, ["codigo_laudo"], "left_semi")

    read = extract(of_chosen(words), legacy=legacy, boxes=None if boxes is None else of_chosen(boxes))
    schema = for_storage(read.reports, read.samples)[0].schema
    version = load(spark, read, path, checks, ignore, sample_checks)
    excluded = keep(
        read.excluded.select("codigo_laudo", F.lit("excluded").alias("status"), F.current_timestamp().alias("checked_at")),
        "excluded",
    )
    write_entries(excluded, excluded_dir, batch)
    plan = None
    if photos is not None:
        there = existing_photos if existing_photos is not None else spark.createDataFrame([], PLANNED)
        plan = keep(plan_photos(of_chosen(photos), read.reports.select("codigo_laudo", "modelo"), there), "photo-plan")
    if answer is not None:
        version = write_coordinates(spark, path, schema, answer)
    return Run(chosen, excluded, version, plan)


def write_coordinates(
    spark: SparkSession, path: str, schema: StructType, answer: Callable[[DataFrame], DataFrame]
) -> int:
    """G1-G4 on the stored reports; returns the stored version.

    `answer` looks up the addresses of reports without a coordinate (as `geocode` does). The three coordinate
    columns alone are written, into rows that still lack a coordinate and still have that address; whatever else
    has changed in between stays. Only buckets with a hit are rewritten.
    """
    stored = snapshot.read_table(spark, path, REPORT_TABLE, schema)
    patch = keep(coordinate_patch(stored, answer(needs_coordinate(stored))), "coordinates")
    lacks = F.col("latitude").isNull() | F.col("longitude").isNull()
    return snapshot.update_columns(
        spark,
        path,
        REPORT_TABLE,
        schema,
        patch,
        "codigo_laudo",
        ["latitude", "longitude", "origem_coordenada"],
        lacks & (address_key() == F.col("new_endereco_chave")),
    )


def stored_tables(spark: SparkSession, path: str, reports, samples) -> tuple[DataFrame, DataFrame]:
    """Both tables as last committed, by the schemas of `reports` and `samples`."""
    return (
        snapshot.read_table(spark, path, REPORT_TABLE, reports),
        snapshot.read_table(spark, path, SAMPLE_TABLE, samples),
    )


def plan_photos(photos: DataFrame, models: DataFrame, existing: DataFrame) -> DataFrame:
    """Keep, add and remove rows, the added ones with their file names.

    `photos` as in the schema, `models` (codigo_laudo, modelo), `existing`
    (codigo_laudo, sha256, label, file_name).
    """
    routed = many_to_one(classify_caption(photos), models, ["codigo_laudo"])
    chosen = select_photos(routed)
    plan = photo_plan(chosen, existing, checked=routed)
    key = ["codigo_laudo", "sha256", "label"]
    new = chosen.join(plan.filter("action = 'add'").select(*key), key, "left_semi")
    named = name_photos(new, existing.select("codigo_laudo", "file_name")).select(*key, "file_name")
    return plan.join(named, key, "left").select(
        *key, "action", F.coalesce("target", "file_name").alias("target")
    )


def fill_coordinates(
    reports: DataFrame, cache: DataFrame, gazetteer: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(reports with their coordinates filled in, the cache to keep)."""
    answers, kept = geocode_cached(needs_coordinate(reports), cache, gazetteer)
    return merge_coordinates(reports, answers), kept

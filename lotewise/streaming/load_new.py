"""Incremental load and incremental coordinates (H1, H2)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from lotewise.operators.coordinates import geocode, geocode_stored, needs_coordinate, unanswered
from lotewise.operators.load import Check, staged_gate
from lotewise.session import drop_dir, shared_dir
from lotewise.sources import snapshot
from lotewise.sources.files import exists
from lotewise.sources.places import stored_places


def _run_available(
    spark: SparkSession,
    in_dir: str,
    schema,
    checkpoint: str,
    per_batch: Callable[[DataFrame, int], None],
    files_per_batch: int | None = None,
) -> None:
    stream = spark.readStream.schema(schema)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    query = (
        stream.parquet(in_dir)
        .writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(per_batch)
        .start()
    )
    query.awaitTermination()


def load_new(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    schema,
    name: str,
    keys: Sequence[str],
    order_by: Sequence[str],
    checks: Callable[[], Sequence[Check]],
    ignore: bool = False,
    buckets: int = snapshot.BUCKETS,
    files_per_batch: int | None = None,
) -> None:
    """H1: every file not taken yet goes through the gate and is upserted into `out_dir`.

    A rejected batch stops the run with nothing of it written, and comes again in
    the next run. A batch repeated after a failure changes nothing: the load is
    keyed. Rows are bucketed by the first key.
    """

    def per_batch(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        folder = shared_dir(session, "staged")
        staged, _ = staged_gate(batch, checks(), folder, ignore)
        snapshot.load_batch(
            session,
            out_dir,
            {name: staged},
            {name: keys},
            keys[0],
            order_by,
            buckets=buckets,
        )
        drop_dir(session, folder)

    _run_available(spark, in_dir, schema, checkpoint, per_batch, files_per_batch)


CACHE_SCHEMA = (
    "endereco_chave string, logradouro string, numero string, municipio string, uf string,"
    " cep string, lat double, lon double, origem string"
)


def geocode_new(
    spark: SparkSession,
    in_dir: str,
    cache_dir: str,
    checkpoint: str,
    schema,
    gazetteer: Callable[[SparkSession], DataFrame] | str,
    files_per_batch: int | None = None,
) -> None:
    """H2: looks up the addresses of reports not taken yet that lack a coordinate; keeps every answer.

    `gazetteer` is the name of a table that `store_places` has written, which no trigger keys or shuffles
    again, or a function that reads a plain gazetteer, which every trigger keys anew.

    Rows without a `latitude` column are addresses to ask for. The cache is a folder of appended Parquet, one subfolder per batch, overwritten
    if that batch is repeated; addresses answered before are not asked again.
    """

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        known = read_cache(session, cache_dir, before=batch_id)
        asked = needs_coordinate(batch) if "latitude" in batch.columns else batch
        open_ones = unanswered(asked, known)
        if isinstance(gazetteer, str):
            new = geocode_stored(open_ones, *stored_places(session, gazetteer))
        else:
            new = geocode(open_ones, gazetteer(session))
        new.write.mode("overwrite").parquet(f"{cache_dir}/batch={batch_id}")

    _run_available(spark, in_dir, schema, checkpoint, per_batch, files_per_batch)


def read_cache(spark: SparkSession, cache_dir: str, before: int | None = None) -> DataFrame:
    """The answers kept so far; `before` leaves out a batch that is being repeated."""
    full = f"{CACHE_SCHEMA}, batch long"
    if not exists(spark, cache_dir):  # no cycle ran yet
        return spark.createDataFrame([], CACHE_SCHEMA)
    cache = spark.read.schema(full).parquet(cache_dir)
    if before is not None:
        cache = cache.filter(cache["batch"] < before)
    return cache.drop("batch")

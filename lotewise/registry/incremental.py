"""A12, H1, H2 and the first whole run, over lineitem, part, events and customer."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lotewise.operators.quality import empty_fields
from lotewise.plans.first_load import load_lines
from lotewise.registry.base import query, table
from lotewise.registry.coordinates import CUSTOMERS, GEOCODE_SQL, gazetteer, reports
from lotewise.registry.load import LINE_KEY, UPSERT_SQL, shipped_split
from lotewise.operators.load import Check
from lotewise.session import shared_dir
from lotewise.sources import snapshot
from lotewise.sources.places import store_places
from lotewise.streaming.load_new import geocode_new, load_new, read_cache


@query("write_snapshot", UPSERT_SQL)
def stored_in_two_loads(spark, sf):
    """Lines shipped before 1999 loaded first, the rest after; read back as stored."""
    path = shared_dir(spark, "snapshot")
    before, after = shipped_split(spark, sf)
    for batch in (before, after):
        snapshot.load_batch(
            spark,
            path,
            {"linhas": batch},
            {"linhas": LINE_KEY},
            "l_orderkey",
            ["l_shipdate"],
            buckets=16,
        )
    return snapshot.read_table(spark, path, "linhas", before.schema)


@query(
    "load_new",
    """select * exclude (rk) from (
         select *, row_number() over (partition by user_id, event_type
                                      order by ts desc, event_id desc, value desc, props desc)
                   as rk from events)
       where rk = 1""",
)
def events_as_they_come(spark, sf):
    events = table(spark, sf, "events")
    base = shared_dir(spark, "load-new")
    cut = F.lit("2024-01-15").cast("date")
    for part in (events.filter(F.col("ts") < cut), events.filter(F.col("ts") >= cut)):
        part.write.mode("append").parquet(f"{base}/in")
        load_new(
            spark,
            f"{base}/in",
            f"{base}/out",
            f"{base}/checkpoint",
            events.schema,
            "eventos",
            ["user_id", "event_type"],
            ["ts"],
            lambda: [Check("no user", F.col("user_id").isNull(), 0.05)],
            buckets=16,
        )
    return snapshot.read_table(spark, f"{base}/out", "eventos", events.schema)


LACKING_SQL = GEOCODE_SQL.replace(
    f"({CUSTOMERS})", f"(select * from ({CUSTOMERS}) where c_acctbal <= 5000 or c_acctbal is null)"
)


@query("geocode_new", LACKING_SQL)
def addresses_as_they_come(spark, sf):
    base = shared_dir(spark, "geocode-new")
    asked = reports(spark, sf)
    places = f"places_{uuid.uuid4().hex}"
    store_places(gazetteer(spark, sf), places, f"{base}/places", buckets=16)
    first = F.col("segmento") == "BUILDING"
    for part in (asked.filter(first), asked.filter(~first)):
        part.write.mode("append").parquet(f"{base}/in")
        geocode_new(
            spark,
            f"{base}/in",
            f"{base}/cache",
            f"{base}/checkpoint",
            asked.schema,
            places,
        )
    return read_cache(spark, f"{base}/cache")


FIRST_LOAD_SQL = """
  with typed as (
    select l_orderkey, l_linenumber, cast(l_shipdate as date) as data, p_type,
           cast(cast(l_extendedprice as decimal(18,2)) * 100 as hugeint) as v,
           cast(case when l_quantity < 10 then l_quantity * 1000 else l_quantity end * 100
                as hugeint) as a,
           cast(p_size * 100 as hugeint) as t
    from lineitem join part on l_partkey = p_partkey),
  valued as (
    select *, case when p_type = 'ECONOMY' then t else a end as area from typed),
  rows_ as (
    select *, case when area > 0 then (200 * v + area) // (2 * area) end as m2 from valued),
  kept as (
    select * from (
      select *, row_number() over (partition by l_orderkey, l_linenumber
                                   order by data desc, v desc, a desc, t desc, p_type desc,
                                            m2 desc nulls last) as rk
      from rows_) where rk = 1)
  select 'codigo_laudo' as field, count(*) as n_rows, 0::bigint as n_empty, 0::bigint as n_zero
  from kept
  union all select 'numero_amostra', count(*), 0, count_if(l_linenumber = 0)::bigint from kept
  union all select 'data', count(*), 0, 0 from kept
  union all select 'valor', count(*), 0, count_if(v = 0)::bigint from kept
  union all select 'area_privativa', count(*), 0, count_if(a = 0)::bigint from kept
  union all select 'area_terreno', count(*), 0, count_if(t = 0)::bigint from kept
  union all select 'tipo', count(*), 0, 0 from kept
  union all select 'valor_m2', count(*), count_if(m2 is null)::bigint,
                   count_if(m2 = 0)::bigint from kept"""


@query("first_load", FIRST_LOAD_SQL)
def quality_of_first_load(spark, sf):
    return empty_fields(load_lines(spark, sf))

"""G1-G5 with customers as reports and suppliers as the gazetteer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotewise.operators.coordinates import (
    LEVELS,
    address_key,
    carry_coordinates,
    geocode,
    geocode_cached,
    geocode_error,
    merge_coordinates,
    needs_coordinate,
)
from lotewise.plans.full_load import REPORT_TABLE, write_coordinates
from lotewise.registry.base import query, table
from lotewise.session import shared_dir
from lotewise.sources import snapshot

ADDRESS_SQL = """
  select 'Rua ' || (k % 10) as logradouro, cast(k % 3 as varchar) as numero,
         'Cidade ' || (k % 5) as municipio, n_name as uf,
         lpad(cast(k % {ceps} as varchar), 5, '0') || '-000' as cep, *
  from (select {key} as k, {nation} as nk, * from {table}) join nation on nk = n_nationkey"""
CUSTOMERS = ADDRESS_SQL.format(ceps=60, key="c_custkey", nation="c_nationkey", table="customer")
SUPPLIERS = ADDRESS_SQL.format(ceps=40, key="s_suppkey", nation="s_nationkey", table="supplier")

# millionths of a degree, so that means are exact
LAT_SQL, LON_SQL = "(k * 7919 % 60000000 - 33000000)", "(k * 104729 % 40000000 - 73000000)"
CHAVE = """lower(logradouro) || '|' || numero || '|' || lower(municipio) || '|' || lower(uf)
           || '|' || cep"""

GEOCODE_SQL = f"""
  with a as (select distinct logradouro, numero, municipio, uf, cep, {CHAVE} as endereco_chave
             from ({CUSTOMERS})),
       g as (select *, {LAT_SQL} as la, {LON_SQL} as lo from ({SUPPLIERS})),
       k1 as (select uf, municipio, logradouro, numero, count(*) as n, sum(la) as la, sum(lo) as lo
              from g group by all),
       k2 as (select uf, municipio, logradouro, count(*) as n, sum(la) as la, sum(lo) as lo
              from g group by all),
       k3 as (select cep, count(*) as n, sum(la) as la, sum(lo) as lo from g group by all),
       k4 as (select uf, municipio, count(*) as n, sum(la) as la, sum(lo) as lo
              from g group by all)
  select a.*,
         coalesce(k1.la, k2.la, k3.la, k4.la) / 1000000.0::double
           / coalesce(k1.n, k2.n, k3.n, k4.n) as lat,
         coalesce(k1.lo, k2.lo, k3.lo, k4.lo) / 1000000.0::double
           / coalesce(k1.n, k2.n, k3.n, k4.n) as lon,
         case when k1.n is not null then 'calculada_numero'
              when k2.n is not null then 'calculada_rua'
              when k3.n is not null then 'calculada_cep'
              when k4.n is not null then 'calculada_cidade' end as origem
  from a left join k1 using (uf, municipio, logradouro, numero)
         left join k2 using (uf, municipio, logradouro)
         left join k3 using (cep)
         left join k4 using (uf, municipio)"""


def _with_address(df, key: str, ceps: int):
    k = F.col(key)
    return df.select(
        "*",
        F.concat(F.lit("Rua "), (k % 10).cast("string")).alias("logradouro"),
        (k % 3).cast("string").alias("numero"),
        F.concat(F.lit("Cidade "), (k % 5).cast("string")).alias("municipio"),
        F.col("n_name").alias("uf"),
        F.concat(F.lpad((k % ceps).cast("string"), 5, "0"), F.lit("-000")).alias("cep"),
    )


def _millionths(key: str, factor: int, span: int, low: int) -> Column:
    return (F.col(key) * factor % span - low) / F.lit(1000000.0)


def reports(spark, sf):
    """Customers as reports; the richer half prints its coordinate."""
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    customer = table(spark, sf, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    printed = F.col("c_acctbal") > 5000
    return _with_address(customer, "c_custkey", 60).select(
        F.col("c_custkey").cast("string").alias("codigo_laudo"),
        "logradouro",
        "numero",
        "municipio",
        "uf",
        "cep",
        F.when(printed, F.lit(-23.5)).alias("latitude"),
        F.when(printed, F.lit(-46.6)).alias("longitude"),
        F.lit(None).cast("string").alias("origem_coordenada"),
        F.col("c_mktsegment").alias("segmento"),
    )


def _with_supplier(spark, sf):
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    supplier = table(spark, sf, "supplier").join(
        nation, F.col("s_nationkey") == F.col("n_nationkey")
    )
    return _with_address(supplier, "s_suppkey", 40).select(
        "s_suppkey",
        "uf",
        F.col("municipio").alias("city"),
        F.col("logradouro").alias("street"),
        F.col("numero").alias("number"),
        "cep",
        _millionths("s_suppkey", 7919, 60000000, 33000000).alias("lat"),
        _millionths("s_suppkey", 104729, 40000000, 73000000).alias("lon"),
    )


def gazetteer(spark, sf):
    return _with_supplier(spark, sf).drop("s_suppkey")


@query(
    "needs_coordinate",
    f"""select distinct logradouro, numero, municipio, uf, cep from ({CUSTOMERS})
        where c_acctbal <= 5000""",
)
def to_look_up(spark, sf):
    return needs_coordinate(reports(spark, sf))


@query("geocode", GEOCODE_SQL)
def cascade(spark, sf):
    return geocode(reports(spark, sf), gazetteer(spark, sf))


@query(
    "geocode_cached",
    f"""with known as (select distinct {CHAVE} as c from ({CUSTOMERS})
                       where c_mktsegment = 'BUILDING')
        select endereco_chave, logradouro, numero, municipio, uf, cep,
               case when c is not null then 1.5::double else lat end as lat,
               case when c is not null then 2.5::double else lon end as lon,
               case when c is not null then 'calculada_rua' else origem end as origem
        from ({GEOCODE_SQL}) left join known on c = endereco_chave""",
)
def cached(spark, sf):
    """Addresses of one segment were answered before, with values no lookup would give."""
    asked = reports(spark, sf)
    address = ["logradouro", "numero", "municipio", "uf", "cep"]
    cache = (
        asked.filter("segmento = 'BUILDING'")
        .select(address_key().alias("endereco_chave"), *address)
        .distinct()
        .select(
            "*",
            F.lit(1.5).alias("lat"),
            F.lit(2.5).alias("lon"),
            F.lit("calculada_rua").alias("origem"),
        )
    )
    return geocode_cached(asked, cache, gazetteer(spark, sf))[0]


@query(
    "merge_coordinates",
    f"""select cast(c_custkey as varchar) as codigo_laudo,
               case when c_acctbal > 5000 then -23.5::double else lat end as latitude,
               case when c_acctbal > 5000 then -46.6::double else lon end as longitude,
               case when c_acctbal > 5000 then 'laudo' else origem end as origem_coordenada
        from (select *, {CHAVE} as c from ({CUSTOMERS}))
             left join ({GEOCODE_SQL}) as g on g.endereco_chave = c""",
)
def merged(spark, sf):
    asked = reports(spark, sf)
    found = geocode(needs_coordinate(asked), gazetteer(spark, sf))
    return merge_coordinates(asked, found).select(
        "codigo_laudo", "latitude", "longitude", "origem_coordenada"
    )


MOVED = f"""select * replace (case when k % 7 = 0 then 'M' || numero else numero end as numero)
            from ({CUSTOMERS})"""
LATER_SQL = GEOCODE_SQL.replace(f"({CUSTOMERS})", f"({MOVED})").replace(
    f"({SUPPLIERS})", f"(select * from ({SUPPLIERS}) where k % 2 = 0)"
)


@query(
    "coordinates_written_back",
    f"""with c1 as (select k as id, {CHAVE} as first_key from ({CUSTOMERS})),
             c2 as (select *, {CHAVE} as later_key from ({MOVED})),
             r as (select c2.*, g1.lat as lat1, g1.lon as lon1, g1.origem as origem1, g2.lat as lat2, g2.lon as lon2,
                          g2.origem as origem2, k % 3 <> 0 and k % 7 <> 0 and g1.origem is not null as kept
                   from c2 join c1 on id = k left join ({GEOCODE_SQL}) g1 on g1.endereco_chave = first_key
                   left join ({LATER_SQL}) g2 on g2.endereco_chave = later_key)
        select cast(k as varchar) as codigo_laudo,
               case when c_acctbal > 5000 then -23.5::double when k % 5 = 0 then -10.0::double
                    when kept then lat1 else lat2 end as latitude,
               case when c_acctbal > 5000 then -46.6::double when k % 5 = 0 then -40.0::double
                    when kept then lon1 else lon2 end as longitude,
               case when c_acctbal > 5000 or k % 5 = 0 then 'laudo'
                    when kept then origem1 else origem2 end as origem_coordenada
        from r""",
)
def written_back(spark, sf):
    """Two cycles of load and look-up into one stored table.

    The first has two thirds of the reports and the whole gazetteer. In the second all reports are read: some print a
    coordinate now, some have another address, and the gazetteer has lost half its places, so that what was
    calculated before and is kept can be told from what is calculated now.
    """
    path = shared_dir(spark, "written-back")
    first = reports(spark, sf)
    key = F.col("codigo_laudo").cast("long")
    prints = (key % 5 == 0) & F.col("latitude").isNull()
    again = first.withColumns(
        {
            "latitude": F.when(prints, F.lit(-10.0)).otherwise(F.col("latitude")),
            "longitude": F.when(prints, F.lit(-40.0)).otherwise(F.col("longitude")),
            "numero": F.when(key % 7 == 0, F.concat(F.lit("M"), "numero")).otherwise(F.col("numero")),
        }
    )
    places = gazetteer(spark, sf)
    lost_half = _with_supplier(spark, sf).filter("s_suppkey % 2 = 0").drop("s_suppkey")
    for read, known in ((first.filter(key % 3 != 0), places), (again, lost_half)):
        snapshot.load_batch(
            spark,
            path,
            {REPORT_TABLE: read},
            {REPORT_TABLE: ["codigo_laudo"]},
            "codigo_laudo",
            buckets=16,
            prepare={REPORT_TABLE: carry_coordinates},
        )
        write_coordinates(spark, path, first.schema, lambda asked, known=known: geocode(asked, known))
    stored = snapshot.read_table(spark, path, REPORT_TABLE, first.schema)
    return stored.select("codigo_laudo", "latitude", "longitude", "origem_coordenada")


@query(
    "geocode_error",
    """with m as (select s_suppkey,
                         case s_suppkey % 4 when 0 then 111.2 when 1 then 333.6 when 2 then 1111.9
                              else 11119.5 end::double as metres,
                         case s_suppkey % 4 when 0 then 'calculada_numero'
                              when 1 then 'calculada_rua' when 2 then 'calculada_cep'
                              else 'calculada_cidade' end as origem from supplier),
            a as (select metres, unnest([origem, 'todas']) as origem from m),
            r as (select *, row_number() over (partition by origem order by metres) - 1 as rk,
                         count(*) over (partition by origem) as c from a)
       select origem, count(*) as n, count_if(metres < 500)::bigint / count(*) as under_500m,
              count_if(metres > 5000)::bigint / count(*) as over_5km,
              max(case when rk = (c - 1) // 2 then metres end)
              + (max(case when rk = c // 2 then metres end)
                 - max(case when rk = (c - 1) // 2 then metres end)) * 0.5::double as typical_m
       from r group by origem""",
)
def error_against_truth(spark, sf):
    """Each supplier found a known distance north of where it is."""
    lat = _millionths("s_suppkey", 7919, 60000000, 33000000)
    lon = _millionths("s_suppkey", 104729, 40000000, 73000000)
    truth = table(spark, sf, "supplier").select(
        "s_suppkey", lat.alias("lat"), lon.alias("lon")
    )
    kind = (F.col("s_suppkey") % 4).cast("int")
    shift = F.element_at(F.array(*(F.lit(x) for x in (0.001, 0.003, 0.01, 0.1))), kind + 1)
    found = truth.select(
        "s_suppkey",
        (F.col("lat") + shift).alias("lat"),
        "lon",
        F.element_at(F.array(*(F.lit(x) for x in LEVELS)), kind + 1).alias("origem"),
    )
    return geocode_error(truth, found, "s_suppkey")

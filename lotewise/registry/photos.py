"""F1-F8 over part, documents, lineitem and events read as photo lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotewise.operators.photos import (
    classify_caption,
    dedupe_photos,
    drop_page_scans,
    name_photos,
    photo_plan,
    pick_facade,
    room_equals_facade,
    top_unlabelled,
)
from lotewise.registry.base import query, table
from lotewise.session import keep

# Nouns of the part names read as captions; `gizmo` and `anvil` have no label.
NOUNS = [
    ("fachada", r"\bring\b"),
    ("sala", r"\bwidget\b"),
    ("quarto", r"\bplate\b"),
    ("cozinha", r"\brod\b"),
    ("banheiro", r"\bgear\b"),
    ("varanda", r"\bbolt\b"),
]
LABEL_SQL = """case when p_size % 10 = 0 then 'sem_legenda'
  when p_name like '%ring' then 'fachada' when p_name like '%widget' then 'sala'
  when p_name like '%plate' then 'quarto' when p_name like '%rod' then 'cozinha'
  when p_name like '%gear' then 'banheiro' when p_name like '%bolt' then 'varanda'
  else 'outro' end"""


def captioned(spark, sf):
    caption = F.when(F.col("p_size") % 10 == 0, " ").otherwise(F.initcap("p_name"))
    return table(spark, sf, "part").select("p_partkey", caption.alias("caption"))


@query("classify_caption", f"select p_partkey, {LABEL_SQL} as label from part")
def labelled(spark, sf):
    return classify_caption(captioned(spark, sf), NOUNS).select("p_partkey", "label")


@query(
    "top_unlabelled",
    f"""select p_name as caption, count(*) as n from part where {LABEL_SQL} = 'outro'
        group by p_name order by n desc, caption limit 20""",
)
def to_grow_the_list(spark, sf):
    return top_unlabelled(classify_caption(captioned(spark, sf), NOUNS), 20)


@query(
    "dedupe_photos",
    """select lang as codigo_laudo, md5(text) as sha256, min(doc_id) as pos
       from documents group by lang, md5(text)""",
)
def without_copies(spark, sf):
    photos = table(spark, sf, "documents").select(
        F.col("lang").alias("codigo_laudo"), F.md5("text").alias("sha256"), F.col("doc_id").alias("pos")
    )
    return dedupe_photos(photos, ["pos"])


@query(
    "drop_page_scans",
    """select p_partkey, cast(p_size as double) as width, 1.0::double as height,
              50.0::double as page_width, 1.0::double as page_height
       from part where p_size / 50.0::double < 0.9::double""",
)
def real_photos(spark, sf):
    photos = table(spark, sf, "part").select(
        "p_partkey",
        F.col("p_size").cast("double").alias("width"),
        F.lit(1.0).alias("height"),
        F.lit(50.0).alias("page_width"),
        F.lit(1.0).alias("page_height"),
    )
    return drop_page_scans(photos, 0.9)


@query(
    "pick_facade",
    """with p as (select l_orderkey as codigo_laudo, l_linenumber as page, l_partkey as pos,
                        case when l_partkey % 7 <> 0 then l_extendedprice end as size, l_returnflag = 'A' as labelled,
                        o_orderstatus = 'F' as fisico
                 from lineitem join orders on l_orderkey = o_orderkey),
            c as (select *, 'caption' as via, row_number() over (
                    partition by codigo_laudo order by page, pos) as rk from p where labelled),
            l as (select *, 'page 1' as via, row_number() over (
                    partition by codigo_laudo order by size desc, pos) as rk from p
                  where fisico and page = 1 and size is not null)
       select codigo_laudo, page, pos, via from c where rk = 1
       union all select codigo_laudo, page, pos, via from l
       where rk = 1 and codigo_laudo not in (select codigo_laudo from c)""",
)
def facades(spark, sf):
    models = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("codigo_laudo"),
        F.when(F.col("o_orderstatus") == "F", "fisico").otherwise("digital").alias("modelo"),
    )
    photos = (
        table(spark, sf, "lineitem")
        .select(
            F.col("l_orderkey").alias("codigo_laudo"),
            F.col("l_linenumber").alias("page"),
            F.col("l_partkey").alias("pos"),
            F.when(F.col("l_partkey") % 7 != 0, F.col("l_extendedprice")).alias("width"),
            F.lit(1.0).alias("height"),
            F.when(F.col("l_returnflag") == "A", "fachada").otherwise("sala").alias("label"),
        )
        .join(models, "codigo_laudo")
    )
    return pick_facade(photos)


def event_photos(spark, sf):
    """Events as photos: the day is the page, the moment the position on it."""
    label = (
        F.when(F.col("event_type") == "view", "fachada")
        .when(F.col("event_type") == "error", "outro")
        .otherwise(F.col("event_type"))
    )
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("codigo_laudo"),
        label.alias("label"),
        F.to_date("ts").alias("page"),
        F.col("ts").alias("pos"),
        "event_id",
        F.concat(F.lit("Vão "), (F.col("event_id") % 5).cast("string")).alias("caption"),
        F.lit("jpg").alias("ext"),
        F.md5(F.concat_ws("|", "user_id", (F.col("event_id") % 50))).alias("sha256"),
    )


FIRST_DAYS = "2024-01-11"
NAMES_SQL = """
  select event_id, codigo_laudo, n, 'laudo_' || codigo_laudo || '_' ||
         case when label = 'fachada' and n = 1 then 'img'
              when label = 'outro' then 'outro_' || n || '_vao_' || (event_id % 5)
              when n = 1 then label else label || '_' || n end || '.jpg' as file_name
  from (select event_id, cast(user_id as varchar) as codigo_laudo,
               case event_type when 'view' then 'fachada' when 'error' then 'outro'
                    else event_type end as label,
               cast(row_number() over (partition by user_id, event_type
                                       order by ts, event_id) as integer) as n
        from events)"""
EVENT_ORDER = ["page", "pos", "event_id"]


@query("name_photos", NAMES_SQL)
def names(spark, sf):
    """The first ten days are in the folder already; the rest go on from there."""
    photos = event_photos(spark, sf)
    old, new = (photos.filter(f"page {op} date'{FIRST_DAYS}'") for op in ("<", ">="))
    there = keep(name_photos(old, None, EVENT_ORDER), "names")
    added = name_photos(new, there.select("file_name"), EVENT_ORDER)
    return there.unionByName(added).select("event_id", "codigo_laudo", "n", "file_name")


@query(
    "photo_plan",
    f"""with p as (select cast(user_id as varchar) as codigo_laudo, event_id, ts,
                          case event_type when 'view' then 'fachada' when 'error' then 'outro'
                               else event_type end as label,
                          md5(user_id || '|' || event_id % 50) as sha256 from events),
             d as (select distinct codigo_laudo, sha256, label from (
                     select *, row_number() over (partition by codigo_laudo, sha256
                                                  order by ts, event_id) as rk
                     from p where ts >= date '{FIRST_DAYS}') where rk = 1),
             e as (select p.codigo_laudo, sha256, label, file_name
                   from (select *, row_number() over (partition by codigo_laudo, sha256
                                                      order by ts, event_id) as rk
                         from p where ts < date '{FIRST_DAYS}') as p
                   join ({NAMES_SQL}) as n on n.event_id = p.event_id
                   where rk = 1 and p.codigo_laudo in (select codigo_laudo from d))
        select coalesce(d.codigo_laudo, e.codigo_laudo) as codigo_laudo,
               coalesce(d.sha256, e.sha256) as sha256, coalesce(d.label, e.label) as label,
               case when e.file_name is null then 'add' when d.label is not null then 'keep'
                    else 'remove' end as action,
               case when d.label is null then '_removidas/' || file_name else file_name end
                 as target
        from d full join e on d.codigo_laudo = e.codigo_laudo and d.sha256 = e.sha256
                          and d.label = e.label""",
)
def plan(spark, sf):
    photos = event_photos(spark, sf)
    old, new = (photos.filter(f"page {op} date'{FIRST_DAYS}'") for op in ("<", ">="))
    named = keep(name_photos(old, None, EVENT_ORDER), "names")
    existing = dedupe_photos(named, ["pos", "event_id"])
    return photo_plan(dedupe_photos(new, ["pos", "event_id"]), existing)


@query(
    "room_equals_facade",
    """select lang as codigo_laudo, doc_id, source as label from documents as r
       where source <> 'src7' and exists (
         select 1 from documents as f
         where f.source = 'src7' and f.lang = r.lang and md5(f.text) = md5(r.text))""",
)
def rooms_like_facade(spark, sf):
    photos = table(spark, sf, "documents").select(
        F.col("lang").alias("codigo_laudo"),
        "doc_id",
        F.when(F.col("source") == "src7", "fachada").otherwise(F.col("source")).alias("label"),
        F.md5("text").alias("sha256"),
    )
    return room_equals_facade(photos).select("codigo_laudo", "doc_id", "label")

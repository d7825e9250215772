"""A2-A11 over orders, lineitem, part and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotewise.operators.selection import (
    assign_batches,
    batch_completeness,
    prefer_source,
    recheck_due,
    resume_point,
    select_reprocess,
    skip_seen,
    source_summary,
    split_excluded,
    update_ledger,
)
from lotewise.registry.base import quantile_sql, query, table

# the whole span of the orders table
START, END = "01/01/1995", "31/12/2001"


def _lots(days: int) -> str:
    number = f"(date_diff('day', date '1995-01-01', cast(o_orderdate as date)) // {days})"
    return f"""
      select o_orderkey, cast({number} as integer) as batch_no,
             cast(date '1995-01-01' + cast({number} * {days} as integer) as date) as batch_start,
             cast(least(date '1995-01-01' + cast({number} * {days} + {days - 1} as integer),
                        date '2001-12-31') as date) as batch_end
      from orders
      where o_orderdate >= date '1995-01-01' and o_orderdate < date '2002-01-01'"""


def _complete(days: int) -> str:
    return f"""
      select batch_no, batch_start, count(*) as n_expected, count(got) as n_received,
             count(got) / count(*) as share, count(got) = count(*) as complete
      from ({_lots(days)}) as lots
      left join (select distinct l_orderkey as got from lineitem) as g on got = o_orderkey
      group by batch_no, batch_start"""


@query("period_batches", _lots(31))
def period_batches(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return assign_batches(orders, "o_orderdate", START, END).drop("o_orderdate")


def _completeness(spark, sf, days):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    received = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    lots = assign_batches(orders, "o_orderdate", START, END, days)
    return batch_completeness(lots, received, ["batch_no", "batch_start"], "o_orderkey")


@query("batch_completeness", _complete(31))
def completeness_per_lot(spark, sf):
    return _completeness(spark, sf, 31)


@query(
    "resume_point",
    f"""select min(case when not complete then batch_start end) as resume_from,
               count_if(not complete)::bigint as n_incomplete, count(*) as n_batches
        from ({_complete(2)})""",
)
def resume(spark, sf):
    return resume_point(_completeness(spark, sf, 2))


@query(
    "skip_seen",
    "select * from orders where o_orderkey not in (select l_orderkey from lineitem)",
)
def not_seen(spark, sf):
    seen = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return skip_seen(table(spark, sf, "orders"), seen, "o_orderkey")


@query(
    "recheck_due",
    """with users as (select distinct user_id from events),
            last as (select user_id, cast(max(ts) as date) as d from events
                     where event_type = 'error' group by user_id)
       select users.user_id from users left join last on users.user_id = last.user_id
       where d is null or d + 7 <= date '2024-01-31'""",
)
def due_again(spark, sf):
    events = table(spark, sf, "events")
    users = events.select("user_id").distinct()
    checked = events.filter("event_type = 'error'").select("user_id", "ts")
    return recheck_due(users, checked, "user_id", "ts", "2024-01-31", 7)


@query(
    "select_reprocess",
    """with files as (select cast(o_orderkey as varchar) as codigo_laudo, * from orders),
            stored as (select * from files
                       where o_orderkey in (select l_orderkey from lineitem)),
            allowed as (select codigo_laudo, o_orderkey from files where o_orderstatus <> 'P')
       select 'new' as mode, codigo_laudo from allowed
       where codigo_laudo not in (select codigo_laudo from stored)
       union all select 'all', codigo_laudo from allowed
       union all select 'list', codigo_laudo from allowed
       where o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R')
       union all select 'no_address', codigo_laudo from allowed
       where codigo_laudo in (select codigo_laudo from stored
                              where o_orderpriority = '4-NOT SPECIFIED')""",
)
def reprocess_modes(spark, sf):
    lineitem = table(spark, sf, "lineitem")
    orders = table(spark, sf, "orders").withColumn(
        "codigo_laudo", F.col("o_orderkey").cast("string")
    )
    files = orders.select("codigo_laudo")
    loaded = lineitem.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    stored = orders.join(loaded, "o_orderkey", "left_semi").select(
        "codigo_laudo",
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", "rua").alias("logradouro"),
        F.lit("cidade").alias("municipio"),
    )
    excluded = orders.filter("o_orderstatus = 'P'").select("codigo_laudo")
    code = F.col("l_orderkey").cast("string")
    # a list of codes and file names, as an operator would write it
    listed = lineitem.filter("l_returnflag = 'R'").select(
        F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("laudo_"), code, F.lit(".pdf")))
        .otherwise(code)
        .alias("entry")
    )
    parts = [
        select_reprocess(files, stored, excluded, mode, listed).select(
            F.lit(mode).alias("mode"), "codigo_laudo"
        )
        for mode in ("new", "all", "list", "no_address")
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "prefer_source",
    """with api as (select l_orderkey as o_orderkey,
                           sum(cast(l_extendedprice as decimal(18,2))) as amount
                    from lineitem group by l_orderkey)
       select o_orderkey, cast(amount as decimal(18,2)) as amount, 'api' as via from api
       union all
       select o_orderkey, cast(o_totalprice as decimal(18,2)), 'tela' from orders
       where o_orderkey not in (select o_orderkey from api)""",
)
def api_then_screen(spark, sf):
    api = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("amount"))
        .withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    )
    screen = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("amount")
    )
    return prefer_source(api, screen, "o_orderkey")


@query(
    "source_summary",
    f"""with q as ({quantile_sql("events", "event_type", "value", {"median": 0.5, "p95": 0.95})})
        select e.event_type, count(*) as n_items,
               cast(sum(cast(value as decimal(18,2))) as double) / count(value) as mean,
               any_value(q.median) as median, any_value(q.p95) as p95, max(value) as slowest
        from events as e join q on q.event_type = e.event_type
        group by e.event_type""",
)
def calls_by_path(spark, sf):
    return source_summary(table(spark, sf, "events"), "event_type", "value")


@query(
    "split_excluded",
    """select *, p_type = 'PROMO' as excluded from part""",
)
def whole_developments(spark, sf):
    kept, out = split_excluded(table(spark, sf, "part"), F.col("p_type") == "PROMO")
    return kept.withColumn("excluded", F.lit(False)).unionByName(
        out.withColumn("excluded", F.lit(True))
    )


@query(
    "update_ledger",
    """select user_id, event_type as status, ts as checked_at
       from (select *, row_number() over (partition by user_id
                                          order by ts desc, event_type desc) as rk
             from events)
       where rk = 1""",
)
def ledger_after_run(spark, sf):
    events = table(spark, sf, "events").select(
        "user_id", F.col("event_type").alias("status"), F.col("ts").alias("checked_at")
    )
    cut = F.lit("2024-01-15").cast("date")
    return update_ledger(
        events.filter(F.col("checked_at") < cut),
        events.filter(F.col("checked_at") >= cut),
        "user_id",
    )

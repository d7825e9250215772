"""D1-D10 over lineitem, orders, supplier and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotewise.operators.checks import (
    canary_sample,
    field_checks,
    foreign_text,
    verdict,
)
from lotewise.operators.load import (
    Check,
    check_table,
    key_integrity,
    rewrite_verified,
    rows_with_parent,
    same_content,
    upsert,
)
from lotewise.registry.base import query, table
from lotewise.session import shared_dir

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_REST = [
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]
UPSERT_SQL = f"""
  select * exclude (rk) from (
    select *, row_number() over (
      partition by l_orderkey, l_linenumber
      order by l_shipdate desc nulls last,
               {", ".join(f"{c} desc nulls last" for c in LINE_REST)}) as rk
    from lineitem)
  where rk = 1"""


def shipped_split(spark, sf):
    """(shipped before 1999, the rest)."""
    lineitem = table(spark, sf, "lineitem")
    cut = F.lit("1999-01-01").cast("date")
    return lineitem.filter(F.col("l_shipdate") < cut), lineitem.filter(F.col("l_shipdate") >= cut)


@query("upsert", UPSERT_SQL)
def upsert_lines(spark, sf):
    before, after = shipped_split(spark, sf)
    return upsert(before, after, LINE_KEY, ["l_shipdate"])


def line_checks() -> list[Check]:
    return [
        Check("no discount", F.col("l_discount") == 0, 0.1),
        Check("absurd price", F.col("l_extendedprice") < 1500, 0.01),
        Check("returned", F.col("l_returnflag") == "R", 0.5),
    ]


CHECKS_SQL = """
  select {keys} n_rows, "check", n_bad, n_bad / n_rows as share, "limit",
         n_bad / n_rows <= "limit" as ok
  from (select {keys} count(*) as n_rows, count_if(l_discount = 0)::bigint as b1,
               count_if(l_extendedprice < 1500)::bigint as b2,
               count_if(l_returnflag = 'R')::bigint as b3
        from (select *, strftime(l_shipdate, '%Y-%m') as month from lineitem) {group}),
       lateral (values ('no discount', b1, 0.1::double), ('absurd price', b2, 0.01::double),
                       ('returned', b3, 0.5::double)) as v("check", n_bad, "limit")"""


@query("gate_report", CHECKS_SQL.format(keys="month,", group="group by month"))
def checks_by_month(spark, sf):
    lots = table(spark, sf, "lineitem").withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    return check_table(lots, line_checks(), by=["month"])


@query(
    "verdict",
    f"""select case when bool_and(ok) then 'may run' else 'do not run yet' end as verdict,
               count_if(not ok)::bigint as n_failed, count(*) as n_checks
        from ({CHECKS_SQL.format(keys="", group="")})""",
)
def lineitem_verdict(spark, sf):
    return verdict(check_table(table(spark, sf, "lineitem"), line_checks()))


@query(
    "field_checks",
    """with seen as (select distinct l_orderkey from lineitem)
       select o_orderkey, 'address empty' as "check" from orders
       where o_orderpriority = '4-NOT SPECIFIED'
       union all select o_orderkey, 'value absurd' from orders where o_totalprice < 2000
       union all select o_orderkey, 'no samples' from orders
       where o_orderkey not in (select l_orderkey from seen)""",
)
def order_problems(spark, sf):
    with_lines = (
        table(spark, sf, "lineitem")
        .select(F.col("l_orderkey").alias("o_orderkey"))
        .distinct()
        .withColumn("has_samples", F.lit(True))
    )
    orders = table(spark, sf, "orders").join(with_lines, "o_orderkey", "left")
    return field_checks(
        orders,
        "o_orderkey",
        {
            "address empty": F.col("o_orderpriority") == "4-NOT SPECIFIED",
            "value absurd": F.col("o_totalprice") < 2000,
            "no samples": F.col("has_samples").isNull(),
        },
    )


@query(
    "foreign_text",
    """select doc_id, item_id from documents join benchmark
       on contains(documents.text, benchmark.text)""",
)
def contaminated(spark, sf):
    return foreign_text(
        table(spark, sf, "documents"),
        "doc_id",
        "text",
        table(spark, sf, "benchmark"),
        "item_id",
        "text",
    )


@query(
    "rows_with_parent",
    """select l_orderkey as codigo_laudo, l_linenumber, l_extendedprice, o_orderstatus,
              o_orderdate
       from lineitem join orders on l_orderkey = o_orderkey""",
)
def lines_with_order(spark, sf):
    samples = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("codigo_laudo"), "l_linenumber", "l_extendedprice"
    )
    reports = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("codigo_laudo"), "o_orderstatus", "o_orderdate"
    )
    return rows_with_parent(samples, reports, "codigo_laudo")


@query(
    "key_integrity",
    """with per_key as (select l_orderkey, l_linenumber, count(*) as n from lineitem
                        group by l_orderkey, l_linenumber)
       select 'duplicate_key' as problem, count(*) as n_keys,
              coalesce(sum(n), 0)::bigint as n_rows
       from per_key where n > 1
       union all
       select 'orphan', count(*), coalesce(sum(n), 0)::bigint from per_key
       where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'P')""",
)
def line_keys(spark, sf):
    # orders with status P are left out of the parents, so that there are orphans
    parents = table(spark, sf, "orders").filter("o_orderstatus <> 'P'")
    return key_integrity(
        table(spark, sf, "lineitem"),
        LINE_KEY,
        parents.select(F.col("o_orderkey").alias("l_orderkey")),
        "l_orderkey",
    )


@query(
    "canary_sample",
    """with latest as (select *, 'recent' as draw from orders
                       order by o_orderdate desc, o_orderkey desc limit 20)
       select * from latest union all
       select * from (select *, 'random' as draw from orders
                      where o_orderkey not in (select o_orderkey from latest)
                      order by md5('7|' || cast(o_orderkey as varchar)), o_orderkey limit 40)""",
)
def canary(spark, sf):
    return canary_sample(table(spark, sf, "orders"), "o_orderkey", "o_orderdate")


@query(
    "rewrite_verified",
    "select s_suppkey, s_acctbal, s_name, s_nationkey from supplier",
)
def moved_column(spark, sf):
    supplier = table(spark, sf, "supplier")
    return rewrite_verified(supplier, "s_acctbal", "s_suppkey", shared_dir(spark, "rewrite"))


@query(
    "same_content",
    """select 'reordered' as compared, 0::bigint as n_only_left, 0::bigint as n_only_right,
              true as same
       union all
       select 'doubled', 0, count_if(l_orderkey = 0)::bigint, count_if(l_orderkey = 0) = 0
       from lineitem""",
)
def compared(spark, sf):
    lineitem = table(spark, sf, "lineitem")
    reordered = lineitem.select(*reversed(lineitem.columns))
    doubled = lineitem.unionByName(lineitem.filter("l_orderkey = 0"))
    first = same_content(lineitem, reordered).withColumn("compared", F.lit("reordered"))
    second = same_content(lineitem, doubled).withColumn("compared", F.lit("doubled"))
    return first.unionByName(second)

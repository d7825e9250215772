"""C1-C8 over values printed the Brazilian way and read back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotewise.functions.dates import br_date
from lotewise.functions.numbers import AREA, MONEY, br_number, order_number, unit_value
from lotewise.functions.places import address_parts, coordinates
from lotewise.functions.text import join_list, split_list
from lotewise.operators.normalise import fill_not_applicable, normalise
from lotewise.registry.base import query, table


def printed_money(col: str) -> Column:
    """`68423.46` as `68.423,46`."""
    return F.translate(F.format_number(F.col(col).cast("decimal(18,2)"), 2), ",.", ".,")


@query(
    "br_number",
    """select 'part' as origem, p_partkey as k1, 0 as k2,
              cast(p_retailprice as decimal(18,2)) as valor, cast(null as decimal(18,2)) as area
       from part
       union all
       select 'lineitem', l_orderkey, l_linenumber, cast(l_extendedprice as decimal(18,2)),
              cast(case when l_quantity < 10 then l_quantity * 1000 else l_quantity end
                   as decimal(18,2))
       from lineitem""",
)
def printed_numbers(spark, sf):
    part = table(spark, sf, "part").select(
        F.lit("part").alias("origem"),
        F.col("p_partkey").alias("k1"),
        F.lit(0).alias("k2"),
        F.concat(F.lit("R$ "), printed_money("p_retailprice")).alias("valor"),
        F.lit(None).cast("string").alias("area"),
    )
    # quantities with three decimals: the area rule decides what the dot means
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"
    )
    lineitem = lines.select(
        F.lit("lineitem").alias("origem"),
        F.col("l_orderkey").alias("k1"),
        F.col("l_linenumber").alias("k2"),
        printed_money("l_extendedprice").alias("valor"),
        F.concat(F.col("l_quantity").cast("decimal(12,3)").cast("string"), F.lit(" m²")).alias(
            "area"
        ),
    )
    return part.unionByName(lineitem).withColumns(
        {"valor": br_number("valor", MONEY), "area": br_number("area", AREA)}
    )


@query(
    "br_date",
    """select o_orderkey, case when o_orderstatus <> 'P' then cast(o_orderdate as date) end
              as data_avaliacao from orders""",
)
def printed_dates(spark, sf):
    shown = F.date_format(F.to_date("o_orderdate"), "dd/MM/yyyy")
    # a day that no month has, for the orders with status P
    shown = F.when(F.col("o_orderstatus") == "P", F.regexp_replace(shown, "^..", "32")).otherwise(
        shown
    )
    return table(spark, sf, "orders").select("o_orderkey", br_date(shown).alias("data_avaliacao"))


@query(
    "coordinates",
    """select c_custkey, case when ok then la / 1000.0::double end as latitude,
              case when ok then lo / 1000.0::double end as longitude
       from (select c_custkey, la, lo, abs(la) <= 90000 and abs(lo) <= 180000 as ok
             from (select c_custkey, c_custkey * 3701 % 190001 - 95000 as la,
                          c_custkey * 9103 % 400001 - 200000 as lo from customer))""",
)
def printed_coordinates(spark, sf):
    def printed(thousandths: str) -> Column:
        degrees = F.expr(f"cast(({thousandths}) / 1000 as decimal(9,3))").cast("string")
        return F.replace(degrees, F.lit("."), F.lit(","))

    text = F.concat(
        printed("c_custkey * 3701 % 190001 - 95000"),
        F.lit(" / "),
        printed("c_custkey * 9103 % 400001 - 200000"),
    )
    parsed = coordinates(text)
    return table(spark, sf, "customer").select("c_custkey", parsed.alias("c")).select(
        "c_custkey", "c.latitude", "c.longitude"
    )


@query(
    "address_parts",
    """select c_custkey, 'Rua ' || c_name as logradouro,
              case when c_custkey % 4 = 0 then 'S/N' else cast(c_custkey as varchar) end as numero,
              case when c_custkey % 3 = 0 then 'Bloco ' || cast(c_custkey % 9 as varchar) end
                as complemento,
              c_mktsegment as bairro, n_name as municipio, 'BR' as uf,
              case when c_custkey % 5 <> 0
                   then lpad(cast(c_custkey % 100000 as varchar), 5, '0') || '-'
                        || lpad(cast(c_custkey % 1000 as varchar), 3, '0') end as cep
       from customer join nation on c_nationkey = n_nationkey""",
)
def printed_addresses(spark, sf):
    key = F.col("c_custkey")
    postcode = F.concat(
        F.lit(" - CEP "),
        F.lpad((key % 100000).cast("string"), 5, "0"),
        F.lit("-"),
        F.lpad((key % 1000).cast("string"), 3, "0"),
    )
    text = F.concat(
        F.lit("Rua "),
        F.col("c_name"),
        F.lit(", "),
        F.when(key % 4 == 0, "s/n").otherwise(key.cast("string")),
        F.when(key % 3 == 0, F.concat(F.lit(", Bloco "), (key % 9).cast("string"))).otherwise(""),
        F.lit(", "),
        F.col("c_mktsegment"),
        F.lit(" - "),
        F.col("n_name"),
        F.lit("/BR"),
        F.when(key % 5 != 0, postcode).otherwise(""),
    )
    customers = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return customers.select("c_custkey", address_parts(text).alias("a")).select(
        "c_custkey", "a.*"
    )


@query(
    "order_number",
    "select o_orderkey, cast(o_orderkey as varchar) as numero_pedido from orders",
)
def printed_order_numbers(spark, sf):
    shown = F.translate(F.format_number("o_orderkey", 0), ",", ".")
    return table(spark, sf, "orders").select(
        "o_orderkey", order_number(shown).alias("numero_pedido")
    )


@query(
    "split_list",
    """select p_partkey, cast(len(list_distinct([p_type, p_brand, p_name])) as integer) as n_itens,
              p_type || ';' || p_brand || ';' || p_name as lista from part""",
)
def lists(spark, sf):
    shown = F.concat_ws(" ; ", "p_type", "p_brand", F.lit(""), "p_type", "p_name")
    items = split_list(shown)
    return table(spark, sf, "part").select(
        "p_partkey", F.size(items).alias("n_itens"), join_list(items).alias("lista")
    )


# value, area and printed value in hundredths; half up, as decimals are rounded
UNIT_SQL = """
  select l_orderkey, l_linenumber,
         cast(case when printed <> 0 then printed / 100.0
                   when area > 0 then ((200 * v + area) // (2 * area)) / 100.0 end
              as decimal(18,2)) as valor_m2
  from (select l_orderkey, l_linenumber,
               cast(cast(l_extendedprice as decimal(18,2)) * 100 as hugeint) as v,
               cast(case when p_type = 'ECONOMY' then p_size * 100
                         else cast(l_quantity as decimal(12,2)) * 100 end as hugeint) as area,
               coalesce(case when l_linenumber = 1
                             then cast(cast(l_discount as decimal(18,2)) * 100 as hugeint)
                             end, 0) as printed
        from lineitem join part on l_partkey = p_partkey)"""


@query("unit_value", UNIT_SQL)
def value_per_area(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_type", "p_size")
    lineitem = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", "l_discount"
    )
    joined = lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
    printed = F.when(F.col("l_linenumber") == 1, F.col("l_discount").cast("decimal(18,2)"))
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        unit_value(
            printed,
            F.col("l_extendedprice").cast("decimal(18,2)"),
            F.col("l_quantity").cast("decimal(12,2)"),
            F.col("p_size").cast("decimal(14,2)"),
            F.col("p_type") == "ECONOMY",
        ).alias("valor_m2"),
    )


@query(
    "fill_not_applicable",
    """select p_partkey, case when p_type = 'PROMO' then '' else p_name end as p_name, p_type,
              cast(case when p_type = 'ECONOMY' then 0 else p_size end as integer) as p_size
       from part""",
)
def not_carried(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_size")
    return fill_not_applicable(
        part,
        [(F.col("p_type") == "ECONOMY", ["p_size"]), (F.col("p_type") == "PROMO", ["p_name"])],
    )


@query(
    "normalise_failures",
    """select 'valor' as field, count(*) as n_present,
              count_if(o_orderpriority = '1-URGENT')::bigint as n_unparsed from orders
       union all
       select 'data', count_if(o_orderpriority <> '4-NOT SPECIFIED')::bigint,
              count_if(o_orderstatus = 'P' and o_orderpriority <> '4-NOT SPECIFIED')::bigint
       from orders
       union all select 'pedido', count(*), 0 from orders""",
)
def unread(spark, sf):
    shown = F.date_format(F.to_date("o_orderdate"), "dd/MM/yyyy")
    raw = table(spark, sf, "orders").select(
        F.when(F.col("o_orderpriority") == "1-URGENT", "a combinar")
        .otherwise(printed_money("o_totalprice"))
        .alias("valor"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", " ")
        .when(F.col("o_orderstatus") == "P", F.regexp_replace(shown, "/../", "/13/"))
        .otherwise(shown)
        .alias("data"),
        F.format_number("o_orderkey", 0).alias("pedido"),
    )
    return normalise(raw, {"valor": "money", "data": "date", "pedido": "order_number"})[1]

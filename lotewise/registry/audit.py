"""E1-E7 over orders, documents, customer and lineitem."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lotewise.operators.audit import accuracy_by_field, reconcile, reconcile_samples
from lotewise.operators.checks import foreign_labels, foreign_text, random_sample
from lotewise.operators.quality import (
    empty_fields,
    incoherent_values,
    outliers,
    quality_report,
)
from lotewise.registry.base import quantile_sql, query, table

SAMPLE_SQL = """select * from orders
  order by md5('7|' || cast(o_orderkey as varchar)), o_orderkey limit 500"""


@query("random_sample", SAMPLE_SQL)
def drawn(spark, sf):
    return random_sample(table(spark, sf, "orders"), "o_orderkey", 500)


# Planted readings, by key: which of the three readings is off.
RECONCILE_SQL = """
  with r as (
    select 'documents' as base, cast(doc_id as varchar) as codigo, 'n_chars' as field,
           n_chars + case doc_id % 10 when 1 then 5 when 2 then 3 else 0 end as stored,
           n_chars + case doc_id % 10 when 2 then 3 when 4 then 9 else 0 end as printed,
           case when doc_id % 10 <> 3 then n_chars end as second,
           case when doc_id % 10 = 5 then 'final' else 'calculo' end as source
    from documents
    union all
    select 'orders', cast(o_orderkey as varchar), 'total',
           t + case o_orderkey % 7 when 1 then 1 else 0 end,
           t + case o_orderkey % 7 when 2 then 2 else 0 end,
           case when o_orderkey % 11 = 0 then t + 2 else t end,
           case when o_orderkey % 11 = 0 then 'final' else 'calculo' end
    from (select *, cast(o_totalprice as decimal(18,2)) as t from orders)),
  texts as (
    select 'orders' as base, cast(o_orderkey as varchar) as codigo, 'prioridade' as field,
           case when o_orderkey % 9 = 1 then 'x' else o_orderpriority end as stored,
           case when o_orderkey % 9 = 1 and o_orderstatus = 'F' then 'X' else o_orderpriority
                end as printed,
           ' ' || lower(o_orderpriority) as second, 'final' as source
    from orders)
  select base, codigo, field, cast(stored as varchar) as stored,
         cast(second as varchar) as second, source,
         case when abs(stored - second) <= 0.01 then 'match'
              when abs(stored - printed) <= 0.01 then 'inconsistent report'
              else 'extraction error' end as outcome
  from (select base, codigo, field, stored, printed, second, source from r
        where base = 'orders' and second is not null)
  union all
  select base, codigo, field, cast(cast(stored as bigint) as varchar),
         cast(cast(second as bigint) as varchar), source,
         case when abs(stored - second) <= 0.01 then 'match'
              when abs(stored - printed) <= 0.01 then 'inconsistent report'
              else 'extraction error' end
  from r where base = 'documents' and second is not null
  union all
  select base, codigo, field, stored, second, source,
         case when lower(trim(stored)) = trim(second) then 'match'
              when lower(stored) = lower(printed) then 'inconsistent report'
              else 'extraction error' end
  from texts"""


def reconciled_orders(spark, sf):
    money = "decimal(18,2)"
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.col("o_totalprice").cast(money).alias("t"),
        F.col("o_orderpriority").alias("p"),
        F.col("o_orderstatus").alias("s"),
    )

    def shifted(mod: int, on: int, by: int):
        return F.col("t") + F.when(F.col("k") % mod == on, by).otherwise(0).cast(money)

    code = F.col("k").cast("string").alias("codigo")
    wrong = F.col("k") % 9 == 1
    stored = orders.select(
        code,
        shifted(7, 1, 1).cast(money).alias("total"),
        F.when(wrong, "x").otherwise(F.col("p")).alias("prioridade"),
    )
    printed = orders.select(
        code,
        shifted(7, 2, 2).cast(money).alias("total"),
        F.when(wrong & (F.col("s") == "F"), "X").otherwise(F.col("p")).alias("prioridade"),
    )
    # the calculation table lacks some totals, the final one has them all
    calculo = orders.select(
        code,
        F.lit("calculo").alias("source"),
        F.when(F.col("k") % 11 != 0, F.col("t")).alias("total"),
        F.lit(None).cast("string").alias("prioridade"),
    )
    final = orders.select(
        code,
        F.lit("final").alias("source"),
        (F.col("t") + F.lit(2).cast(money)).cast(money).alias("total"),
        F.concat(F.lit(" "), F.lower("p")).alias("prioridade"),
    )
    return reconcile(
        stored,
        printed,
        calculo.unionByName(final),
        ["codigo"],
        {"total": "number", "prioridade": "text"},
        ["calculo", "final"],
    )


def reconciled_documents(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "n_chars", "text")
    last = F.col("doc_id") % 10
    code = F.col("doc_id").cast("string").alias("codigo")

    def shifted(steps: dict[int, int]):
        shift = F.lit(0)
        for digit, by in steps.items():
            shift = F.when(last == digit, by).otherwise(shift)
        return (F.col("n_chars") + shift).alias("n_chars")

    counted = F.length("text").cast("long")
    second = documents.select(
        code,
        F.lit("calculo").alias("source"),
        F.when(~last.isin(3, 5), counted).alias("n_chars"),
    ).unionByName(
        documents.select(
            code, F.lit("final").alias("source"), F.when(last == 5, counted).alias("n_chars")
        )
    )
    return reconcile(
        documents.select(code, shifted({1: 5, 2: 3})),
        documents.select(code, shifted({2: 3, 4: 9})),
        second,
        ["codigo"],
        {"n_chars": "number"},
        ["calculo", "final"],
    )


@query("reconcile", RECONCILE_SQL)
def second_reading(spark, sf):
    return (
        reconciled_orders(spark, sf)
        .withColumn("base", F.lit("orders"))
        .unionByName(reconciled_documents(spark, sf).withColumn("base", F.lit("documents")))
    )


@query(
    "accuracy_by_field",
    f"""select field, count(*) as n_comparable,
               count_if(outcome = 'match')::bigint as n_match,
               count_if(outcome = 'inconsistent report')::bigint as n_inconsistent,
               count_if(outcome = 'extraction error')::bigint as n_error,
               count_if(outcome <> 'extraction error')::bigint / count(*) as accuracy
        from ({RECONCILE_SQL}) group by field""",
)
def hit_rate(spark, sf):
    return accuracy_by_field(second_reading(spark, sf))


def _customers(spark, sf):
    # balances below zero read as zero, one segment as not filled in
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).otherwise(0.0).alias("c_acctbal"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
        .otherwise(" ")
        .alias("c_mktsegment"),
    )


EMPTY_SQL = """
  select 'customer' as base, 'c_custkey' as field, count(*) as n_rows, 0::bigint as n_empty,
         count_if(c_custkey = 0)::bigint as n_zero from customer
  union all select 'customer', 'c_acctbal', count(*), 0, count_if(c_acctbal <= 0)::bigint
  from customer
  union all select 'customer', 'c_mktsegment', count(*),
                   count_if(c_mktsegment = 'BUILDING')::bigint, 0 from customer
  union all select 'documents', 'doc_id', count(*), count_if(doc_id is null)::bigint,
                   count_if(doc_id = 0)::bigint from documents
  union all select 'documents', 'text', count(*),
                   count_if(text is null or trim(text) = '')::bigint, 0 from documents
  union all select 'documents', 'lang', count(*),
                   count_if(lang is null or trim(lang) = '')::bigint, 0 from documents
  union all select 'documents', 'source', count(*),
                   count_if(source is null or trim(source) = '')::bigint, 0 from documents
  union all select 'documents', 'n_chars', count(*), count_if(n_chars is null)::bigint,
                   count_if(n_chars = 0)::bigint from documents"""


def _empties(spark, sf):
    return (
        empty_fields(_customers(spark, sf))
        .withColumn("base", F.lit("customer"))
        .unionByName(
            empty_fields(table(spark, sf, "documents")).withColumn("base", F.lit("documents"))
        )
    )


@query("empty_fields", EMPTY_SQL)
def empties(spark, sf):
    return _empties(spark, sf)


INCOHERENT_SQL = """
  select l_orderkey, l_linenumber, rule from (
    select l_orderkey, l_linenumber, unnest([
        case when l_shipdate < o_orderdate then 'shipped before ordered' end,
        case when l_extendedprice > o_totalprice then 'line over total' end]) as rule
    from lineitem join orders on l_orderkey = o_orderkey)
  where rule is not null"""


@query("incoherent_values", INCOHERENT_SQL)
def contradictions(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice"
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return incoherent_values(
        joined,
        ["l_orderkey", "l_linenumber"],
        {
            "shipped before ordered": F.col("l_shipdate") < F.col("o_orderdate"),
            "line over total": F.col("l_extendedprice") > F.col("o_totalprice"),
        },
    )


PRICES = """(select l_orderkey, l_linenumber, p_type, l_extendedprice / l_quantity as unit
             from lineitem join part on l_partkey = p_partkey)"""
OUTLIERS_SQL = f"""
  with q as ({quantile_sql(PRICES, "p_type", "unit", {"q1": 0.25, "q3": 0.75})}),
       f as (select p_type, q1 - 1.5::double * (q3 - q1) as low,
                    q3 + 1.5::double * (q3 - q1) as high from q)
  select l_orderkey, l_linenumber, p.p_type, unit, low, high
  from {PRICES} as p join f on f.p_type = p.p_type where unit < low or unit > high"""


@query("outliers", OUTLIERS_SQL)
def far_off(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_type")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity"
    )
    unit = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey",
        "l_linenumber",
        "p_type",
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit"),
    )
    return outliers(unit, "unit", ["p_type"])


@query(
    "quality_report",
    f"""select 'empty' as section, base || '.' || field as "check", 'empty' as key,
               cast(n_empty as varchar) as value from ({EMPTY_SQL})
        union all select 'empty', base || '.' || field, 'zero', cast(n_zero as varchar)
        from ({EMPTY_SQL})
        union all select 'incoherent', rule, l_orderkey || '-' || l_linenumber, null
        from ({INCOHERENT_SQL})
        union all select 'contaminated', 'item ' || item_id, cast(doc_id as varchar), null
        from (select doc_id, item_id from documents join benchmark
              on contains(documents.text, benchmark.text))
        union all select 'outlier', p_type, l_orderkey || '-' || l_linenumber, null
        from ({OUTLIERS_SQL})
        union all select 'sample', 'look up by eye', cast(o_orderkey as varchar), o_orderstatus
        from ({SAMPLE_SQL})""",
)
def everything(spark, sf):
    none = F.lit(None).cast("string").alias("value")
    line = F.concat_ws("-", "l_orderkey", "l_linenumber").alias("key")
    counts = _empties(spark, sf).select(
        F.concat_ws(".", "base", "field").alias("check"),
        F.inline(
            F.array(
                F.struct(F.lit("empty").alias("key"), F.col("n_empty").alias("value")),
                F.struct(F.lit("zero").alias("key"), F.col("n_zero").alias("value")),
            )
        ),
    )
    foreign = foreign_text(
        table(spark, sf, "documents"),
        "doc_id",
        "text",
        table(spark, sf, "benchmark"),
        "item_id",
        "text",
    )
    return quality_report(
        {
            "empty": counts,
            "incoherent": contradictions(spark, sf).select(F.col("rule").alias("check"), line, none),
            "contaminated": foreign.select(
                F.concat_ws(" ", F.lit("item"), "item_id").alias("check"),
                F.col("doc_id").alias("key"),
                none,
            ),
            "outlier": far_off(spark, sf).select(F.col("p_type").alias("check"), line, none),
            "sample": drawn(spark, sf).select(
                F.lit("look up by eye").alias("check"),
                F.col("o_orderkey").alias("key"),
                F.col("o_orderstatus").alias("value"),
            ),
        }
    )


SAMPLE_FIELDS = {
    "valor": "number", "area_privativa": "number", "idade": "number", "endereco": "text",
    "padrao": "text", "conservacao": "text", "url": "text",
}
SAMPLES_SQL = f"""
  with drawn as ({SAMPLE_SQL}),
       s as (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_extendedprice,
                                          l_quantity, l_shipdate) as n
             from lineitem where l_orderkey in (select o_orderkey from drawn)),
       v as (select cast(l_orderkey as varchar) as codigo_laudo, n::int as numero_amostra,
                    cast(l_extendedprice as decimal(18,2)) as valor, cast(floor(l_quantity) as bigint) as area,
                    cast(round(l_discount * 100) as bigint) as idade, l_partkey, l_suppkey, l_returnflag, l_linestatus from s),
       f as (
         select codigo_laudo, numero_amostra, 'valor' as field, cast(valor as varchar) as stored,
                cast(valor + case when l_partkey % 10 = 1 then 5 else 0 end as varchar) as second,
                case when l_partkey % 10 = 1 then 'inconsistent report' else 'match' end as outcome from v
         union all
         select codigo_laudo, numero_amostra, 'area_privativa', cast(area + case when l_partkey % 13 = 1 then 1 else 0 end as varchar),
                cast(area as varchar), case when l_partkey % 13 = 1 then 'extraction error' else 'match' end from v
         union all select codigo_laudo, numero_amostra, 'idade', cast(idade as varchar), cast(idade as varchar), 'match' from v
         union all select codigo_laudo, numero_amostra, 'endereco', 'Rua ' || l_partkey, 'RUA  ' || l_partkey, 'match' from v
         union all select codigo_laudo, numero_amostra, 'padrao', l_returnflag, l_returnflag, 'match' from v
         union all select codigo_laudo, numero_amostra, 'conservacao', l_linestatus, l_linestatus, 'match' from v
         union all select codigo_laudo, numero_amostra, 'url', 's' || l_suppkey, 's' || l_suppkey, 'match' from v
                   where l_suppkey % 7 <> 0)
  select *, 'calculo' as source from f"""


@query("reconcile_samples", SAMPLES_SQL)
def renumbered(spark, sf):
    """Samples of 500 drawn reports; the second source numbers them from the end, and some fields are off on either side."""
    drawn_reports = random_sample(table(spark, sf, "orders"), "o_orderkey", 500).select(F.col("o_orderkey").alias("l_orderkey"))
    order = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", "l_shipdate")
    lines = table(spark, sf, "lineitem").withColumn("n", F.row_number().over(order))
    n_of_report = F.count(F.lit(1)).over(W.partitionBy("l_orderkey"))
    lines = lines.withColumn("back", (n_of_report - F.col("n") + 1).cast("int"))
    area = F.floor("l_quantity")
    right = {
        "valor": F.col("l_extendedprice").cast("decimal(18,2)"),
        "area_privativa": area,
        "idade": F.round(F.col("l_discount") * 100).cast("long"),
        "endereco": F.concat(F.lit("Rua "), F.col("l_partkey").cast("string")),
        "padrao": F.col("l_returnflag"),
        "conservacao": F.col("l_linestatus"),
        "url": F.concat(F.lit("s"), F.col("l_suppkey").cast("string")),
    }
    code = F.col("l_orderkey").cast("string").alias("codigo_laudo")

    def read(number: str, **off) -> DataFrame:
        return lines.select(
            "l_orderkey", code, F.col(number).cast("int").alias("numero_amostra"), *(c.alias(f) for f, c in (right | off).items())
        )

    wrong_value = right["valor"] + F.when(F.col("l_partkey") % 10 == 1, 5).otherwise(0)
    second = read(
        "back",
        valor=wrong_value.cast("decimal(18,2)"),
        endereco=F.concat(F.lit("RUA  "), F.col("l_partkey").cast("string")),
        url=F.when(F.col("l_suppkey") % 7 != 0, right["url"]),
    ).withColumn("source", F.lit("calculo"))
    stored = read("n", area_privativa=area + F.when(F.col("l_partkey") % 13 == 1, 1).otherwise(0))
    stored = stored.join(drawn_reports, "l_orderkey", "left_semi")
    return reconcile_samples(stored, read("n"), second, "codigo_laudo", "numero_amostra", SAMPLE_FIELDS, ["calculo"], least=4)


@query(
    "foreign_labels",
    """with cells as (
         select doc_id, "column", text from (
           select doc_id, unnest(['texto', 'idioma', 'fonte']) as "column", unnest([text, lang, source]) as text
           from documents) where text is not null),
       labels as (select text as label, case item_id % 3 when 0 then 'texto' when 1 then 'idioma' else 'outro' end as field
                  from benchmark union all select distinct lang, 'idioma' from documents union all select 'Source', 'texto')
       select doc_id, "column", label from cells join labels on contains(lower("text"), lower(label)) and "column" <> field""",
)
def labels_of_other_columns(spark, sf):
    """Passages and language codes as printed labels; one in its own column is no contamination."""
    documents = table(spark, sf, "documents").select(
        "doc_id", F.col("text").alias("texto"), F.col("lang").alias("idioma"), F.col("source").alias("fonte")
    )
    item = F.col("item_id") % 3
    field = F.when(item == 0, "texto").when(item == 1, "idioma").otherwise("outro")
    labels = table(spark, sf, "benchmark").select(F.col("text").alias("label"), field.alias("field"))
    codes = documents.select(F.col("idioma").alias("label"), F.lit("idioma").alias("field")).distinct()
    word = spark.range(1).select(F.lit("Source").alias("label"), F.lit("texto").alias("field"))
    return foreign_labels(documents, "doc_id", ["texto", "idioma", "fonte"], labels.unionByName(codes).unionByName(word))

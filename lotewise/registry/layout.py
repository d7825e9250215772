"""B1-B8 over texts and tables laid out as words on pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotewise.operators.extraction import (
    checked_options,
    explode_samples,
    explode_units,
    legacy_fields,
    options_on_pages,
)
from lotewise.operators.layout import (
    cluster_lines,
    grid_fields,
    line_texts,
    resolve_labels,
    route_layout,
)
from lotewise.registry.base import query, table

MODEL_SQL = """case when not contains(text, chr(10)) then 'legacy'
                    when contains(text, 'License') then 'fisico' else 'digital' end"""


@query("route_layout", f"select doc_id, {MODEL_SQL} as modelo from documents")
def models(spark, sf):
    return route_layout(table(spark, sf, "documents"), "doc_id", "text", "\n", "License")


def document_words(spark, sf):
    """Documents as printed pages of 50 lines, 12 points apart, words a little uneven."""
    lines = table(spark, sf, "documents").select("doc_id", "text").select(
        F.col("doc_id").cast("string").alias("codigo_laudo"),
        F.posexplode(F.split("text", "\n")).alias("i", "row"),
    )
    words = lines.select(
        "codigo_laudo", "i", F.posexplode(F.split("row", " ")).alias("j", "text")
    )
    top = (F.col("i") % 50) * 12 + (F.col("j") % 7) / 10
    return words.select(
        "codigo_laudo",
        (F.floor(F.col("i") / 50) + 1).cast("int").alias("page"),
        (F.col("j") * 40.0).alias("x0"),
        (F.col("j") * 40.0 + 36.0).alias("x1"),
        top.alias("top"),
        (top + 10).alias("bottom"),
        "text",
    )


@query(
    "cluster_lines",
    """select cast(doc_id as varchar) as codigo_laudo,
              cast((i - 1) // 50 + 1 as integer) as page,
              cast((i - 1) % 50 as integer) as line, text
       from (select doc_id, unnest(string_split(text, chr(10))) as text,
                    generate_subscripts(string_split(text, chr(10)), 1) as i
             from documents)""",
)
def lines_of_words(spark, sf):
    return line_texts(cluster_lines(document_words(spark, sf)))


GRID = ["Valor Total", "Situação", "Prioridade"]


def order_words(spark, sf):
    """Each order printed as a grid of three columns, the value under its label."""
    cells = F.array(
        *(
            F.struct(
                F.lit(200.0 * i).alias("x"), F.lit(y).alias("y"), value.alias("phrase")
            )
            for i, (label, col) in enumerate(
                zip(
                    GRID,
                    (
                        F.col("o_totalprice").cast("decimal(18,2)").cast("string"),
                        F.col("o_orderstatus"),
                        F.col("o_orderpriority"),
                    ),
                )
            )
            for y, value in ((100.0, F.lit(label)), (115.0, col))
        ),
        # the last value runs on over a second line
        F.struct(
            F.lit(400.0).alias("x"),
            F.lit(130.0).alias("y"),
            F.concat(F.lit("pedido "), F.col("o_orderkey").cast("string")).alias("phrase"),
        ),
    )
    orders = table(spark, sf, "orders").drop("o_custkey", "o_orderdate")
    phrases = orders.select(
        F.col("o_orderkey").cast("string").alias("codigo_laudo"), F.explode(cells).alias("c")
    )
    words = phrases.select(
        "codigo_laudo", "c.x", "c.y", F.posexplode(F.split("c.phrase", " ")).alias("j", "text")
    )
    x0 = F.col("x") + F.col("j") * 60.0
    return words.select(
        "codigo_laudo",
        F.lit(1).alias("page"),
        x0.alias("x0"),
        (x0 + 56.0).alias("x1"),
        "y",
        "text",
    ).select(
        "codigo_laudo",
        "page",
        "x0",
        "x1",
        F.col("y").alias("top"),
        (F.col("y") + 10).alias("bottom"),
        "text",
    )


@query(
    "grid_fields",
    """select cast(o_orderkey as varchar) as codigo_laudo, 'valor total' as label,
              cast(cast(o_totalprice as decimal(18,2)) as varchar) as value from orders
       union all select cast(o_orderkey as varchar), 'situacao', o_orderstatus from orders
       union all select cast(o_orderkey as varchar), 'prioridade',
                        o_orderpriority || ' pedido ' || o_orderkey from orders""",
)
def grid(spark, sf):
    return grid_fields(order_words(spark, sf), GRID).select("codigo_laudo", "label", "value")


# Printed label -> field, lowest priority number first.
ALIASES = [
    ("N° do Pedido", "numero_pedido", 1),
    ("N° da Proposta", "numero_pedido", 2),
    ("Inscrição Municipal", "iptu", 1),
    ("IPTU", "iptu", 2),
]


@query(
    "resolve_labels",
    """select codigo_laudo, field, value from (
         select codigo_laudo, field, value,
                row_number() over (partition by codigo_laudo, field order by prio, value) as rk
         from (select cast(user_id as varchar) as codigo_laudo,
                      case when event_type in ('click', 'view') then 'numero_pedido'
                           else 'iptu' end as field,
                      case when event_type in ('click', 'purchase') then 1 else 2 end as prio,
                      cast(event_id as varchar) as value
               from events where event_type <> 'error'))
       where rk = 1""",
)
def aliased(spark, sf):
    printed = (
        F.when(F.col("event_type") == "click", "Nº do Pedido:")
        .when(F.col("event_type") == "view", "N° da  PROPOSTA")
        .when(F.col("event_type") == "purchase", "inscricao municipal")
        .when(F.col("event_type") == "signup", "IPTU:")
        .otherwise("Rodapé")
    )
    raw = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("codigo_laudo"),
        printed.alias("label"),
        F.col("event_id").cast("string").alias("value"),
    )
    return resolve_labels(raw, ALIASES)


EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z]+"
PATTERNS = {
    "fisico": {"email": EMAIL, "numero": r"([0-9]{5,})", "licenca": r"License([^\n]*)"},
    "digital": {"email": EMAIL, "numero": r"([0-9]{7,})"},
    "legacy": {"numero": r"([0-9]{4,})"},
}


@query(
    "legacy_fields",
    f"""select doc_id, modelo,
          nullif(case when modelo in ('fisico', 'digital')
                      then regexp_extract(text, '{EMAIL}') end, '') as email,
          nullif(case modelo when 'fisico' then regexp_extract(text, '([0-9]{{5,}})', 1)
                             when 'digital' then regexp_extract(text, '([0-9]{{7,}})', 1)
                             else regexp_extract(text, '([0-9]{{4,}})', 1) end, '') as numero,
          nullif(case modelo when 'fisico' then regexp_extract(text, 'License([^\\n]*)', 1)
                 end, '') as licenca
        from (select doc_id, text, {MODEL_SQL} as modelo from documents)""",
)
def from_running_text(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text")
    routed = documents.join(models(spark, sf), "doc_id")
    return legacy_fields(routed, "text", PATTERNS)


LINES_SQL = """select {keys}, cast(i as integer) as {number}, bloco
       from (select {keys}, unnest(string_split(text, chr(10))) as bloco,
                    generate_subscripts(string_split(text, chr(10)), 1) as i
             from {table})"""


@query(
    "explode_samples",
    LINES_SQL.format(keys="doc_id", number="numero_amostra", table="documents"),
)
def samples(spark, sf):
    def headed(line, i):
        physical = F.concat(F.lit("AMOSTRA "), (i + 3).cast("string"), F.lit("\n"), line)
        digital = F.concat(F.lit("Amostra "), (i + 3).cast("string"), F.lit(".0 "), line)
        return F.when(F.col("doc_id") % 2 == 0, physical).otherwise(digital)

    text = F.concat(
        F.lit("Dados de mercado\n"),
        F.array_join(F.transform(F.split("text", "\n"), headed), "\n"),
    )
    documents = table(spark, sf, "documents").select("doc_id", "text")
    printed = documents.select("doc_id", text.alias("texto"))
    return explode_samples(printed, "texto")


@query(
    "explode_units",
    LINES_SQL.format(keys="conv_id, turn", number="numero_unidade", table="conversations"),
)
def units(spark, sf):
    def headed(line, i):
        return F.concat(F.lit("[UNIDADE "), (i + 101).cast("string"), F.lit("] "), line)

    text = F.array_join(F.transform(F.split("text", "\n"), headed), "\n")
    printed = table(spark, sf, "conversations").select("conv_id", "turn", text.alias("texto"))
    return explode_units(printed, "texto")


OPTIONS_SQL = """select cast(vec_id as varchar) as codigo_laudo,
              'grupo ' || cast((i - 1) // 16 as varchar) as grupo,
              coalesce(string_agg(case when abs(cast(v as double)) >= 0.2
                                       then 'opcao ' || cast(i - 1 as varchar) end,
                                  ';' order by i), '') as opcoes
       from (select vec_id, unnest(embedding) as v,
                    generate_subscripts(embedding, 1) as i from embeddings)
       group by vec_id, (i - 1) // 16"""


@query("checked_options", OPTIONS_SQL)
def boxes_on(spark, sf):
    """64 boxes per vector, eight to a line, each followed by the word of its option."""
    drawn = table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("codigo_laudo"),
        F.lit(1).alias("page"),
        F.posexplode("embedding").alias("i", "v"),
    )
    x = (F.col("i") % 8) * 60.0
    line = F.floor(F.col("i") / 8).cast("int")
    boxes = drawn.select(
        "codigo_laudo",
        "page",
        line.alias("line"),
        x.alias("x0"),
        (x + 8.0).alias("x1"),
        F.abs(F.col("v").cast("double")).alias("fill_ratio"),
    )
    words = drawn.select(
        "codigo_laudo",
        "page",
        line.alias("line"),
        (x + 12.0).alias("x0"),
        (x + 45.0).alias("x1"),
        F.concat(F.lit("grupo "), F.floor(F.col("i") / 16).cast("string")).alias("grupo"),
        F.concat(F.lit("opcao "), F.col("i").cast("string")).alias("opcao"),
    )
    return checked_options(boxes, words, 0.2).withColumn("opcoes", F.array_join("opcoes", ";"))


@query("checked_options_on_pages", OPTIONS_SQL)
def boxes_and_words(spark, sf):
    """The same boxes drawn on pages among words, under the headings of their groups.

    Groups 0 and 1 stand side by side on page 1, groups 2 and 3 one below the other on page 2,
    and group 3 goes on over page 3. A box is smaller than its words and stands lower.
    """
    drawn = table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("codigo_laudo"), F.posexplode("embedding").alias("i", "v")
    )
    group, j = F.floor(F.col("i") / 16), F.col("i") % 16
    beside = group < 2
    at = drawn.select(
        "codigo_laudo",
        F.col("i").cast("string").alias("i"),
        "v",
        F.when(beside, 1).when((group == 3) & (j >= 8), 3).otherwise(2).cast("int").alias("page"),
        F.when(beside, group * 300 + j % 4 * 70).otherwise(j % 8 * 70).cast("double").alias("x"),
        F.when(beside, 64 + F.floor(j / 4) * 14)
        .when(group == 2, 64 + F.floor(j / 8) * 14)
        .otherwise(F.when(j < 8, 114).otherwise(50))
        .cast("double")
        .alias("y"),
    )
    report = ["codigo_laudo", "page"]
    boxes = at.select(
        *report, F.col("x").alias("x0"), (F.col("x") + 8).alias("x1"), (F.col("y") + 2).alias("top"),
        (F.col("y") + 10).alias("bottom"), F.abs(F.col("v").cast("double")).alias("fill_ratio"),
    )
    headings = F.array(
        *(
            F.struct(F.lit(page).alias("page"), F.lit(x).alias("x"), F.lit(y).alias("y"), F.lit(f"Grupo {g}:").alias("t"))
            for g, page, x, y in ((0, 1, 0.0, 50.0), (1, 1, 300.0, 50.0), (2, 2, 0.0, 50.0), (3, 2, 0.0, 100.0))
        )
    )
    printed = at.select(
        *report, (F.col("x") + 12).alias("x"), "y", F.concat(F.lit("opcao "), F.col("i")).alias("t")
    ).unionByName(
        table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("codigo_laudo"), F.inline(headings))
    )
    words = printed.select(*report, "x", "y", F.posexplode(F.split("t", " ")).alias("k", "text")).select(
        *report, (F.col("x") + F.col("k") * 28).alias("x0"), (F.col("x") + F.col("k") * 28 + 24).alias("x1"),
        (F.col("y") + F.col("k")).alias("top"), (F.col("y") + 9).alias("bottom"), "text",
    )
    ticked = options_on_pages(boxes, words, {f"Grupo {g}": f"grupo {g}" for g in range(4)}, 0.2)
    return ticked.withColumn("opcoes", F.array_join("opcoes", ";"))

"""Where queries and their SQL are listed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Lists a query under `name`, with the SQL that gives the same rows."""

    def keep(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query listed twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quantile_sql(source: str, by: str, value: str, probs: dict[str, float]) -> str:
    """Exact quantiles by rank, in the order of operations the Spark side uses."""
    picks = ",\n".join(
        f"""max(case when rk = cast(floor((n - 1) * cast({p} as double)) as bigint)
                 then v end)
            + (max(case when rk = least(cast(floor((n - 1) * cast({p} as double)) as bigint) + 1,
                                        n - 1) then v end)
               - max(case when rk = cast(floor((n - 1) * cast({p} as double)) as bigint)
                          then v end))
            * (max((n - 1) * cast({p} as double))
               - max(floor((n - 1) * cast({p} as double)))) as {name}"""
        for name, p in probs.items()
    )
    return f"""
      select {by}, {picks}
      from (select {by}, cast({value} as double) as v,
                   row_number() over (partition by {by} order by {value}) - 1 as rk,
                   count(*) over (partition by {by}) as n
            from {source} where {value} is not null)
      group by {by}"""

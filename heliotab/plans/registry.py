"""The register of queries: each takes (spark, sf_dir) and has, where SQL can say it, the DuckDB SQL of the same rows."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def same(name: str, sql: str, tables: tuple[str, ...], oracle: str | None = None) -> None:
    """Registers a query that both engines can read as it stands."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        return spark.sql(sql, **{t: table(spark, d, t) for t in tables})

    run.__name__ = name
    QUERIES[name] = run
    plain = sql
    for t in tables:
        plain = plain.replace("{" + t + "}", t)
    ORACLES[name] = oracle or plain


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

"""Names the queries and keeps the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
MODULE: dict[str, str] = {}  # the query module a name comes from

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def query(name: str, oracle: str | None = None):
    """Register a function ``(Inputs) -> DataFrame``; ``oracle`` may use ``{input}`` names like the inputs do."""

    def add(work: Callable[["Inputs"], DataFrame]):
        QUERIES[name] = lambda spark, folder: plain(work(Inputs(spark, folder)))
        MODULE[name] = work.__module__.rsplit(".", 1)[-1]
        if oracle:
            ORACLES[name] = oracle
        return work

    return add


INPUT_SQL: dict[str, str] = {}


def derived(sql: str) -> str:
    """Put input texts in place of their names; given tables stay as ``{orders}``."""
    while used := [n for n in INPUT_SQL if "{" + n + "}" in sql]:
        for n in used:
            sql = sql.replace("{" + n + "}", f"({INPUT_SQL[n]})")
    return sql


def expand(sql: str) -> str:
    sql = derived(sql)
    for t in TABLES:
        sql = sql.replace("{" + t + "}", t)
    return sql.strip()


class Inputs:
    """The given tables of one folder, and the inputs derived from them by SQL that both engines read alike."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getitem__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self.sql("SELECT * FROM {" + name + "} t")

    def sql(self, text: str) -> DataFrame:
        text = derived(text)
        return self.spark.sql(text, **{t: self[t] for t in TABLES if "{" + t + "}" in text})


def plain(df: DataFrame) -> DataFrame:
    """Result types that read the same everywhere: 64-bit numbers, text, no flags and no lists."""

    def column(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ",")
        elif isinstance(f.dataType, (T.BooleanType, T.IntegerType)):
            c = c.cast("int").cast("bigint")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("bigint") if f.dataType.scale == 0 else c.cast("double")
        return c.alias(f.name)

    return df.select(*[column(f) for f in df.schema.fields])


def oracle_sql() -> dict[str, str]:
    return {name: expand(sql) for name, sql in ORACLES.items()}

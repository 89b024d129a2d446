"""Registry of named queries: a DataFrame builder plus, where SQL can say it, its twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tarnwork.session import apply_semantics

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """The driver tables of one scale factor, read lazily."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = apply_semantics(spark)
        self.dir = directory.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def path(self, name: str) -> str:
        return f"{self.dir}/{name}.parquet"

    def views(self, *names: str) -> SparkSession:
        for name in names:
            getattr(self, name).createOrReplaceTempView(name)
        return self.spark

    def sql(self, text: str, *names: str) -> DataFrame:
        return self.views(*names).sql(text)


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    oracle: str | None

    def __call__(self, spark: SparkSession, directory: str) -> DataFrame:
        return self.build(Tables(spark, directory))


_REGISTRY: dict[str, Query] = {}


def register(name: str, build: Callable[[Tables], DataFrame], oracle: str | None = None) -> None:
    if name in _REGISTRY:
        raise ValueError(f"query {name} is registered twice")
    _REGISTRY[name] = Query(name, build, oracle)


def query(name: str, oracle: str | None = None):
    def bind(build: Callable[[Tables], DataFrame]):
        register(name, build, oracle)
        return build

    return bind


def registered() -> dict[str, Query]:
    from tarnwork import plans  # noqa: F401  (fills the registry)

    return dict(_REGISTRY)

"""Registered queries: operators run over the driver tables, each with an independent SQL oracle.

A *feed* shapes a driver table into one of the engine's domain frames. Feeds are plain projections written
in SQL that both Spark and the oracle engine read, so a comparison tests the operators and nothing else.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granero.schemas import TABLES, table
from granero.session import configure, cut_lineage, shared_table, size_shuffles

# Feeds that many queries read and that cost a shuffle of their own: written once for each folder and application.
SHARED = ("lines",)
FEEDS: dict[str, tuple[tuple[str, ...], str]] = {}
QUERIES: dict[str, Query] = {}


@dataclass(frozen=True)
class Query:
    name: str
    feeds: tuple[str, ...]
    build: Callable[..., DataFrame]
    oracle: str | None
    prepared: tuple[str, ...] = ()


def feed(name: str, sources: Sequence[str], sql: str) -> None:
    FEEDS[name] = (tuple(sources), sql)


def query(name: str, feeds: str, oracle: str | None = None, prepared: str = ""):
    """Register ``build(**frames)``; ``feeds`` lists the frames it takes, separated by spaces.

    The name ``folder`` passes the table folder itself, for queries that open a stream on it. Feeds listed in
    ``prepared`` are computed and written once before the query, which reads them in several branches.
    """

    def register(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, tuple(feeds.split()), build, oracle, tuple(prepared.split()))
        return build

    return register


def _closure(names: Sequence[str]) -> list[str]:
    ordered: list[str] = []
    for name in names:
        if name in FEEDS:
            for dependency in [*_closure(FEEDS[name][0]), name]:
                if dependency not in ordered:
                    ordered.append(dependency)
    return ordered


def frame(spark: SparkSession, folder: str, name: str, ready: dict[str, DataFrame] | None = None) -> DataFrame:
    if ready and name in ready:
        return ready[name]
    if name in TABLES:
        return table(spark, folder, name)
    if name in SHARED:
        tables = [f"{folder}/{one}.parquet" for one in _tables_of(name)]
        return shared_table(spark, f"{folder} {name}", tables, lambda: _shaped(spark, folder, name, ready))
    return _shaped(spark, folder, name, ready)


def _shaped(spark: SparkSession, folder: str, name: str, ready: dict[str, DataFrame] | None) -> DataFrame:
    sources, sql = FEEDS[name]
    for source in sources:
        frame(spark, folder, source, ready).createOrReplaceTempView(source)
    return spark.sql(sql)


def _tables_of(name: str) -> list[str]:
    """The driver tables behind a feed."""
    if name in TABLES:
        return [name]
    return sorted({table for source in FEEDS[name][0] for table in _tables_of(source)})


def plain(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, decimals as doubles: types every result reader shares."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def run(entry: Query, spark: SparkSession, folder: str) -> DataFrame:
    configure(spark)
    feeds = [name for name in entry.feeds if name != "folder"]
    size_shuffles(spark, sorted({f"{folder}/{one}.parquet" for name in feeds for one in _tables_of(name)}))
    ready = {name: cut_lineage(frame(spark, folder, name)) for name in entry.prepared if name not in SHARED}
    frames = {name: folder if name == "folder" else frame(spark, folder, name, ready) for name in entry.feeds}
    return plain(entry.build(**frames))


def oracle_text(entry: Query) -> str | None:
    if entry.oracle is None:
        return None
    parts = [f"{name} AS ({FEEDS[name][1]})" for name in _closure(entry.feeds)]
    body = entry.oracle.strip().rstrip(";")
    if not parts:
        return body
    own = re.match(r"WITH\s+", body, re.IGNORECASE)
    tail = f", {body[own.end():]}" if own else f" {body}"
    return "WITH " + ", ".join(parts) + tail

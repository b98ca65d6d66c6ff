"""Scene catalogues: a search over a catalogue table, its plan by windows and areas, and its cache.

`CatalogueSource` is a Python data source with a partition for each window and batch of areas; its
fetch function stands in for a remote service.  No live service is contacted by this package.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, InputPartition, LessThan

from orbitframe.functions import geometry as G
from orbitframe.operators import relational as R
from orbitframe.sources import files, sinks


@dataclass(frozen=True)
class Search:
    """Conditions of a search; None sets none."""

    equal: dict[str, object] | None = None  # column = value
    one_of: dict[str, list] | None = None  # column in values, in any case
    below: dict[str, float] | None = None  # column < value
    box: tuple[float, float, float, float] | None = None

    def condition(self, columns: list[str]) -> Column:
        out = R.equals_all(self.equal or {})
        for k, v in (self.one_of or {}).items():
            out = out & F.upper(F.col(k)).isin(*[str(x).upper() for x in v])
        for k, v in (self.below or {}).items():
            out = out & (F.col(k) < v)
        if self.box:
            own = {c: F.col(c) for c in ("minx", "miny", "maxx", "maxy")}
            out = out & G.boxes_meet(own, dict(zip(own, map(F.lit, map(float, self.box)))))
        return out


def search(catalogue: DataFrame, windows: list[tuple[str, str]], conditions: Search, ts: str, key: str) -> DataFrame:
    """Catalogue rows in any of the windows that meet the conditions, each key once.

    The windows become ranges of ts, so scans skip row groups; the smallest row of a key stays.
    """
    inside = F.lit(False)
    for a, b in windows:
        inside = inside | F.col(ts).between(F.lit(a).cast("timestamp_ntz"), F.lit(b).cast("timestamp_ntz"))
    rows = catalogue.filter(inside).filter(conditions.condition(catalogue.columns)).filter(F.col(key).isNotNull())
    return R.first_per_key(rows, [key], [c for c in catalogue.columns if c != key])


def plan(spark: SparkSession, windows: list[tuple[str, str]], areas: list[str]) -> DataFrame:
    """The tasks of a search: each window with each area; both lists come from the user."""
    w = spark.createDataFrame([(i, *x) for i, x in enumerate(windows)], "window_id int, start_ts string, end_ts string")
    a = spark.createDataFrame(list(enumerate(areas)), "area_id int, wkt string")
    return w.crossJoin(a)


def truncated(rows: DataFrame, window: str, most: int) -> DataFrame:
    """Windows that gave as many rows as the service gives at most."""
    return rows.groupBy(window).agg(F.count("*").alias("n")).filter(F.col("n") >= most)


def cached_search(spark: SparkSession, root: str, payload: dict, run: Callable[[], DataFrame], name: str = "scenes.parquet", read_only: bool = True, info: Callable[[DataFrame], dict] | None = None) -> DataFrame:
    """The stored result of a search with these parameters, or a new one, stored only if it succeeds; empty ones count.

    info: more to note down about a new result.
    """
    key = sinks.cache_key(payload)
    folder, at = f"{root}/{key}", f"{root}/{key}/{name}"
    if sinks.table_exists(at):
        files.touch(at)
    else:
        sinks.replace_table(run(), at, read_only=read_only)
        sinks.save_query(folder, **payload, query_id=key, **(info(sinks.read_table(spark, at)) if info else {}))
    return sinks.read_table(spark, at)


# --- a search as a data source --------------------------------------------------------------------


@dataclass(frozen=True)
class Task(InputPartition):
    """One window with one batch of areas, and the conditions that the service is asked for."""

    start: str
    end: str
    area: str
    equal: tuple[tuple[str, object], ...]
    below: tuple[tuple[str, float], ...]


class _Reader(DataSourceReader):
    def __init__(self, options: dict, fetch: Callable):
        self.windows = [w.split("/") for w in options.get("windows", "").split(",") if w]
        self.areas = json.loads(options.get("areas", "[]")) or [""]
        self.equal: dict[str, object] = json.loads(options.get("attributes", "{}"))
        self.below: dict[str, float] = {}
        self.pushed = set(filter(None, options.get("filters", "").split(",")))
        self.page, self.attempts, self.fetch = int(options.get("page", 1000)), int(options.get("attempts", 3)), fetch

    def partitions(self) -> list[InputPartition]:
        return [Task(a, b, area, tuple(self.equal.items()), tuple(self.below.items())) for a, b in self.windows for area in self.areas]

    def read(self, partition: Task) -> Iterator[tuple]:
        import time

        skip = 0
        while True:
            for attempt in range(1, self.attempts + 1):
                try:
                    rows = self.fetch(partition, skip, self.page)
                    break
                except OSError:
                    if attempt == self.attempts:
                        raise  # a search that fails in part gives nothing
                    time.sleep(2 ** (attempt - 1))
            yield from rows
            if len(rows) < self.page:
                return
            skip += self.page


class _PushingReader(_Reader):
    """A reader with columns whose conditions go to the service (spark.sql.python.filterPushdown.enabled must be on)."""

    def pushFilters(self, filters):  # noqa: N802  Spark's name
        """Conditions on the columns named by the option `filters` go to the service; Spark checks the others."""
        for f in filters:
            column = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if column in self.pushed and isinstance(f, EqualTo):
                self.equal[column] = f.value
            elif column in self.pushed and isinstance(f, LessThan):
                self.below[column] = f.value
            else:
                yield f


def source(name: str, schema: str, fetch: Callable[[Task, int, int], list[tuple]]) -> type[DataSource]:
    """A data source for spark.dataSource.register(); fetch(task, skip, top) gives a page of rows.

    Options: windows (start/end,...), areas (a JSON list of WKT), attributes (a JSON object of equal
    values), filters (columns whose conditions the service takes), page and attempts.
    """

    class CatalogueSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def reader(self, schema) -> DataSourceReader:
            return (_PushingReader if self.options.get("filters") else _Reader)(self.options, fetch)

    return CatalogueSource

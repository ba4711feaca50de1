"""The list of registered queries and their equivalents for the check."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtally.catalog.views import view, with_views
from seqtally.operators.common import dealt
from seqtally.session import cut_lineage


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


class Inputs:
    """Views of one test-data folder as attributes: `v.aln`, `v.lineitem`, ..."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._stages: dict[str, DataFrame] = {}
        self._views: dict[str, DataFrame] = {}
        self._by_read: dict[str, DataFrame] = {}

    def stage(self, name: str, build: Callable[[Inputs], DataFrame]) -> DataFrame:
        """An intermediate table that several later steps read, written once."""
        if name not in self._stages:
            self._stages[name] = cut_lineage(build(self))
        return self._stages[name]

    def written(self, name: str) -> DataFrame:
        """A view that several steps and later views read, written once."""
        self._views[name] = self.stage(name, lambda v: getattr(v, name))
        return self._views[name]

    def by_read(self, name: str) -> DataFrame:
        """A view of lines joined to their orders, for steps that deal its rows by read: lines are dealt before the join."""
        if not self._by_read:
            lines = dealt(self.lineitem, ["l_orderkey"], beside=[self.orders])
            self._by_read |= {"lineitem": lines, "orders": self.orders, "supplier": self.supplier}
        return view(self.spark, self.sf_dir, name, self._by_read)

    def __getattr__(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name, self._views)


def tidy(df: DataFrame) -> DataFrame:
    """Round floating values to six places and drop order columns, as the compared form."""
    out = []
    for name, kind in df.dtypes:
        if name == "ord":
            continue
        c = F.col(f"`{name}`")
        if kind == "double" or kind.startswith("decimal"):
            c = F.round(c.cast("double"), 6).alias(name)
        out.append(c)
    return df.select(*out)


def register(name: str, run: Callable[[Inputs], DataFrame], sql: str | None = None,
             extra: dict[str, str] | None = None, recursive: bool = False) -> None:
    REGISTRY[name] = Query(lambda spark, sf_dir: tidy(run(Inputs(spark, sf_dir))),
                           None if sql is None else with_views(sql, extra, recursive))

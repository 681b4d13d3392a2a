"""Queries over the sample tables, each with the SQL an oracle can run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegauge.session import shared_dir
from tidegauge.sources.sample_tables import oracle_query, view, view_once

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Sample:
    """Views of one scale directory: ``t.v_waits`` is a DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name)

    def table(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name)

    def once(self, name: str, step: Callable[[], DataFrame]) -> DataFrame:
        """A step that several others may read; here it is only its plan."""
        return step()


class Written(Sample):
    """A sample of whose relations and steps those that several others read are written once.

    They lie in a fresh folder that driver and executors share, each written when
    it is first asked for: one plan that holds such a step n times would run it n times.
    """

    #: Relations that take a shuffle; those that are rows of a table are read from it.
    SHUFFLED = ("v_st_current", "v_trx", "v_lock_waits", "v_trx_lock_waits", "v_nodes", "v_collections")

    def __init__(self, t: Sample) -> None:
        super().__init__(t.spark, t.sf_dir)
        self._root, self._known, self._steps = shared_dir(t.spark, "steps"), {}, {}

    def __getattr__(self, name: str) -> DataFrame:
        return self.table(name)

    def table(self, name: str) -> DataFrame:
        shuffled = lambda v, df: self._write(v, df) if v in self.SHUFFLED else df
        return view_once(self.spark, self.sf_dir, name, self._known, shuffled)

    def once(self, name: str, step: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._steps:
            self._steps[name] = self._write(name, step())
        return self._steps[name]

    def _write(self, name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{self._root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self._root}/{name}")


def written(t: Sample) -> Written:
    return t if isinstance(t, Written) else Written(t)


def query(key: str, sql: str | None = None, ctes: dict[str, str] | None = None):
    """Register ``f(sample) -> DataFrame`` under ``key`` with its oracle."""

    def register(build: Callable[[Sample], DataFrame]) -> Callable[[Sample], DataFrame]:
        QUERIES[key] = lambda spark, sf_dir: build(Sample(spark, sf_dir))
        if sql is not None:
            ORACLES[key] = oracle_query(sql, ctes)
        return build

    return register

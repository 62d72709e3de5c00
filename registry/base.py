"""Registration of queries: a Spark function and, beside it, the oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import roles as R

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """Roles and driver tables of one data directory as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, role: str, columns: str) -> DataFrame:
        """A role cut down to the columns a report reads, and so to the joins they need."""
        return R.frame(self.spark, self.sf_dir, role, columns)

    def __getattr__(self, name: str) -> DataFrame:
        known = R._spark_definitions()
        if name in known or name in R.DERIVED:
            return R.frame(self.spark, self.sf_dir, name)
        return R.table(self.spark, self.sf_dir, name)


def register(
    name: str, spec: str, build: Callable[[Tables], DataFrame], sql: str | None, roles: tuple[str, ...] = (), more: str = ""
) -> None:
    """``spec`` fixes the output columns of both sides; without ``sql`` only rows are checked."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        R.forget()
        return R.finish(build(Tables(spark, sf_dir)), spec)

    QUERIES[name] = run
    if sql is not None:
        ORACLE[name] = R.oracle(R.views(*roles) if roles else "", sql, spec, more)

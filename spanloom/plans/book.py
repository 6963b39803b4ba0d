"""Collects queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spanloom.plans.tables import table, with_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, tables: str, sql: str | None = None):
    """Registers a function of the named tables; sql follows the adapters among them as a SELECT or as further
    common table expressions (beginning with a comma), with `recursive:` in front where one of these is recursive."""
    names = tables.split()

    def add(f):
        from spanloom.session import ship_package

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark, bound_batches=False)
            return f(*[table(spark, sf_dir, n) for n in names])

        run.__doc__ = f.__doc__
        QUERIES[name] = run
        if sql is not None:
            from spanloom.plans.tables import ADAPTERS

            own = [n for n in names if n in ADAPTERS]
            text = sql.strip().removeprefix("recursive:")
            if own:
                text = f"{with_sql(*own)} {text}"
            elif text.startswith(","):
                text = "with " + text[1:]
            ORACLES[name] = text.replace("with ", "with recursive ", 1) if sql.startswith("recursive:") else text
        return f

    return add

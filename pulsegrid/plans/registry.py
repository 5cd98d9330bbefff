"""Registry of named queries: a Spark plan builder plus an optional SQL twin.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the
driver tables (or windows Spark derives from them).  The SQL twin is plain
DuckDB SQL over the same tables, written independently of the Spark code
(long form with window functions where the Spark side works on arrays).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pulsegrid.plans.output import ABS_BITS, REL_BITS, finish

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None, rounded: bool = True, bits: tuple = (REL_BITS, ABS_BITS)):
    """Decorator: register ``fn`` under ``name`` (results rounded by ``finish`` to ``bits``)."""
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return finish(df, *bits) if rounded else df
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco

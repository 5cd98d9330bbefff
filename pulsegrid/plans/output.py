"""Result shaping shared by the registered queries.

Results are compared with an SQL twin by value hash, so every query snaps
doubles to a binary grid (absolute 2^-20 near zero, 2^-26 relative for large
values) and turns -0.0 into 0.0; integers are widened to long.  Decimal-valued
data never sits exactly on a midpoint of a binary grid, so last-bit noise
between two engines cannot flip the result the way decimal rounding ties can.
Means over 64 samples may sit on one: those are compared on a grid of odd ``unit``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ABS_BITS = 20   # grid 2^-20 near zero
REL_BITS = 26   # 26 significant bits for large magnitudes


def snap(c: Column, rel_bits: int = REL_BITS, abs_bits: int = ABS_BITS, unit: float = 1.0) -> Column:
    c = c.cast("double")
    e = F.floor(F.log2(F.greatest(F.abs(c), F.lit(1e-300))))
    g = F.pow(F.lit(2.0), F.greatest(F.lit(-float(abs_bits)), e - rel_bits)) * F.lit(unit)
    return (F.when(F.isnan(c) | (F.abs(c) == float("inf")), c)
             .otherwise(F.round(c / g, 0) * g) + F.lit(0.0))


def finish(df: DataFrame, rel_bits: int = REL_BITS, abs_bits: int = ABS_BITS, unit: float = 1.0) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = snap(c, rel_bits, abs_bits, unit)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType, T.LongType)):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def sql_round(expr: str, rel_bits: int = REL_BITS, abs_bits: int = ABS_BITS, unit: float = 1.0) -> str:
    """DuckDB twin of ``snap``."""
    x = f"(({expr})::DOUBLE)"
    g = (f"(pow(2.0, greatest(-{abs_bits}.0, floor(log2(greatest(abs({x}), 1e-300))) - {rel_bits})) * {unit!r}::DOUBLE)")
    return f"(CASE WHEN isnan({x}) OR isinf({x}) THEN {x} ELSE round({x} / {g}) * {g} END + 0.0)"

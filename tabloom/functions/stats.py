"""Aggregate expressions shared by profiling, collinearity and scaling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pair_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over the rows where both sides are present.

    NULL for a constant side, where the built-in corr() raises under ANSI mode.
    """
    both = x.isNotNull() & y.isNotNull()
    mx, my = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(mx, my), F.stddev_pop(mx) * F.stddev_pop(my))


def pct(part: Column, total: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part * F.lit(100.0), total.cast("double")), digits)


def half_even(value: Column, digits: int) -> Column:
    """Round the stored binary value, exact halves to even."""
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def tidy(frame, wide: dict[str, dict[str, str]], key: str = "column"):
    """Turn one wide row of aggregates into one row per key.

    ``wide`` maps each key value to {output column: wide column}.
    """
    structs = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias(key),
            *[F.col(f"`{src}`").alias(out) for out, src in fields.items()],
        )
        for i, (name, fields) in enumerate(wide.items())
    ]
    return frame.select(F.explode(F.array(*structs)).alias("r")).select("r.*")

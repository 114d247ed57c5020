"""Pairwise-complete correlations, by one method for any number of columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.kinds import clean_double

MAX_PAIR_EXPRESSIONS = 300


def correlations(
    df: DataFrame, pairs: Sequence[tuple[str, str]], wide_above: int = MAX_PAIR_EXPRESSIONS
) -> dict[tuple[str, str], float | None]:
    """Pearson r of each pair over rows where both sides are present, None if undefined.

    Two passes, k*k numbers each for k columns: counts, sums and ranges of every pair's own rows, then
    products of what is centred on these means and scaled by these ranges. Undefined is a side without
    spread. ``wide_above`` no longer changes anything.
    """
    if not pairs:
        return {}
    names = list(dict.fromkeys(c for p in pairs for c in p))
    at = {c: i for i, c in enumerate(names)}
    k = len(names)
    base = df.select(*[clean_double(df, c).alias(f"x{i}") for i, c in enumerate(names)])

    def extent(x: np.ndarray, both: np.ndarray, i: int) -> list[np.ndarray]:
        own = x[:, i : i + 1]
        sums = np.where(both, own, 0.0).sum(0)
        return [both.sum(0), sums, np.where(both, own, np.inf).min(0), np.where(both, own, -np.inf).max(0)]

    n, total, low, high = _cells(base, k, extent, ("sum", "sum", "min", "max"))
    with np.errstate(all="ignore"):
        mean, width = total / n, high - low
        scale = np.where(width > 0, width, 1.0)

    def products(x: np.ndarray, both: np.ndarray, i: int) -> list[np.ndarray]:
        own = np.where(both, (x[:, i : i + 1] - mean[i]) / scale[i], 0.0)
        other = np.where(both, (x - mean[:, i]) / scale[:, i], 0.0)
        return [(own * own).sum(0), (own * other).sum(0)]

    square, cross = _cells(base, k, products, ("sum", "sum"))
    out = {}
    for a, b in pairs:
        i, j = at[a], at[b]
        spread = n[i, j] > 0 and width[i, j] > 0 and width[j, i] > 0
        norm = np.sqrt(square[i, j]) * np.sqrt(square[j, i]) if spread else 0.0
        out[(a, b)] = _unit(float(cross[i, j] / norm)) if norm > 0 else None
    return out


def _unit(r: float | None) -> float | None:
    """Keep r inside [-1, 1]; NaN (infinite input) is undefined."""
    if r is None or r != r:
        return None
    return max(-1.0, min(1.0, r))


def _cells(base: DataFrame, k: int, of_column: Callable, merge: Sequence[str]) -> np.ndarray:
    """k x k arrays from ``of_column(rows, rows where both are present, column)`` per batch, merged by Spark."""
    names = [f"v{i}" for i in range(len(merge))]
    join = {"sum": np.add, "min": np.minimum, "max": np.maximum}

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            if not len(batch):
                continue
            x = batch.to_numpy(dtype=float)
            present = ~np.isnan(x)
            with np.errstate(all="ignore"):
                found = np.stack([of_column(x, present & present[:, i : i + 1], i) for i in range(k)], axis=1)
                held = found if held is None else np.stack([join[m](*v) for m, v in zip(merge, zip(held, found))])
        if held is not None:
            yield pd.DataFrame({"cell": np.arange(k * k), **{c: v.ravel() for c, v in zip(names, held)}})

    rows = base.mapInPandas(parts, ", ".join(["cell int", *(f"{c} double" for c in names)]))
    out = np.zeros((len(merge), k * k))
    for r in rows.groupBy("cell").agg(*[getattr(F, m)(c).alias(c) for m, c in zip(merge, names)]).collect():
        out[:, r["cell"]] = [r[c] for c in names]
    return out.reshape(-1, k, k)

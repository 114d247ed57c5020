"""Exact nearest-neighbour imputation as a partitioned join.

Donors are spread over cells by value. A target first meets the cells closest to it,
which bounds how far its k-th neighbour can be; it then meets every other cell whose
bounding box reaches inside that radius, so no donor that could matter is skipped.
Cells hold a bounded number of donors and targets per task: crowded ones are salted.
Equal donor vectors keep at most k rows, since further copies can never enter a top k,
and equal target vectors are looked up once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.kinds import categorical_columns, clean_double, col, numeric_columns
from ..session import checkpointed
from .encode import discover_categories

MAX_CATEGORIES = 1000  # of a column; their codes are literals here
MAX_CELLS = 16_384  # per layout
MAX_LAYOUTS = 4
_LAYOUT_BITS = 40


@dataclass(frozen=True)
class _Boxes:
    """Bounding boxes of the donor cells: one small row per cell, never per donor."""

    cell: np.ndarray
    rows: np.ndarray
    present: np.ndarray  # cells x columns: donors with that column
    low: np.ndarray
    high: np.ndarray
    depth: np.ndarray  # layouts x columns: how often a layout halves a column

    def lower_bounds(self, x: np.ndarray) -> np.ndarray:
        """Smallest possible squared distance from each target to each cell.

        A target uses the layout that separates best on the columns it has.
        """
        width = x.shape[1]
        seen = ~np.isnan(x)
        full = self.present == self.rows[:, None]
        shared = seen.astype(float) @ (self.present > 0).T.astype(float)
        total = np.zeros(shared.shape)
        for j in range(width):
            xj = x[:, j][:, None]
            gap = np.maximum(np.maximum(self.low[:, j] - xj, xj - self.high[:, j]), 0.0)
            total += np.where(seen[:, j][:, None] & full[:, j], gap * gap, 0.0)
        layout = (seen.astype(float) @ self.depth.T).argmax(axis=1)
        usable = (shared > 0) & (layout[:, None] == self.cell[None, :] >> _LAYOUT_BITS)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(usable, total * width / shared, np.inf)

    def nearest(self, x: np.ndarray, bounds: np.ndarray, k: int) -> np.ndarray:
        """Cells visited first: in order of distance until every gap has k donors."""
        chosen = np.zeros(bounds.shape, dtype=bool)
        order = np.argsort(bounds, axis=1, kind="stable")
        reachable = np.isfinite(np.take_along_axis(bounds, order, axis=1))
        for j in range(x.shape[1]):
            gap = np.isnan(x[:, j])
            donors = np.where(reachable, self.present[:, j][order], 0)
            before = np.cumsum(donors, axis=1) - donors
            take = (before < k) & (donors > 0) & gap[:, None]
            np.put_along_axis(chosen, order, np.take_along_axis(chosen, order, axis=1) | take, axis=1)
        return chosen


def _closest(x, y, y_ids, k) -> tuple[np.ndarray, ...]:
    """Per target row and missing column: the k nearest donors having that column."""
    width = x.shape[1]
    out = ([], [], [], [], [])
    step = max(1, 2_000_000 // max(1, len(y)))
    for start in range(0, len(x), step):
        part = x[start : start + step]
        total = np.zeros((len(part), len(y)))
        shared = np.zeros((len(part), len(y)))
        for j in range(width):
            diff = part[:, j][:, None] - y[:, j][None, :]
            ok = ~np.isnan(diff)
            total += np.where(ok, diff * diff, 0.0)
            shared += ok
        with np.errstate(divide="ignore", invalid="ignore"):
            dist = np.where(shared > 0, total * width / shared, np.inf)
        for j in range(width):
            rows = np.flatnonzero(np.isnan(part[:, j]))
            donors = np.flatnonzero(~np.isnan(y[:, j]))
            if not len(rows) or not len(donors):
                continue
            d = dist[np.ix_(rows, donors)]
            kth = np.partition(d, k - 1, axis=1)[:, k - 1] if len(donors) > k else np.full(len(rows), np.inf)
            r, c = np.nonzero((d <= kth[:, None]) & np.isfinite(d))
            near = d[r, c]
            order = np.lexsort((c, near, r))  # donors come sorted by id
            r, c, near = r[order], c[order], near[order]
            first = np.searchsorted(r, r, side="left")
            keep = np.arange(len(r)) - first < k
            r, c, near = r[keep], c[keep], near[keep]
            out[0].append(rows[r] + start)
            out[1].append(np.full(len(r), j))
            out[2].append(near)
            out[3].append(y_ids[donors[c]])
            out[4].append(y[donors[c], j])
    return tuple(np.concatenate(o) if o else np.array([]) for o in out)


@dataclass
class KnnModel:
    k: int
    id_col: str
    numeric: list[str]
    categories: dict[str, list[str]]
    means: list[float | None]
    donors: DataFrame  # id, x0.., cell
    boxes: _Boxes
    cell_rows: int
    unknown: str = "first"

    @property
    def names(self) -> list[str]:
        return self.numeric + list(self.categories)

    @property
    def xs(self) -> list[str]:
        return [f"__x{i}" for i in range(len(self.names))]

    def transform(self, df: DataFrame) -> DataFrame:
        order = df.columns
        coded = df.withColumns(dict(zip(self.xs, _codes(df, self.numeric, self.categories))))
        gap = reduce(Column.__or__, [F.col(x).isNull() for x in self.xs])
        whole = coded.where(~gap).withColumns({f"__v{i}": F.lit(None).cast("double") for i in range(len(self.xs))})
        holes = coded.where(gap)
        targets = checkpointed(holes.groupBy(*self.xs).agg(F.min(col(self.id_col)).alias("__t")))
        found = self._neighbours(targets)
        values = targets.join(found, "__t", "left").drop("__t")
        renamed = values.select(
            *[F.col(x).alias(f"__k{i}") for i, x in enumerate(self.xs)],
            *[F.col(f"__v{i}") for i in range(len(self.xs))],
        )
        same = reduce(
            Column.__and__, [F.col(x).eqNullSafe(F.col(f"__k{i}")) for i, x in enumerate(self.xs)]
        )
        filled = holes.join(renamed, same).drop(*[f"__k{i}" for i in range(len(self.xs))])
        return self._restore(whole.unionByName(filled), order)

    def _restore(self, df: DataFrame, order: Sequence[str]) -> DataFrame:
        fixes = {}
        for i, c in enumerate(self.names):
            value = F.coalesce(F.col(self.xs[i]), F.col(f"__v{i}"), F.lit(self.means[i]).cast("double"))
            if c in self.categories:
                labels = self.categories[c]
                text = F.try_element_at(
                    F.array(*[F.lit(v) for v in labels]) if labels else F.lit(None).cast("array<string>"),
                    F.greatest(F.bround(value), F.lit(0.0)).cast("int") + 1,
                )
                keep = F.col(self.xs[i]) < 0
                fixes[c] = F.when(keep, col(c).cast("string")).otherwise(text) if self.unknown == "keep" else text
            else:
                fixes[c] = value
        return df.withColumns(fixes).select(*[col(c) for c in order])

    def _neighbours(self, targets: DataFrame) -> DataFrame:
        """One row per target vector: mean of the k nearest donors per missing column."""
        near = self._match(self._route(targets, None))
        if len(self.boxes.cell) > 1:
            near = checkpointed(self._top(near))
            far = near.groupBy("__t").agg(
                *[
                    F.when(
                        F.count_if(F.col("c") == j) >= self.k, F.max(F.when(F.col("c") == j, F.col("d")))
                    ).alias(f"r{j}")
                    for j in range(len(self.xs))
                ]
            )
            radius = targets.join(far, "__t", "left")
            near = near.select("__t", "c", "d", "i", "v").unionByName(self._match(self._route(radius, "r")))
        best = self._top(near).groupBy("__t")
        return best.agg(
            *[F.avg(F.when(F.col("c") == j, F.col("v"))).alias(f"__v{j}") for j in range(len(self.xs))]
        )

    def _top(self, near: DataFrame) -> DataFrame:
        order = Window.partitionBy("__t", "c").orderBy("d", "i")
        return near.withColumn("at", F.row_number().over(order)).where(F.col("at") <= self.k).drop("at")

    def _route(self, targets: DataFrame, radius: str | None) -> DataFrame:
        """Repeat each target once per cell it has to visit."""
        boxes, k, xs = self.boxes, self.k, self.xs
        limits = [f"{radius}{j}" for j in range(len(xs))] if radius else []
        schema = targets.select("__t", *xs).schema.add("cell", "long")
        chunk = max(1, 4_000_000 // max(1, len(boxes.cell)))

        def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for start in range(0, len(batch), chunk):
                    part = batch.iloc[start : start + chunk]
                    x = part[xs].to_numpy(dtype=float)
                    bounds = boxes.lower_bounds(x)
                    first = boxes.nearest(x, bounds, k)
                    if limits:
                        reach = np.zeros(bounds.shape, dtype=bool)
                        for j, name in enumerate(limits):
                            r = part[name].to_numpy(dtype=float)
                            r = np.where(np.isnan(r), np.inf, r * (1 + 1e-9))
                            useful = np.isnan(x[:, j])[:, None] & (boxes.present[:, j] > 0)
                            reach |= useful & (bounds <= r[:, None]) & np.isfinite(bounds)
                        first = reach & ~first
                    rows, cells = np.nonzero(first)
                    out = part[["__t", *xs]].iloc[rows].copy()
                    out["cell"] = boxes.cell[cells]
                    yield out

        return targets.mapInPandas(visits, schema)

    def _match(self, visits: DataFrame) -> DataFrame:
        """Join targets with the donors of their cells, keeping k per target and task."""
        visits = checkpointed(visits)
        loads = {r["cell"]: r["n"] for r in visits.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
        sizes = dict(zip(self.boxes.cell.tolist(), self.boxes.rows.tolist()))
        plan = [
            (int(c), math.ceil(sizes[c] / self.cell_rows), math.ceil(n / self.cell_rows))
            for c, n in loads.items()
        ]
        spark = visits.sparkSession
        salts = F.broadcast(spark.createDataFrame(plan, "cell long, nd int, nt int"))  # one row per cell
        left = visits.join(salts, "cell").select(
            "__t", *self.xs, "cell",
            F.pmod(F.xxhash64("__t"), F.col("nt")).cast("int").alias("st"),
            F.explode(F.sequence(F.lit(0), F.col("nd") - 1)).alias("sd"),
        )
        right = self.donors.join(salts, "cell").select(
            "__i", *self.xs, "cell",
            F.explode(F.sequence(F.lit(0), F.col("nt") - 1)).alias("st"),
            F.pmod(F.xxhash64("__i"), F.col("nd")).cast("int").alias("sd"),
        )
        keys, xs, k = ["cell", "st", "sd"], self.xs, self.k
        t_type = visits.schema["__t"].dataType.simpleString()
        i_type = self.donors.schema["__i"].dataType.simpleString()

        def meet(targets: pd.DataFrame, donors: pd.DataFrame) -> pd.DataFrame:
            donors = donors.sort_values("__i", kind="stable")
            row, c, d, i, v = _closest(
                targets[xs].to_numpy(dtype=float), donors[xs].to_numpy(dtype=float), donors["__i"].to_numpy(), k
            )
            t = targets["__t"].to_numpy()[row.astype(int)]
            return pd.DataFrame({"__t": t, "c": c.astype("int32"), "d": d.astype(float), "i": i, "v": v.astype(float)})

        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
            meet, f"__t {t_type}, c int, d double, i {i_type}, v double"
        )


def _codes(df: DataFrame, numeric: Sequence[str], categories: dict[str, list[str]]) -> list[Column]:
    """Numbers as they are; categories as sorted position, -1 when not seen at fit."""
    out = [clean_double(df, c) for c in numeric]
    for c, labels in categories.items():
        text = col(c).cast("string")
        known = F.array(*[F.lit(v) for v in labels]) if labels else F.lit(None).cast("array<string>")
        place = F.coalesce(F.array_position(known, text), F.lit(0)) - 1
        out.append(F.when(text.isNotNull(), place.cast("double")))
    return out


@dataclass(frozen=True)
class KnnImputer:
    """Mean of the k nearest rows under a distance that skips missing coordinates.

    ``unknown='first'`` turns categories not seen at fit into the first one;
    ``'keep'`` leaves them. Numbers are not rescaled. ``cell_rows`` bounds the donors
    and the targets one task compares.
    """

    k: int = 5
    id_col: str = "id"
    exclude: Sequence[str] = field(default_factory=tuple)
    unknown: str = "first"
    cell_rows: int = 4096

    def fit(self, df: DataFrame) -> KnnModel:
        skip = {self.id_col, *self.exclude}
        numeric = numeric_columns(df, skip)
        cats = categorical_columns(df, skip)
        text = df.withColumns({c: col(c).cast("string") for c in cats}) if cats else df
        labels = {c: [v for v in vs if v is not None] for c, vs in discover_categories(text, cats, MAX_CATEGORIES).items()}
        xs = [f"__x{i}" for i in range(len(numeric) + len(cats))]
        coded = text.select(
            col(self.id_col).alias("__i"), *[c.alias(x) for c, x in zip(_codes(text, numeric, labels), xs)]
        )
        stats = coded.agg(
            F.count(F.lit(1)).alias("n"),
            *[F.avg(x).alias(f"m{x}") for x in xs],
            *[F.stddev_pop(x).alias(f"s{x}") for x in xs],
        ).first()
        layouts = self._layouts(coded, xs, stats)
        cuts = _cut_points(coded, xs, layouts)
        copies = Window.partitionBy(*xs).orderBy("__i")
        kept = coded.withColumn("at", F.row_number().over(copies)).where(F.col("at") <= self.k).drop("at")
        if len(layouts) > 1:
            kept = checkpointed(kept)
        placed = [_with_cell(kept, xs, c, i) for i, c in enumerate(cuts)]
        donors = checkpointed(reduce(DataFrame.unionByName, placed))
        depth = np.array([[d.get(i, 0) for i in range(len(xs))] for d in layouts], dtype=float)
        return KnnModel(
            self.k, self.id_col, numeric, labels, [stats[f"m{x}"] for x in xs], donors,
            _collect_boxes(donors, xs, depth), self.cell_rows, self.unknown,
        )

    def _layouts(self, coded: DataFrame, xs: list[str], stats) -> list[dict[int, int]]:
        """Halvings per column, one layout per common pattern of gaps.

        Each halves the column with the widest remaining spread among those the
        pattern has, since a cell tells nothing about a coordinate that is missing.
        """
        cells = min(MAX_CELLS, stats["n"] / self.cell_rows)
        halvings = math.ceil(math.log2(cells)) if cells > 1 else 0
        if not halvings:
            return [{}]
        gap = reduce(Column.__or__, [F.col(x).isNull() for x in xs])
        pattern = F.concat(*[F.when(F.col(x).isNull(), "0").otherwise("1") for x in xs])
        common = (
            coded.where(gap).groupBy(pattern.alias("p")).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "p").limit(4 * MAX_LAYOUTS).collect()
        )
        layouts: list[dict[int, int]] = []
        for p in [r["p"] for r in common] or ["1" * len(xs)]:
            spread = {i: stats[f"s{x}"] or 0.0 for i, x in enumerate(xs) if p[i] == "1"}
            depth = dict.fromkeys(spread, 0)
            for _ in range(halvings if spread else 0):
                widest = max(spread, key=lambda i: spread[i] / 2 ** depth[i])
                depth[widest] += 1
            used = {i: d for i, d in depth.items() if d and spread[i] > 0}
            if used not in layouts and len(layouts) < MAX_LAYOUTS:
                layouts.append(used)
        return layouts


def _cut_points(coded: DataFrame, xs: list[str], layouts: list[dict[int, int]]) -> list[dict[int, list[float]]]:
    """Approximate equal-count cuts; any cuts are correct, even ones balance the cells."""
    wanted = sorted({item for layout in layouts for item in layout.items()})
    if not wanted:
        return [{} for _ in layouts]
    row = coded.agg(
        *[
            F.percentile_approx(xs[i], [q / 2**d for q in range(1, 2**d)], 100 * 2**d).alias(f"c{i}_{d}")
            for i, d in wanted
        ]
    ).first()
    return [{i: sorted(set(row[f"c{i}_{d}"] or [])) for i, d in layout.items()} for layout in layouts]


def _with_cell(df: DataFrame, xs: list[str], splits: dict[int, list[float]], layout: int) -> DataFrame:
    """Mixed-radix cell number within a layout; a missing coordinate has a bin of its own."""
    cell, radix, out = F.lit(layout << _LAYOUT_BITS).cast("long"), 1, df
    for i, cuts in splits.items():
        edges = [-math.inf, *cuts, math.inf]
        out = Bucketizer(splits=edges, inputCol=xs[i], outputCol=f"__b{i}", handleInvalid="keep").transform(out)
        bin_no = F.coalesce(F.col(f"__b{i}"), F.lit(float(len(edges) - 1)))
        cell = cell + bin_no.cast("long") * radix
        radix *= len(edges)
    return out.withColumn("cell", cell).drop(*[f"__b{i}" for i in splits])


def _collect_boxes(donors: DataFrame, xs: list[str], depth: np.ndarray) -> _Boxes:
    rows = donors.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(x).alias(f"n{x}") for x in xs],
        *[F.min(x).alias(f"l{x}") for x in xs],
        *[F.max(x).alias(f"h{x}") for x in xs],
    ).orderBy("cell").collect()

    def grid(prefix: str) -> np.ndarray:
        values = [[r[f"{prefix}{x}"] for x in xs] for r in rows]
        return np.array(values, dtype=float).reshape(len(rows), len(xs))

    return _Boxes(
        np.array([r["cell"] for r in rows], dtype=np.int64), np.array([r["n"] for r in rows], dtype=float),
        grid("n"), grid("l"), grid("h"), depth,
    )

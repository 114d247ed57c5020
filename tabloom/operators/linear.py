"""Logistic regression and linear support vectors, all points and folds of a search at once.

Minimised is C times the summed loss plus the penalty; the intercept isn't penalised. Losses are smooth: the logistic one, or the
hinge with its corner rounded over a width that shrinks step by step to `WIDTHS[-1]`. Up to `SECOND_ORDER` columns a round
sums gradient and curvature, and the next point solves the penalised quadratic model (coordinate by coordinate where the
penalty has corners). The same round sums the loss at other lengths of the step; the best one is taken, and the next step is tried at
about that length. Wider fits sum gradients only and take accelerated proximal steps. Both end at the same minimum, since the target is convex.

So a fit may start anywhere: near others it knows, or, over a large table, at the minimum over some of its rows. The start is all that
these decide; every round sums over all rows. Fits that are capped by `max_iter` start at zero.

A fit may read its rows through a map of their cells, which is taken in tasks, so that only the cells themselves are stored.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterator, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import fitting
from .fitting import Fit, Rows, fit_together, grouped_by, held_out_counts, packed_table, table_bytes, uniform

SECOND_ORDER, WIDTHS, ROUNDS = 256, (1.0, 0.3, 0.1, 0.03, 0.01), 5_000
#: Rows of a large table from which its fits take their starts.
START_ROWS = 20_000
#: Rows mapped at once, bytes of mapped rows that a task keeps, and the share of the steepest curvature below which a row's adds nothing.
BLOCK, KEPT_BYTES, FLAT = 4096, 192 << 20, 1e-2
#: The C of fits that aren't meant to be penalised.
UNBOUND = 1e9
#: Lengths tried in the round of a whole step.
LENGTHS = (4.0, 2.0, *(2.0**-k for k in (1, 2, 3, 4, 6, 10)))


def _loss(margin: np.ndarray, width: float | None, above: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss, slope and curvature at margins; a width of None is the logistic loss.

    With `above` the hinge's curvature is that of the parabola which touches the loss here and lies above it elsewhere, so a step can't
    overshoot. Its own curvature needs a tenth of the rounds; rows far from the corner have next to none, and it is left out.
    """
    if width is None:
        p = 1 / (1 + np.exp(np.clip(margin, -700, 700)))
        return np.logaddexp(0, -margin), -p, p * (1 - p)
    lack = 1 - margin
    far = np.sqrt(lack**2 + width**2)
    curve = 1 / (2 * far)
    if not above:
        curve = curve * (width / far) ** 2
        curve[curve < FLAT / (2 * width)] = 0.0
    return (far + lack) / 2, -(lack / far + 1) / 2, curve


def _loss_alone(margin: np.ndarray, width: float | None) -> float:
    if width is None:
        return float(np.logaddexp(0, -margin).sum())
    lack = 1 - margin
    return float((np.sqrt(lack**2 + width**2) + lack).sum() / 2)


def _descent(a: np.ndarray, b: np.ndarray, w: np.ndarray, corner: float) -> np.ndarray:
    """The step that minimises the quadratic a, b plus `corner` times the absolute sum of w + step, but for the last number."""
    if not corner:
        return -np.linalg.solve(a, b)
    step, slope = np.zeros(len(w)), b.copy()
    for sweep in range(10_000):
        most = 0.0
        for j in range(len(w)):
            rest = slope[j] - a[j, j] * step[j]
            if j == len(w) - 1:
                new = -rest / a[j, j]
            else:
                aim = a[j, j] * w[j] - rest
                new = np.sign(aim) * max(abs(aim) - corner, 0.0) / a[j, j] - w[j]
            if new != step[j]:
                slope = slope + a[:, j] * (new - step[j])
                most, step[j] = max(most, abs(new - step[j])), new
        if most < 1e-10:
            break
        if sweep % 8 == 7:  # the signs are often right long before the numbers are
            step, done = _of_signs(a, b, w, corner, step)
            if done:
                break
            slope = b + a @ step
    return step


def _of_signs(a: np.ndarray, b: np.ndarray, w: np.ndarray, corner: float, step: np.ndarray) -> tuple[np.ndarray, bool]:
    """The step towards the minimum among coefficients of the same signs, up to where a sign ends; and whether it is the one looked for."""
    at = (w + step)[:-1]
    sign = np.sign(at)
    free, pull, aim = np.r_[sign != 0, True], corner * np.r_[sign, 0.0], np.r_[np.where(sign != 0, 0.0, -w[:-1]), 0.0]
    try:
        aim[free] = -np.linalg.solve(a[np.ix_(free, free)], (b + pull + a @ aim)[free])
    except np.linalg.LinAlgError:
        return step, False
    end = (w + aim)[:-1]
    ended = np.flatnonzero((sign != 0) & (np.sign(end) != sign))
    if len(ended):
        parts = at[ended] / (at[ended] - end[ended])
        first = ended[np.argmin(parts)]
        step = step + parts.min() * (aim - step)
        step[first] = -w[first]
        return step, False
    return aim, bool((np.abs((a @ aim + b)[:-1][sign == 0]) <= corner * (1 + 1e-9)).all())


def _blocks(rows: Rows, how) -> Iterator[tuple[slice, np.ndarray]]:
    """Stretches of rows with their mapped cells and a column of ones; kept for all fits of the task if they take few bytes."""
    own, n = ("blocks", how), len(rows.y)
    if own in rows.shared:
        yield from rows.shared[own]
        return
    kept, room = [], KEPT_BYTES - sum(x.nbytes for held in rows.shared.values() for _, x in held)
    for i in range(0, n, BLOCK):
        at = slice(i, min(i + BLOCK, n))
        x = rows.x[at] if how is None else how.cells(rows.x[at])
        x = np.c_[x, np.ones(len(x))]
        kept = kept + [(at, x)] if kept is not None and x.nbytes * (n / len(x)) <= room else None
        yield at, x
    if kept:
        rows.shared[own] = kept


@lru_cache(maxsize=8)
def _upper(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(n)


def _square(upper: np.ndarray, n: int) -> np.ndarray:
    """The symmetric matrix of which sums hold the upper half."""
    out = np.zeros((n, n))
    out[_upper(n)] = upper
    return out + np.triu(out, 1).T


class _Sums:
    """What one fit sums over stretches of rows in a round."""

    def __init__(self, fit: "LinearFit", state: tuple):
        self.fit, (self.what, w, step, self.width, self.above) = fit, state
        n = len(w)
        self.vectors = (w if step is None else np.stack([w + step, step], 1)).reshape(n, -1)
        self.loss, self.slopes, self.pull, self.total = np.zeros(1 + len(LENGTHS)), np.zeros(n), None, 0.0
        self.curves = np.zeros((n, n)) if fit.second and self.what != "score" else None

    def take(self, rows: Rows, at: slice, x: np.ndarray, products: np.ndarray) -> None:
        out, y = self.fit._out(rows.fold[at]), rows.y[at]
        if self.what == "score":
            self.total = self.total + held_out_counts(y[out], 1 / (1 + np.exp(-np.clip(products[out, 0], -700, 700))))
            return
        seen, sign = ~out, 2 * y - 1
        margin = sign * products[:, 0]
        value, slope, curve = _loss(margin, self.width, self.above)
        self.loss[0] += value[seen].sum()
        self.pull = np.where(seen, slope * sign, 0.0)
        if products.shape[1] > 1:
            moved = (sign * products[:, 1])[seen]
            start = margin[seen] - moved
            self.loss[1:] += [_loss_alone(start + t * moved, self.width) for t in LENGTHS]
        if self.curves is not None:
            bent = np.flatnonzero(seen & (curve > 0))
            scaled = x[bent]
            scaled *= np.sqrt(curve[bent])[:, None]
            self.curves += scaled.T @ scaled

    def packed(self, rows: Rows) -> np.ndarray:
        if self.what == "score":
            return self.total if len(rows.y) else held_out_counts(rows.y, rows.y)
        return np.concatenate([self.loss, self.slopes] + ([] if self.curves is None else [self.curves[_upper(len(self.slopes))]]))


@dataclass
class LinearFit(Fit):
    """One point on all folds but one, or but some."""

    key: object
    fold: int | tuple[int, ...]
    columns: int
    point: Mapping
    hinge: bool = False
    second: bool = True
    map: object = None
    start: np.ndarray | None = None

    @property
    def cost(self) -> float:
        return float(self.columns)

    def _out(self, fold: np.ndarray) -> np.ndarray:
        return np.isin(fold, self.fold) if isinstance(self.fold, tuple) else fold == self.fold

    def sums(self, rows: Rows, state) -> np.ndarray:
        return self.all_sums(rows, [(self, state)])[0]

    @staticmethod
    def all_sums(rows: Rows, asked: Sequence[tuple["LinearFit", tuple]]) -> list[np.ndarray]:
        """The sums of many fits: those that share a map take their products with each stretch of rows at once."""
        out = [None] * len(asked)
        for how, members in grouped_by(range(len(asked)), lambda i: asked[i][0].map).items():
            parts = [_Sums(*asked[i]) for i in members]
            for at, x in _blocks(rows, how):
                products, begin = x @ np.concatenate([p.vectors for p in parts], axis=1), 0
                for p in parts:
                    p.take(rows, at, x, products[:, begin : begin + p.vectors.shape[1]])
                    begin += p.vectors.shape[1]
                pulled = [p for p in parts if p.pull is not None]
                if pulled:
                    slopes = x.T @ np.stack([p.pull for p in pulled], 1)
                    for k, p in enumerate(pulled):
                        p.slopes += slopes[:, k]
            for i, p in zip(members, parts):
                out[i] = p.packed(rows)
        return out

    @property
    def _parts(self) -> tuple[float, float, float]:
        """C, and the weights of absolute and squared coefficients."""
        ratio = 0.0 if self.hinge else self.point.get("l1_ratio", 0.0)
        return float(self.point.get("C", 1.0)), ratio, 1.0 - ratio

    def _target(self, loss: float, w: np.ndarray) -> float:
        c, corner, ridge = self._parts
        return c * loss + corner * np.abs(w[:-1]).sum() + ridge / 2 * (w[:-1] ** 2).sum()

    def run(self) -> Generator:
        known = self.start is not None and not self.point.get("max_iter")
        w = self.start if known else np.zeros(self.columns + 1)
        solve = self._newton if self.second else self._proximal
        widths = (None,) if not self.hinge else WIDTHS[-1:] if known else WIDTHS
        for width in widths:
            w = yield from solve(w, width, 1e-11 if width == widths[-1] else 1e-3)
        return w, ((yield "score", w, None, None, False) if isinstance(self.fold, int) and self.fold >= 0 else None)

    def _newton(self, w: np.ndarray, width: float | None, least: float) -> Generator:
        """Steps until the target falls by less than the share `least`."""
        (c, corner, ridge), n, lengths = self._parts, len(w), len(LENGTHS) + 1
        flat = np.r_[np.ones(n - 1), 0.0]
        above, share, little = False, 1.0, 0
        sums = yield "sums", w, None, width, above
        value = self._target(sums[0], w)
        for _ in range(self.point.get("max_iter") or ROUNDS):
            slope = c * sums[lengths : lengths + n] + ridge * flat * w
            curve = c * _square(sums[lengths + n :], n) + ridge * np.diag(flat)
            curve = curve + np.eye(n) * (1e-9 * max(1.0, float(np.trace(curve)) / n))
            step = share * _descent(curve, slope, w, corner)
            fall = float(slope @ step) + corner * (np.abs((w + step)[:-1]).sum() - np.abs(w[:-1]).sum())
            while True:
                sums = yield "sums", w, step, width, above
                tried = {t: self._target(loss, w + t * step) for t, loss in zip((1.0, *LENGTHS), sums)}
                # corners bend the target along a step, so the fall of the whole step bounds that of a part of it
                good = any(new <= value + 1e-4 * t * min(fall, 0.0) for t, new in tried.items() if t <= 1)
                if good or np.abs(step).max() < 1e-8 * (1 + np.abs(w).max()):
                    break
                step, fall = step * LENGTHS[-1], fall * LENGTHS[-1]
                if self.hinge and not above:
                    break
            if not good and self.hinge and not above:  # far from its minimum the loss may be flatter here than on the way
                above, share = True, 1.0
                sums = yield "sums", w, None, width, above
                continue
            best = min(tried, key=lambda t: tried[t]) if good else 1.0
            # another length costs a round more
            scale = 1.0 if value - tried[1.0] >= (value - tried[best]) / 2 else best
            whole, share = share == 1.0 and scale == 1.0, min(1.0, share * best)
            if not good or scale != 1.0:
                sums = yield "sums", w + scale * step, None, width, False
            new = self._target(sums[0], w + scale * step)
            gained, value, w = value - new, new, w + scale * step
            little = little + 1 if gained < least * (1 + abs(value)) else 0
            if not good or np.abs(scale * step).max() < 1e-7 * (1 + np.abs(w).max()) or little > (not whole):
                break
            if little:
                share = 1.0
            if above:
                above = False
                if scale == 1.0:
                    sums = yield "sums", w, None, width, above
        return w

    def _proximal(self, w: np.ndarray, width: float | None, least: float) -> Generator:
        """Accelerated proximal gradient steps, their length found by trial, started anew where the target rises."""
        (c, corner, ridge), n, lengths = self._parts, len(w), len(LENGTHS) + 1
        flat = np.r_[np.ones(n - 1), 0.0]
        ahead, pace, steep = w, 1.0, 1.0
        value = np.inf
        for _ in range(self.point.get("max_iter") or ROUNDS):
            sums = yield "sums", ahead, None, width, False
            smooth = c * sums[0] + ridge / 2 * ((flat * ahead) ** 2).sum()
            slope = c * sums[lengths : lengths + n] + ridge * flat * ahead
            while True:
                aim = ahead - slope / steep
                new = np.r_[np.sign(aim[:-1]) * np.maximum(np.abs(aim[:-1]) - corner / steep, 0), aim[-1]]
                sums = yield "sums", new, None, width, False
                held = c * sums[0] + ridge / 2 * ((flat * new) ** 2).sum()
                move = new - ahead
                if held <= smooth + slope @ move + steep / 2 * (move @ move) + 1e-12 * abs(smooth):
                    break
                steep *= 2
            target = self._target(sums[0], new)
            if target > value and pace > 1:
                ahead, pace = w, 1.0
                continue
            after = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
            still = np.abs(new - w).max() < 1e-7 * (1 + np.abs(new).max())
            ahead, w, pace, value, steep = new + (pace - 1) / after * (new - w), new, after, target, steep * 0.9
            if still:
                break
        return w


@dataclass(frozen=True)
class LinearModel:
    """Coefficients and intercept; `calibrated` models have probabilities of their own."""

    coefficients: tuple[float, ...]
    intercept: float
    calibrated: bool
    features: str = "features"

    def hasParam(self, name: str) -> bool:
        return self.calibrated and name == "probabilityCol"

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds rawPrediction and prediction, and probability if calibrated."""
        own = F.array(*[F.lit(float(c)) for c in self.coefficients])
        products = F.zip_with(vector_to_array(self.features), own, lambda a, b: a * b)
        margin = F.aggregate(products, F.lit(float(self.intercept)), lambda a, b: a + b)
        out = df.withColumn("__side", margin)
        added = {"rawPrediction": array_to_vector(F.array(-F.col("__side"), F.col("__side"))), "prediction": (F.col("__side") > 0).cast("double")}
        if self.calibrated:
            p = 1 / (1 + F.exp(-F.col("__side")))
            added["probability"] = array_to_vector(F.array(1 - p, p))
        return out.withColumns(added).drop("__side")

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Distances from the boundary for rows of cells."""
        return x @ np.array(self.coefficients) + self.intercept

    def probability(self, margin):
        """The probability at a column of numbers, for a model of one column."""
        return 1 / (1 + F.exp(-(F.lit(float(self.coefficients[0])) * margin + F.lit(float(self.intercept)))))

    def to_dict(self) -> dict:
        return {"coefficients": list(self.coefficients), "intercept": self.intercept, "calibrated": self.calibrated, "features": self.features}

    @classmethod
    def from_dict(cls, d: Mapping) -> "LinearModel":
        return cls(tuple(d["coefficients"]), d["intercept"], d["calibrated"], d["features"])


def _starts(table: DataFrame, fits: Sequence[LinearFit], size: int, row: int) -> None:
    """Start hinge fits over a large table at the minimum over some of its rows, one for each point, with their losses weighted up."""
    todo = [f for f in fits if f.hinge and f.start is None and not f.point.get("max_iter")]
    if not todo or size <= fitting.SMALL_BYTES:
        return
    rows = table.count()
    wanted = min(START_ROWS, fitting.SMALL_BYTES // row)

    def some(batches):
        for batch in batches:
            yield batch.filter(uniform(batch.column("id").to_numpy(), 1) * rows < wanted)

    part = table.mapInArrow(some, table.schema).persist()
    try:
        held = part.count()
        if not held:
            return
        asked = list(grouped_by(todo, lambda f: (f.map, tuple(sorted(f.point.items())))).values())
        near = [replace(g[0], key=k, fold=-1, point={**g[0].point, "C": float(g[0].point.get("C", 1.0)) * rows / held}) for k, g in enumerate(asked)]
        for g, (w, _) in zip(asked, fit_together(part, near, "float64", row - 20)):
            for f in g:
                f.start = w
    finally:
        part.unpersist()


def search(name: str, data: DataFrame, points: Sequence[Mapping], folds: Sequence, features: str = "features", maps: Sequence | None = None,
           near: Callable[[int, object], Sequence["LinearModel"]] | None = None):
    """(held-out counts, models), both by place of the point and fold. The fits of all points and folds are one run.

    A fold may be a tuple of folds that are all left out, which gives no counts. `maps` has each point's map of the cells, or None;
    a mapped model reads the column `__z`. `near` gives models between which the fit of a point and fold starts.
    """
    first = data.select(F.size(vector_to_array(features))).first()
    table = packed_table(data, lambda x: x.astype(np.float64), features)
    hinge, width = name == "svm", first[0] if first else 0
    maps = maps or [None] * len(points)
    widths = [width if how is None else how.size for how in maps]
    tasks = [(i, f) for i in range(len(points)) for f in folds]
    fits = [LinearFit(t, f, widths[i], points[i], hinge, widths[i] <= SECOND_ORDER, maps[i]) for t, (i, f) in enumerate(tasks)]
    for f, t in zip(fits, tasks):
        known = list(near(*t)) if near is not None else []
        if known:
            f.start = np.mean([np.r_[m.coefficients, m.intercept] for m in known], axis=0)
    row = 8 * max([width, *widths])
    _starts(table, fits, table_bytes(table, row), row + 20)
    found = dict(zip(tasks, fit_together(table, fits, "float64", row)))
    models = {t: LinearModel(tuple(w[:-1].tolist()), float(w[-1]), not hinge, features if maps[t[0]] is None else "__z") for t, (w, _) in found.items()}
    return {t: held for t, (_, held) in found.items()}, models


def fit(name: str, data: DataFrame, point: Mapping, features: str = "features", how=None) -> LinearModel:
    """The model of one point over all rows."""
    return search(name, data, [point], [-1], features, [how])[1][0, -1]


@dataclass(frozen=True)
class Column:
    """The map that picks one cell."""

    index: int
    size: int = 1

    def cells(self, x: np.ndarray) -> np.ndarray:
        return x[:, [self.index]]


def calibrations(data: DataFrame, plans: Sequence[tuple[tuple, Mapping[int, LinearModel]]], how=None, features: str = "features") -> list[LinearModel]:
    """Logistic curves over out-of-fold margins (Platt, 1999), all fitted in one run.

    A plan has the folds it leaves out, and the model whose margins it reads for each other fold; for all rows if there are no folds.
    """
    table = packed_table(data, lambda x: x.astype(np.float64), features)
    models = list({id(m): m for _, known in plans for m in known.values()}.values())
    place = {id(m): k for k, m in enumerate(models)}
    asked = [{f: place[id(m)] for f, m in known.items()} for _, known in plans]
    weights = np.stack([np.r_[m.coefficients, m.intercept] for m in models], 1)

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = fitting.rows_of(batch, "float64")
            if not len(rows.y):
                continue
            out = np.zeros((len(rows.y), len(asked)))
            for at, x in _blocks(rows, how):
                found = x @ weights
                for k, known in enumerate(asked):
                    for f, m in known.items():
                        own = rows.fold[at] == f
                        out[at, k][own] = found[own, m]
            cells = pa.array([r.tobytes() for r in out], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), cells, batch.column("label"), batch.column("fold")], ["id", "x", "label", "fold"])

    held = table.mapInArrow(margins, "id long, x binary, label double, fold int").persist()
    try:
        fits = [LinearFit(k, tuple(out), 1, {"C": UNBOUND}, map=Column(k)) for k, (out, _) in enumerate(plans)]
        found = fit_together(held, fits, "float64")
    finally:
        held.unpersist()
    return [LinearModel(tuple(w[:-1].tolist()), float(w[-1]), True, "__m") for w, _ in found]

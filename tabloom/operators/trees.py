"""Decision trees, forests and second-order boosted trees over one binned table, all points and folds of a search at once.

Columns are cut into at most `BINS` bins: at every value where there are few, else at quantiles. Trees grow level by level
from sums per (tree, node, column, bin). Smaller models are read off larger ones: a shallower tree or one with more rows to
split is the deep tree cut short, fewer trees are the first ones of many. So a search grows one tree for each criterion and
leaf size, one forest for each column choice, one booster for each of the other parameters.

Rows of equal bins always fall to the same leaf, so tasks hold them as one shape with counts, and sums run over shapes. A forest's
trees grow `OPEN_TREES` at a time, and a level in parts, so that the sums of a round take about `ROUND_BYTES`; rows keep nothing of trees
that are done.

Which rows a tree sees (bootstrap, subsample) and which columns a node may use follow from hashes of row, tree and node.
Bootstrap counts are Poisson numbers. Of equal splits the first column and the lowest bin win. A split needs a gain in boosting;
in other trees an impure node is split even without one.
"""

from __future__ import annotations

import math
from collections.abc import Generator, Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import fitting
from .fitting import Fit, Rows, fit_together, grouped, grouped_by, held_out_counts, packed_table, table_bytes, uniform

BINS, MAX_DEPTH, SHRINK = 256, 30, 1.0
#: Bins of several columns that are summed up as one code.
JOINED = 64
#: Bytes of sums and open trees of a fit in a round.
ROUND_BYTES, OPEN_TREES = 16 << 20, 8
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])


# ---- trees ----------------------------------------------------------------------


@dataclass
class Tree:
    """Nodes in flat arrays. A row goes left if its bin is at most `bin`; the right child follows the left one. Leaves have column -1."""

    column: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    value: np.ndarray
    rows: np.ndarray
    depth: np.ndarray
    path: np.ndarray

    @classmethod
    def root(cls) -> "Tree":
        one = lambda v, t: np.array([v], t)
        return cls(one(-1, np.int32), one(0, np.int32), one(0, np.int32), one(0, float), one(0, float), one(0, np.int32), one(1, np.int64))

    def split(self, node: np.ndarray, column: np.ndarray, bin: np.ndarray) -> np.ndarray:
        """Splits nodes; gives the numbers of their left children."""
        left = len(self.column) + 2 * np.arange(len(node))
        self.column[node], self.bin[node], self.left[node] = column, bin, left
        both = np.repeat(node, 2)
        more = lambda a, v: np.concatenate([a, np.asarray(v, a.dtype)])
        self.column, self.bin, self.left = more(self.column, np.full(len(both), -1)), more(self.bin, both * 0), more(self.left, both * 0)
        self.value, self.rows = more(self.value, self.value[both]), more(self.rows, np.zeros(len(both)))
        self.depth = more(self.depth, self.depth[both] + 1)
        self.path = more(self.path, 2 * self.path[both] + np.tile([0, 1], len(node)))
        return left

    def leaves(self, x: np.ndarray, node: np.ndarray | None = None) -> np.ndarray:
        """The leaf of each row, from the root or from nodes reached before."""
        node = np.zeros(len(x), np.intp) if node is None else node.copy()
        by_column = x.flags.f_contiguous  # cells are taken by their place, in either order
        cells = (x.T if by_column else np.ascontiguousarray(x)).reshape(-1)
        own, at = self.column.take(node), None
        while (open_ := own >= 0).any():
            if at is None or not open_.all():
                at, own = (np.flatnonzero(open_) if at is None else at[open_]), own[open_]
            above, column = node.take(at), own.astype(np.intp)
            cell = cells.take(column * len(x) + at if by_column else at * x.shape[1] + column)
            below = self.left.take(above) + (cell > self.bin.take(above))
            node[at] = below
            own = self.column.take(below)
        return node

    def cut(self, max_depth: int | None, min_rows: float) -> "Tree":
        """The tree that would have grown under these limits."""
        stop = (self.rows < min_rows) | (self.depth >= (max_depth or MAX_DEPTH))
        return Tree(np.where(stop, -1, self.column).astype(np.int32), self.bin, self.left, self.value, self.rows, self.depth, self.path)


@dataclass(frozen=True)
class Layout:
    """Where each column's bins begin among all bins, and the cells above which the next bin begins."""

    cuts: tuple[np.ndarray, ...]

    @cached_property
    def size(self) -> int:
        return sum(len(c) + 1 for c in self.cuts)

    @cached_property
    def begin(self) -> np.ndarray:
        return np.cumsum([0] + [len(c) + 1 for c in self.cuts])[:-1]

    @cached_property
    def widths(self) -> np.ndarray:
        return np.array([len(c) + 1 for c in self.cuts], np.intp)

    @cached_property
    def joined(self) -> list[list[int]]:
        """Neighbouring columns whose bins are summed up as one code, since they have at most `JOINED` of them together."""
        out, bins = [], JOINED + 1
        for c, width in enumerate(self.widths.tolist()):
            bins = bins * width
            if bins > JOINED:
                out.append([])
                bins = width
            out[-1].append(c)
        return out

    def binned(self, x: np.ndarray) -> np.ndarray:
        if not len(self.cuts):
            return np.zeros((len(x), 0), np.uint16)
        return np.stack([np.searchsorted(c, x[:, i], "left") for i, c in enumerate(self.cuts)], 1).astype(np.uint16)


def bin_layout(data: DataFrame, features: str = "features", bins: int = BINS) -> Layout:
    """Cuts of all columns: between neighbouring values where there are fewer than `bins` of them, else at quantiles."""
    cells = data.select(F.posexplode(vector_to_array(features)).alias("column", "cell"))
    about = cells.groupBy("column").agg(
        F.approx_count_distinct("cell", 0.02).alias("n"), F.percentile_approx("cell", [i / bins for i in range(1, bins)], 10_000).alias("at"))
    found = {r["column"]: (r["n"], r["at"]) for r in about.collect()}
    few = [c for c, (n, _) in found.items() if n <= 0.8 * bins]
    values = cells.where(F.col("column").isin(few)).groupBy("column").agg(F.sort_array(F.collect_set("cell")).alias("v")).collect() if few else []
    exact = {r["column"]: np.array(r["v"], float) for r in values}
    cuts = []
    for c in sorted(found):
        if c in exact and len(exact[c]) <= bins:
            cuts.append((exact[c][1:] + exact[c][:-1]) / 2)
        else:
            cuts.append(np.unique(np.array(found[c][1], float)))
    return Layout(tuple(cuts))


def binned_table(data: DataFrame, layout: Layout, features: str = "features") -> DataFrame:
    """id, x, label, fold: rows with their bins."""
    return packed_table(data, layout.binned, features)


# ---- sums and splits ------------------------------------------------------------


def _shapes(rows: Rows) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of bins, column by column, and the number of its shape for each row; found once for all fits of a task."""
    if "shapes" not in rows.shared:
        x = np.ascontiguousarray(rows.x)
        if not x.shape[1]:
            rows.shared["shapes"] = x[: min(1, len(x))], np.zeros(len(x), np.int32)
        else:
            key = x.view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel()
            _, first, shape = np.unique(key, return_index=True, return_inverse=True)
            rows.shared["shapes"] = np.asfortranarray(x[first]), shape.astype(np.int32).ravel()
    return rows.shared["shapes"]


def _counts(rows: Rows, at: np.ndarray, *weights: np.ndarray) -> list[np.ndarray]:
    """Rows of each shape among the rows `at`, and their sums of each weight."""
    x, shape = _shapes(rows)
    own = shape[at]
    return [np.bincount(own, w, len(x)) for w in (None, *weights)]


def _codes(rows: Rows, layout: Layout) -> np.ndarray:
    """The bins of each shape, those of joined columns as one code; found once for all fits of a task."""
    if "codes" not in rows.shared:
        x, _ = _shapes(rows)
        out = np.zeros((len(x), len(layout.joined)), np.intp, "F")
        for i, columns in enumerate(layout.joined):
            for c in columns:
                out[:, i] = out[:, i] * layout.widths[c] + x[:, c]
        rows.shared["codes"] = out
    return rows.shared["codes"]


def _histogram(codes: np.ndarray, at: np.ndarray, place: np.ndarray, nodes: int, layout: Layout, channels: Sequence[np.ndarray]) -> np.ndarray:
    """Sums of each channel per node and bin over the shapes `at`, which are at nodes 0, 1 ...; the channels hold whole numbers."""
    out, channels = np.zeros((len(channels), nodes, layout.size)), [c.take(at) for c in channels]
    for i, columns in enumerate(layout.joined):
        bins, widths = codes[:, i].take(at), layout.widths[columns]
        count = int(widths.prod())
        if nodes > 1:
            bins = place * count + bins
        for k, c in enumerate(channels):
            sums = np.bincount(bins, c, nodes * count).reshape(nodes, *widths)
            for j, column in enumerate(columns):
                begin = layout.begin[column]
                others = tuple(a for a in range(1, 1 + len(columns)) if a != j + 1)
                out[k, :, begin : begin + widths[j]] = sums.sum(others) if others else sums
    return out


def _sides(sums: np.ndarray, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
    """Sums up to each bin of its column, and beyond it; channel, node, bin."""
    upto = np.cumsum(sums, axis=2)
    begin = layout.begin
    before = np.where(begin > 0, upto[:, :, np.maximum(begin - 1, 0)], 0.0)
    widths = layout.widths
    left = upto - np.repeat(before, widths, axis=2)
    whole = left[:, :, begin + widths - 1]
    return left, np.repeat(whole, widths, axis=2) - left


def _chosen(gain: np.ndarray, layout: Layout, allowed: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Column, bin and gain of each node's best split; `allowed` has a node's order of columns and how many of them it may use."""
    best = np.maximum.reduceat(gain, layout.begin, axis=1)
    if allowed is not None:
        order, most = allowed
        usable = np.isfinite(best)
        near = usable & (order < most)
        first = np.argmin(np.where(usable, order, np.inf), axis=1)  # where none of its columns can split, the next one that can
        alone = np.zeros_like(near)
        alone[np.arange(len(near)), first] = True
        best = np.where(np.where(near.any(1)[:, None], near, alone), best, -np.inf)
    column = np.argmax(best, axis=1)
    widths = layout.widths
    bins = np.array([int(np.argmax(gain[i, layout.begin[c] : layout.begin[c] + widths[c]])) for i, c in enumerate(column.tolist())], np.int64)
    return column, bins, best[np.arange(len(best)), column]


def _impurity(weight: np.ndarray, ones: np.ndarray, criterion: str) -> np.ndarray:
    """Weighted Gini impurity or entropy."""
    with np.errstate(divide="ignore", invalid="ignore"):
        p = np.where(weight > 0, ones / weight, 0.0)
        if criterion == "gini":
            return 2 * weight * p * (1 - p)
        part = lambda q: np.where(q > 0, -q * np.log2(np.where(q > 0, q, 1.0)), 0.0)
        return weight * (part(p) + part(1 - p))


def _most_columns(choice: str, width: int) -> int:
    """The columns that a node may use."""
    return max(1, int(math.sqrt(width) if choice == "sqrt" else math.log2(width)))


# ---- trees of classes -----------------------------------------------------------


@dataclass
class ClassTrees(Fit):
    """One deep tree, or a forest, and what smaller ones read off it score on the held-out fold."""

    key: object
    fold: int
    layout: Layout
    points: Sequence[Mapping]
    criterion: str = "gini"
    min_leaf: int = 1
    max_features: str | None = None
    trees: int = 1
    bootstrap: bool = False
    seed: int = 42

    @property
    def cost(self) -> float:
        return float(self.trees)

    def weights(self, rows: Rows, tree: int) -> tuple[np.ndarray, ...]:
        """By shape: rows that the tree sees, their weight, and that of class 1."""
        own = (self.key, "weight", tree)
        if own not in rows.kept:
            seen = rows.fold != self.fold
            if self.bootstrap:
                weight = np.searchsorted(_POISSON, uniform(rows.id, self.seed, tree), "right").astype(float)
                at = np.flatnonzero(seen & (weight > 0))
                rows.kept[own] = _counts(rows, at, weight[at], weight[at] * rows.y[at])
            else:
                at = np.flatnonzero(seen)
                n, ones = _counts(rows, at, rows.y[at])
                rows.kept[own] = n, n.astype(float), ones
        return rows.kept[own]

    def sums(self, rows: Rows, state) -> np.ndarray:
        if state[0] == "score":
            return self._held_out(rows, state[1])
        (x, _), codes = _shapes(rows), _codes(rows, self.layout)
        for own in [k for k in rows.kept if k[0] == self.key and k[2] < min(state[1])]:  # trees that are done
            del rows.kept[own]
        out = []
        for t, (tree, frontier) in state[1].items():
            own = (self.key, "node", t)
            rows.kept[own] = node = tree.leaves(x, rows.kept.get(own))
            place = np.full(len(tree.column), -1)
            place[frontier] = np.arange(len(frontier))
            place, weights = place.take(node), self.weights(rows, t)
            at = np.flatnonzero((place >= 0) & (weights[0] > 0))
            out.append(_histogram(codes, at, place.take(at), len(frontier), self.layout, weights).ravel())
        return np.concatenate(out)

    def run(self) -> Generator:
        deepest = max((p.get("max_depth") or MAX_DEPTH) for p in self.points)
        least = min(p.get("min_samples_split", 2) for p in self.points)
        trees, size = [Tree.root() for _ in range(self.trees)], self.layout.size
        most = max(1, ROUND_BYTES // (3 * 8 * size))
        # nodes whose sums are still to be taken, at this level and the next one, by tree; a tree that is done leaves
        waiting = {t: (np.zeros(1, np.int64), []) for t in range(self.trees)}
        while waiting:
            asked, room = {}, most
            for t, (level, _) in waiting.items():
                if room <= 0 or len(asked) == OPEN_TREES:
                    break
                asked[t] = trees[t], level[:room]
                room -= len(level)
            sums, at = (yield ("grow", asked)), 0
            for t, (tree, frontier) in asked.items():
                m = len(frontier)
                own = sums[at : at + 3 * m * size].reshape(3, m, size)
                at += 3 * m * size
                level, below = waiting.pop(t)
                made = self._grown(tree, t, frontier, own, int(tree.depth[frontier[0]]) < deepest, least)
                level, below = level[m:], [*below, made]
                if not len(level):
                    level, below = np.sort(np.concatenate(below)), []
                if len(level):
                    waiting[t] = level, below
            waiting = dict(sorted(waiting.items()))
        counts = (yield ("score", trees)) if self.fold >= 0 else None
        return trees, None if counts is None else counts.reshape(len(self.points), -1)

    def _grown(self, tree: Tree, t: int, frontier: np.ndarray, sums: np.ndarray, deeper: bool, least: int) -> np.ndarray:
        """Values of the nodes of a level, and the next level."""
        first = int(self.layout.widths[0])
        rows, weight, ones = sums[:, :, :first].sum(2)
        tree.rows[frontier] = rows
        tree.value[frontier] = np.where(weight > 0, ones / np.maximum(weight, 1e-300), tree.value[frontier])
        open_ = (rows >= least) & (ones > 0) & (ones < weight)
        if not deeper or not open_.any():
            return np.zeros(0, np.int64)
        frontier, sums = frontier[open_], sums[:, open_]
        left, right = _sides(sums, self.layout)
        gain = -_impurity(left[1], left[2], self.criterion) - _impurity(right[1], right[2], self.criterion)
        gain = np.where((left[0] >= max(1, self.min_leaf)) & (right[0] >= max(1, self.min_leaf)), gain, -np.inf)
        allowed, width = None, len(self.layout.cuts)
        if self.max_features:
            most = _most_columns(self.max_features, width)
            order = uniform(np.arange(width), self.seed, t, tree.path[frontier][:, None]).argsort(1).argsort(1)
            allowed = (order, most)
        column, bins, best = _chosen(gain, self.layout, allowed)
        good = np.isfinite(best)
        made = tree.split(frontier[good], column[good], bins[good])
        return np.sort(np.r_[made, made + 1])

    def _held_out(self, rows: Rows, trees: Sequence[Tree]) -> np.ndarray:
        x, shape = _shapes(rows)
        held = rows.fold == self.fold
        own, y = shape[held], rows.y[held]
        rows.kept = {k: v for k, v in rows.kept.items() if k[0] != self.key}
        seen = np.unique(own)
        out = []
        for limits, points in grouped(self.points, "max_depth", "min_samples_split").items():
            wanted = {p.get("n_estimators", 1) for p in points}
            total, at = np.zeros(len(x)), {}
            for k, tree in enumerate(trees, 1):
                cut = tree.cut(limits[0], limits[1] or 2)
                total[seen] += cut.value[cut.leaves(x[seen])]
                if k in wanted:
                    at[k] = held_out_counts(y, (total / k)[own])
            out += [(self.points.index(p), at[p.get("n_estimators", 1)]) for p in points]
        return np.concatenate([c for _, c in sorted(out, key=lambda o: o[0])])


# ---- boosted trees --------------------------------------------------------------


@dataclass
class Boosted(Fit):
    """Trees on gradients and curvatures of the logistic loss. Fewer rounds are the first ones of many."""

    key: object
    fold: int
    layout: Layout
    points: Sequence[Mapping]
    max_depth: int = 3
    rate: float = 0.1
    subsample: float = 1.0
    min_child_weight: float = 1.0
    shrink: float = SHRINK
    seed: int = 42

    @property
    def cost(self) -> float:
        return float(self.max_depth * max(p["n_estimators"] for p in self.points))

    def rounds(self, state) -> int:
        return state["before"] + len(state["trees"])

    def trimmed(self, state, done: int):
        return state if state["what"] == "score" else {**state, "before": done, "trees": state["trees"][done - state["before"]:]}

    def margins(self, rows: Rows, state) -> np.ndarray:
        """Rows of one shape have one margin, so it is kept by shape in a task and by row between rounds over rows that stay.

        It is that of rows the fit sees; nothing asks for the others'.
        """
        return self._margin(rows, state)[_shapes(rows)[1]]

    def _margin(self, rows: Rows, state) -> np.ndarray:
        x, shape = _shapes(rows)
        if (self.key, "shape margin") in rows.kept:
            done, margin = rows.kept[self.key, "shape margin"]
        elif (self.key, "margin") in rows.kept:
            done, held = rows.kept[self.key, "margin"]
            margin = np.zeros(len(x))
            margin[shape] = held
        else:
            done, margin = 0, np.full(len(x), state["start"])
        for round_, tree in enumerate(state["trees"][done - state["before"]:], done):
            for leaf, at in self._leaves(rows, tree, round_).items():
                margin[at] += tree.value[leaf]
        rows.kept[self.key, "shape margin"] = (self.rounds(state), margin)
        return margin

    def _leaves(self, rows: Rows, tree: Tree, round_: int) -> dict[int, np.ndarray]:
        """The shapes at each leaf in the tree of a round, from where its last levels led; only those of rows that the fit sees."""
        x, shape = _shapes(rows)
        was, leaves = rows.kept.get((self.key, "leaves"), (None, None))
        if was != round_:
            if (self.key, "all") not in rows.kept:
                rows.kept[self.key, "all"] = np.flatnonzero(np.bincount(shape[rows.fold != self.fold], minlength=len(x)))
            leaves = {0: rows.kept[self.key, "all"]}
            rows.kept[self.key, "leaves"] = round_, leaves
        column, bin, left = (a.tolist() for a in (tree.column, tree.bin, tree.left))
        open_ = [i for i in leaves if column[i] >= 0]
        for i in open_:  # goes on with the children
            at = leaves.pop(i)
            above = x[:, column[i]].take(at) > bin[i]
            leaves[left[i]], leaves[left[i] + 1] = at[~above], at[above]
            open_ += [c for c in (left[i], left[i] + 1) if column[c] >= 0]
        return leaves

    def _sampled(self, rows: Rows, round_: int) -> list[np.ndarray]:
        """Rows of each shape that the round's tree sees, and those of class 1."""
        own = (self.key, "sample")
        if own not in rows.kept or (self.subsample < 1 and rows.kept[own][0] != round_):
            if (self.key, "seen") not in rows.kept:
                rows.kept[self.key, "seen"] = np.flatnonzero(rows.fold != self.fold)
            at = rows.kept[self.key, "seen"]
            if self.subsample < 1:
                at = at[uniform(rows.id[at], self.seed, round_) < self.subsample]
            rows.kept[own] = round_, _counts(rows, at, rows.y[at])
        return rows.kept[own][1]

    def sums(self, rows: Rows, state) -> np.ndarray:
        if state["what"] == "mean":
            seen = rows.fold != self.fold
            return np.array([seen.sum(), rows.y[seen].sum()], float)
        if state["what"] == "score":
            x, shape = _shapes(rows)
            held = rows.fold == self.fold
            seen, own = np.unique(shape[held], return_inverse=True)
            x, margin, at = x[seen], np.full(len(seen), state["start"]), {}
            wanted = {p["n_estimators"] for p in self.points}
            for k, tree in enumerate(state["trees"], 1):
                margin = margin + tree.value[tree.leaves(x)]
                if k in wanted:
                    at[k] = margin[own]
            return np.concatenate([held_out_counts(rows.y[held], 1 / (1 + np.exp(-at[p["n_estimators"]]))) for p in self.points])
        tree, frontier = state["tree"], state["frontier"]
        channels = self._bent(rows, state)
        leaves = self._leaves(rows, tree, self.rounds(state))
        asked = [leaves[i] for i in frontier.tolist()]
        place = np.repeat(np.arange(len(asked)), [len(at) for at in asked])
        return _histogram(_codes(rows, self.layout), np.concatenate(asked), place, len(asked), self.layout, channels).ravel()

    def _bent(self, rows: Rows, state) -> tuple[np.ndarray, np.ndarray]:
        """Sums of gradients and curvatures over the rows of each shape that the round's tree sees, in whole units; taken once for all levels."""
        own, round_ = (self.key, "bent"), self.rounds(state)
        if own not in rows.kept or rows.kept[own][0] != round_:
            margin = self._margin(rows, state)
            n, ones = self._sampled(rows, round_)
            p = 1 / (1 + np.exp(-margin))
            slope, curve = np.rint(p * state["unit"]), np.rint(p * (1 - p) * state["unit"])  # a row's, so that parts of a shape add up
            rows.kept[own] = round_, (n * slope - ones * state["unit"], n * curve)
        return rows.kept[own][1]

    def _leaf(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return -self.rate * g / (h + self.shrink)

    def run(self) -> Generator:
        n, ones = yield {"what": "mean", "before": 0, "trees": []}
        share = min(max(ones / n if n else 0.5, 1e-6), 1 - 1e-6)
        start, trees, size = math.log(share / (1 - share)), [], self.layout.size
        # whole units, of which all rows' sums are exact: what a node's sums are less one child's are the other child's
        unit = 2.0 ** (52 - int(n).bit_length())
        state = {"start": start, "before": 0, "trees": trees, "unit": unit}
        for _ in range(max(p["n_estimators"] for p in self.points)):
            tree, frontier, held, side = Tree.root(), np.zeros(1, np.int64), None, None
            for _ in range(self.max_depth):
                asked = frontier if held is None else frontier[side]
                sums = yield {**state, "what": "grow", "tree": tree, "frontier": asked}
                sums = sums.reshape(2, len(asked), size) / unit
                if held is not None:
                    both = np.repeat(held, 2, axis=1)
                    both[:, side ^ 1] -= sums
                    both[:, side] = sums
                    sums = both
                left, right = _sides(sums, self.layout)
                all_ = left + right
                score = lambda s: s[0] ** 2 / (s[1] + self.shrink)
                gain = score(left) + score(right) - score(all_)
                good = (left[1] >= self.min_child_weight) & (right[1] >= self.min_child_weight) & (gain > 1e-9)
                column, bins, best = _chosen(np.where(good, gain, -np.inf), self.layout, None)
                if tree.column.size == 1:
                    tree.value[0] = self._leaf(*all_[:, 0, 0])
                able = np.flatnonzero(np.isfinite(best))
                made = tree.split(frontier[able], column[able], bins[able])
                at = self.layout.begin[column[able]] + bins[able]
                tree.value[made], tree.value[made + 1] = self._leaf(*left[:, able, at]), self._leaf(*right[:, able, at])
                frontier = np.repeat(made, 2) + np.tile([0, 1], len(made))
                if not len(frontier):
                    break
                # the side with less to sum up, by place in the frontier
                held, side = sums[:, able], 2 * np.arange(len(made)) + (left[1, able, at] > right[1, able, at])
            trees.append(tree)
        counts = (yield {**state, "what": "score"}) if self.fold >= 0 else None
        return (start, trees), None if counts is None else counts.reshape(len(self.points), -1)


# ---- models ---------------------------------------------------------------------


@dataclass(frozen=True)
class TreeModel:
    """Trees whose values are averaged, or added up to a margin that starts at `start`."""

    layout: Layout
    trees: tuple[Tree, ...]
    start: float | None = None
    features: str = "features"

    def hasParam(self, name: str) -> bool:
        return name == "probabilityCol"

    def shares(self, x: np.ndarray) -> np.ndarray:
        """The probability of class 1 for rows of cells."""
        x = self.layout.binned(x)
        total = np.zeros(len(x))
        for tree in self.trees:
            total = total + tree.value[tree.leaves(x)]
        return total / max(1, len(self.trees)) if self.start is None else 1 / (1 + np.exp(-(self.start + total)))

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds probability and prediction."""
        own = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def share(x: pd.Series) -> pd.Series:
            return pd.Series(own.value.shares(np.stack(x.to_list())) if len(x) else [], dtype=float)

        scored = df.withColumn("__share", share(vector_to_array(self.features)))
        both = array_to_vector(F.array(1 - F.col("__share"), F.col("__share")))
        return scored.withColumns({"probability": both, "prediction": (F.col("__share") > 0.5).cast("double")}).drop("__share")

    def to_dict(self) -> dict:
        trees = [{k: getattr(t, k).tolist() for k in Tree.__dataclass_fields__} for t in self.trees]
        return {"cuts": [c.tolist() for c in self.layout.cuts], "trees": trees, "start": self.start, "features": self.features}

    @classmethod
    def from_dict(cls, d: Mapping) -> "TreeModel":
        kinds = {k: v.dtype for k, v in vars(Tree.root()).items()}
        trees = tuple(Tree(**{k: np.array(v, kinds[k]) for k, v in t.items()}) for t in d["trees"])
        return cls(Layout(tuple(np.array(c, float) for c in d["cuts"])), trees, d["start"], d["features"])


#: Parameters that need a growth of their own; the others are read off.
GROWN = {
    "decision_tree": ("criterion", "min_samples_leaf"), "random_forest": ("max_features", "min_samples_leaf", "criterion"),
    "xgboost": ("max_depth", "learning_rate", "subsample", "min_child_weight", "reg_lambda"),
}


def _fit(name: str, points: Sequence[Mapping], fold: int, layout: Layout, seed: int, key: object) -> Fit:
    p = points[0]
    if name == "xgboost":
        points = [{"n_estimators": 100, **q} for q in points]
        return Boosted(key, fold, layout, points, p.get("max_depth", 3), p.get("learning_rate", 0.1), p.get("subsample", 1.0),
                       p.get("min_child_weight", 1), p.get("reg_lambda", SHRINK), seed)
    if name == "random_forest":
        points = [{"n_estimators": 100, **q} for q in points]
        return ClassTrees(key, fold, layout, points, p.get("criterion", "gini"), p.get("min_samples_leaf", 1), p.get("max_features", "sqrt"),
                          max(q["n_estimators"] for q in points), True, seed)
    return ClassTrees(key, fold, layout, points, p.get("criterion", "gini"), p.get("min_samples_leaf", 1), seed=seed)


def _model(name: str, point: Mapping, grown, layout: Layout, features: str) -> TreeModel:
    if name == "xgboost":
        start, trees = grown
        return TreeModel(layout, tuple(trees[: point.get("n_estimators", 100)]), start, features)
    trees = grown[: point.get("n_estimators", 100)] if name == "random_forest" else grown
    return TreeModel(layout, tuple(t.cut(point.get("max_depth"), point.get("min_samples_split", 2)) for t in trees), None, features)


def _growths(name: str, points: Sequence[Mapping], width: int) -> list[list[Mapping]]:
    """Points that can be read off one growth; choices of as many columns are one choice."""
    def key(p: Mapping) -> tuple:
        own = [p.get(n) for n in GROWN[name]]
        if name == "random_forest" and width:
            own[0] = _most_columns(own[0] or "sqrt", width)
        return tuple(own)

    return list(grouped_by(points, key).values())


def search(name: str, data: DataFrame, points: Sequence[Mapping], folds: Sequence[int], seed: int, features: str = "features",
           binned: tuple[Layout, DataFrame] | None = None):
    """(held-out counts by point and fold, models by point and fold as a function). Each growth of each fold is one fit of one run.

    Fold -1 leaves no row out; these fits are left away where those of all growths would take longer than the one that is wanted.
    `binned` has the layout and the binned rows of the frame, if they are known.
    """
    layout = binned[0] if binned else bin_layout(data, features)
    table = binned[1] if binned else binned_table(data, layout, features)
    points = list(points)
    groups = _growths(name, points, len(layout.cuts))
    if len(groups) > data.sparkSession.sparkContext.defaultParallelism and table_bytes(table) <= fitting.SMALL_BYTES:
        folds = [f for f in folds if f >= 0]
    tasks = [(g, f) for g in groups for f in folds]
    fits = [_fit(name, g, f, layout, seed, i) for i, (g, f) in enumerate(tasks)]
    results = fit_together(table, fits, "uint16")
    counts, where = {}, {}
    for (g, f), (grown, held) in zip(tasks, results):
        for p, c in zip(g, held if held is not None else [None] * len(g)):
            i = points.index(p)
            counts[i, f], where[i, f] = c, grown
    return counts, lambda i, f: _model(name, points[i], where[i, f], layout, features) if (i, f) in where else None


def grow(name: str, data: DataFrame, point: Mapping, seed: int, features: str = "features") -> TreeModel:
    """The model of one point over all rows."""
    layout = bin_layout(data, features)
    fit = _fit(name, [point], -1, layout, seed, 0)
    grown, _ = fit_together(binned_table(data, layout, features), [fit], "uint16")[0]
    return _model(name, point, grown, layout, features)

"""Classifiers trained by grid search over given folds, all points and folds fitted together."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property, partial, reduce
from itertools import product
from multiprocessing.pool import ThreadPool
from threading import RLock

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..functions.kinds import clean_double
from . import evaluate as ev
from . import linear, trees
from .fitting import best_point, held_out_score

FEATURES, LABEL, FOLD = "features", "label", "fold"


def assemble(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Pack numeric columns into the vector column the classifiers read."""
    doubles = df.withColumns({c: clean_double(df, c) for c in columns})
    packed = VectorAssembler(inputCols=list(columns), outputCol=FEATURES).transform(doubles)
    return packed.select(*keep, FEATURES)


def _grid(**axes) -> list[dict]:
    return [dict(zip(axes, values)) for values in product(*axes.values())]


# The full search grids. The choice of a solver has no counterpart and is left out.
_C = (0.001, 0.01, 0.1, 1, 10, 100)
FULL_GRIDS = {
    "logreg": _grid(C=_C, l1_ratio=(1.0,)) + _grid(C=_C, l1_ratio=(0.0,))
    + _grid(C=_C[:5], l1_ratio=(0.2, 0.5, 0.8)),
    "decision_tree": _grid(max_depth=(None, 3, 5, 10, 20), min_samples_split=(2, 5, 10), criterion=("gini", "entropy"),
                           min_samples_leaf=(1, 2, 4)),
    "random_forest": _grid(n_estimators=(100, 200), max_depth=(5, 10), min_samples_split=(2, 5), max_features=("sqrt", "log2")),
    "xgboost": _grid(n_estimators=(100, 200), max_depth=(3, 5), learning_rate=(0.05, 0.1),
                     subsample=(0.8, 1.0), min_child_weight=(1, 3)),
    "svm": _grid(kernel=("rbf",), C=(0.1, 1, 10), gamma=("scale", 0.1)) + _grid(kernel=("linear",), C=(0.1, 1, 10)),
}
# A distributed fit has a fixed cost; callers may ask for a short search.
SHORT_GRIDS = {
    "logreg": _grid(C=(0.1, 1), l1_ratio=(0.0,)),
    "decision_tree": _grid(max_depth=(3, 5), criterion=("gini",), min_samples_leaf=(1,)),
    "random_forest": _grid(n_estimators=(20,), max_depth=(5,), max_features=("sqrt",)),
    "xgboost": _grid(n_estimators=(10,), max_depth=(3,), learning_rate=(0.1,), subsample=(1.0,), min_child_weight=(1,)),
    "svm": _grid(kernel=("linear",), C=(1,)),
}
FOURIER_FEATURES = 128


@dataclass(frozen=True)
class FourierMap:
    """Random cosine features approximating a Gaussian kernel (Rahimi and Recht, 2007)."""

    gamma: float
    inputs: int
    seed: int
    size: int = FOURIER_FEATURES

    def cells(self, x: np.ndarray) -> np.ndarray:
        """The features of rows of cells."""
        rng = np.random.default_rng(self.seed)
        weights = rng.normal(0.0, math.sqrt(2 * self.gamma), (self.inputs, self.size))
        shift = rng.uniform(0.0, 2 * math.pi, self.size)
        return math.sqrt(2.0 / self.size) * np.cos(x @ weights + shift)

    def transform(self, df: DataFrame, output: str) -> DataFrame:
        @F.pandas_udf("array<double>")
        def project(x: pd.Series) -> pd.Series:
            return pd.Series(list(self.cells(np.stack(x.to_list()))) if len(x) else [], dtype=object)

        return df.withColumn(output, array_to_vector(project(vector_to_array(FEATURES))))


def kernel_scale(df: DataFrame, width: int) -> float:
    """1 / (columns * variance of all cells)."""
    cells = vector_to_array(FEATURES)
    sums = df.select(
        F.aggregate(cells, F.lit(0.0), lambda a, x: a + x).alias("s"),
        F.aggregate(cells, F.lit(0.0), lambda a, x: a + x * x).alias("q"),
    ).agg(F.sum("s").alias("s"), F.sum("q").alias("q"), F.count(F.lit(1)).alias("n")).first()
    total = sums["n"] * width
    variance = sums["q"] / total - (sums["s"] / total) ** 2
    return 1.0 / (width * variance) if variance > 0 else 1.0


class _Counted:
    """A score that follows from the confusion counts."""

    def __init__(self, scoring: str):
        self.scoring = scoring

    def evaluate(self, scored: DataFrame) -> float:
        return ev.score_value(scored, self.scoring, LABEL, "prediction")


def evaluator(scoring: str):
    """What scores the held-out rows of a search, by the usual names of scores."""
    names = {"f1_weighted": "f1", "accuracy": "accuracy", "f1": "fMeasureByLabel",
             "precision": "precisionByLabel", "recall": "recallByLabel"}
    if scoring == "roc_auc":
        return BinaryClassificationEvaluator(labelCol=LABEL, rawPredictionCol="rawPrediction")
    if scoring in ev.COUNTED_SCORES:
        return _Counted(scoring)
    if scoring not in names:
        raise ValueError(f"unknown scoring {scoring!r}")
    return MulticlassClassificationEvaluator(
        labelCol=LABEL, predictionCol="prediction", metricName=names[scoring], metricLabel=1.0
    )


@dataclass(frozen=True)
class TrainedModel:
    """A fitted classifier with its search result, decision threshold and calibration."""

    name: str
    model: Model
    best_params: dict
    best_score: float
    rows: int
    seed: int = 42
    threshold: float = 0.5
    fourier: FourierMap | None = None
    platt: Model | linear.LinearModel | None = None
    fold_models: tuple[Model, ...] = ()  # from the search; entry i did not see fold i

    def score(self, df: DataFrame, prefix: str = "") -> DataFrame:
        """Add ``probability`` of class 1 and ``prediction`` (0.0 / 1.0)."""
        kept = df.columns
        out = df if self.fourier is None else self.fourier.transform(df, "__z")
        out = self.model.transform(out)
        if "probability" in out.columns:
            p1 = vector_to_array("probability")[1]
        elif isinstance(self.platt, linear.LinearModel):
            p1 = self.platt.probability(vector_to_array("rawPrediction")[1])
        else:
            margins = out.withColumn("__margin", vector_to_array("rawPrediction")[1])
            one = VectorAssembler(inputCols=["__margin"], outputCol="__m").transform(margins)
            one = one.withColumnRenamed("prediction", "__class").drop("rawPrediction")
            out = self.platt.transform(one).drop("prediction").withColumnRenamed("__class", "prediction")
            p1 = vector_to_array("__probability")[1]
        decided = F.col("prediction")
        if self.threshold != 0.5:
            decided = (p1 >= F.lit(self.threshold)).cast("double")
        return out.select(*kept, p1.alias(f"{prefix}probability"), decided.alias(f"{prefix}prediction"))

    predict = score

    @property
    def local(self) -> bool:
        """Whether `of_cells` can score."""
        return isinstance(self.model, OWN_MODELS) and (self.platt is None or isinstance(self.platt, linear.LinearModel))

    def of_cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of class 1 and prediction for rows of cells."""
        if isinstance(self.model, trees.TreeModel):
            p = self.model.shares(x)
            said = p > 0.5
        else:
            margin = self.model.margins(x if self.fourier is None else self.fourier.cells(x))
            said = margin > 0
            curve = np.r_[1.0, 0.0] if self.platt is None else np.r_[self.platt.coefficients, self.platt.intercept]
            p = 1 / (1 + np.exp(-np.clip(curve[0] * margin + curve[1], -700, 700)))
        return p, (said if self.threshold == 0.5 else p >= self.threshold).astype(float)

    def with_threshold(self, threshold: float) -> "TrainedModel":
        return replace(self, threshold=threshold)

    def refit(self, df: DataFrame) -> "TrainedModel":
        """The same configuration trained on another frame."""
        return _fit_one(self.name, self.best_params, df, self.seed, self.fourier, None, self.threshold)

    def fold_copies(self, df: DataFrame, fold: str = FOLD, reuse: bool = False) -> list["TrainedModel"]:
        """Per fold, a copy that did not see it, at the default threshold.

        ``reuse`` takes the copies the search already fitted; only for the searched frame. Either
        way a copy is penalised for the rows it sees and calibrated on these alone.
        """
        folds, family = _folds(df, fold), REGISTRY[self.name](self.name)
        known = {i: m for i, m in enumerate(self.fold_models) if i in folds} if reuse else {}
        whole = df.withColumn(FOLD, F.col(fold)) if fold != FOLD else df
        pairs = [] if self.model.hasParam("probabilityCol") else [(i, j) for i in folds for j in folds if i < j]
        groups = [(i,) for i in folds if i not in known] + pairs
        made = family.left_out(self.best_params, whole, self.seed, self.fourier, groups, known) if groups else {}
        sizes, models = _fold_sizes(whole), [known[i] if i in known else made[i,] for i in folds]
        rows = {i: sum(n for f, n in sizes.items() if f != i) for i in folds}
        inner = {i: {j: made[min(i, j), max(i, j)] for j in folds if j != i} if pairs else {} for i in folds}
        if len(folds) > 1 and pairs and all(isinstance(m, linear.LinearModel) for m in [*models, *made.values()]):
            curves = linear.calibrations(whole, [((i,), inner[i]) for i in folds], self.fourier)
            return [
                TrainedModel(self.name, m, dict(self.best_params), float("nan"), rows[i], self.seed, fourier=self.fourier, platt=c)
                for i, m, c in zip(folds, models, curves)
            ]
        return [
            _fit_one(self.name, self.best_params, whole.where(F.col(FOLD) != i), self.seed, self.fourier, rows[i], model=m, inner=inner[i])
            for i, m in zip(folds, models)
        ]

    def out_of_fold(
        self, df: DataFrame, fold: str = FOLD, prefix: str = "", reuse: bool = False
    ) -> DataFrame:
        """Every row scored by the copy that did not see its fold."""
        return FoldCopies(tuple(self.fold_copies(df, fold, reuse)), fold).score(df, prefix)

    def tune_threshold(
        self, df: DataFrame, scoring: str = "f1", thresholds: Sequence[float] | None = None,
        fold: str = FOLD, reuse: bool = False,
    ) -> tuple["TrainedModel", DataFrame]:
        """Model with the threshold that scores best out of fold, and the whole scan."""
        held_out = self.out_of_fold(df, fold, reuse=reuse)
        scan = ev.threshold_scan(held_out, "probability", LABEL, scoring, thresholds)
        best = ev.best_threshold(scan)
        return (self if best is None else self.with_threshold(best[0])), scan

    def evaluate(self, df: DataFrame, average: str = "weighted") -> dict:
        return ev.metrics(self.score(df), LABEL, "prediction", average).first().asDict()

    def classification_report(self, df: DataFrame) -> DataFrame:
        return ev.class_report(self.score(df), LABEL, "prediction")

    def oof_report(self, df: DataFrame, fold: str = FOLD, reuse: bool = False) -> DataFrame:
        return ev.class_report(self.out_of_fold(df, fold, reuse=reuse), LABEL, "prediction")

    def describe(self) -> dict:
        out = {k: getattr(self, k) for k in ("name", "best_params", "best_score", "rows", "seed", "threshold")}
        if self.fourier is not None:
            f = self.fourier
            out["fourier"] = {"gamma": f.gamma, "inputs": f.inputs, "seed": f.seed, "size": f.size}
        return json.loads(json.dumps(out))

    def save(self, path: str) -> None:
        from ..sources.store import write_json

        if isinstance(self.model, OWN_MODELS):
            write_json({"kind": type(self.model).__name__, **self.model.to_dict()}, f"{path}/model")
        else:
            PipelineModel([self.model]).write().overwrite().save(f"{path}/classifier")
        about = {**self.describe(), "calibrated": self.platt is not None}
        if isinstance(self.platt, linear.LinearModel):
            about["curve"] = self.platt.to_dict()
        elif self.platt is not None:
            PipelineModel([self.platt]).write().overwrite().save(f"{path}/calibration")
        write_json(about, f"{path}/about")

    @classmethod
    def load(cls, path: str) -> "TrainedModel":
        from ..sources.store import exists, read_json

        about = read_json(f"{path}/about")
        calibrated, fourier, curve = about.pop("calibrated"), about.pop("fourier", None), about.pop("curve", None)
        if exists(f"{path}/model"):
            held = read_json(f"{path}/model")
            model = next(m for m in OWN_MODELS if m.__name__ == held["kind"]).from_dict(held)
        else:
            model = PipelineModel.load(f"{path}/classifier").stages[0]
        if curve is not None:
            platt = linear.LinearModel.from_dict(curve)
        else:
            platt = PipelineModel.load(f"{path}/calibration").stages[0] if calibrated else None
        return cls(model=model, platt=platt, fourier=FourierMap(**fourier) if fourier else None, **about)


@dataclass(frozen=True)
class FoldCopies:
    """Copies of a model by the fold that they did not see. Every row is scored by that of its fold; other rows are left out."""

    copies: tuple[TrainedModel, ...]
    fold: str = FOLD

    def score(self, df: DataFrame, prefix: str = "") -> DataFrame:
        if not all(c.local for c in self.copies):
            parts = [c.score(df.where(F.col(self.fold) == i), prefix) for i, c in enumerate(self.copies)]
            return reduce(DataFrame.unionByName, parts)
        own = df.sparkSession.sparkContext.broadcast([replace(c, fold_models=()) for c in self.copies])

        @F.pandas_udf("probability double, prediction double")
        def score(x: pd.Series, fold: pd.Series) -> pd.DataFrame:
            out = np.zeros((len(x), 2))
            for i in fold.unique():
                at = np.flatnonzero(fold == i)
                out[at] = np.stack(own.value[i].of_cells(np.stack(x.iloc[at].to_list())), 1)
            return pd.DataFrame(out, columns=["probability", "prediction"])

        rows = df.where(F.col(self.fold).between(0, len(self.copies) - 1))
        both = rows.withColumn("__both", score(vector_to_array(FEATURES), F.col(self.fold).cast("int")))
        return both.select(*df.columns, *[F.col(f"__both.{c}").alias(f"{prefix}{c}") for c in ("probability", "prediction")])


def _folds(df: DataFrame, fold: str) -> list[int]:
    return list(range(df.agg(F.max(fold)).first()[0] + 1))


def _fold_sizes(df: DataFrame) -> dict[int, int]:
    return {r[0]: r[1] for r in df.groupBy(FOLD).count().orderBy(FOLD).collect()}


def _mapped(df: DataFrame, fourier: FourierMap | None) -> tuple[DataFrame, str]:
    return (df, FEATURES) if fourier is None else (fourier.transform(df, "__z"), "__z")


def _fit_one(
    name, params, df, seed, fourier, rows=None, threshold=0.5, score=float("nan"), fold_models=(), model=None, inner=None
) -> TrainedModel:
    """``inner`` has, by fold, models known already that saw neither that fold nor rows outside the frame."""
    rows = df.count() if rows is None else rows
    if model is None:
        model = REGISTRY[name](name).fit(params, rows, seed, fourier, df)
    trained = TrainedModel(
        name, model, dict(params), score, rows, seed, threshold, fourier, None, tuple(fold_models)
    )
    if model.hasParam("probabilityCol"):
        return trained
    return replace(trained, platt=_calibrate(trained, df, inner or dict(enumerate(fold_models))))


def _calibrate(trained: TrainedModel, df: DataFrame, known: Mapping[int, Model]) -> Model | linear.LinearModel:
    """Logistic curve over out-of-fold margins (Platt, 1999); margins of the fit without folds."""
    present = _fold_sizes(df) if FOLD in df.columns else {}
    if len(present) > 1:
        missing = [(i,) for i in present if i not in known]
        family = REGISTRY[trained.name](trained.name)
        made = family.left_out(trained.best_params, df, trained.seed, trained.fourier, missing, known) if missing else {}
        models = {i: known[i] if i in known else made[i,] for i in present}
    else:
        models = {i: trained.model for i in present or (0,)}
    if all(isinstance(m, linear.LinearModel) for m in models.values()):
        return linear.calibrations(df, [((), models)], trained.fourier)[0]
    data, _ = _mapped(df, trained.fourier)
    if len(present) > 1:
        margins = reduce(DataFrame.unionByName, [m.transform(data.where(F.col(FOLD) == i)) for i, m in models.items()])
    else:
        margins = trained.model.transform(data)
    one = margins.select(F.col(LABEL), vector_to_array("rawPrediction")[1].alias("__margin"))
    packed = VectorAssembler(inputCols=["__margin"], outputCol="__m").transform(one)
    return LogisticRegression(
        featuresCol="__m", labelCol=LABEL, probabilityCol="__probability", rawPredictionCol="__raw",
    ).fit(packed)


@dataclass
class SharedRows:
    """What searches take from a frame, taken once by the first that asks. Threads may ask side by side; the owner calls `release`."""

    df: DataFrame
    lock: object = field(default_factory=RLock)

    @cached_property
    def _data(self) -> DataFrame:
        return self.df.select(FEATURES, LABEL, FOLD).persist(StorageLevel.MEMORY_AND_DISK)

    @cached_property
    def _sizes(self) -> dict[int, int]:
        return _fold_sizes(self._data)

    @cached_property
    def _binned(self) -> tuple[trees.Layout, DataFrame]:
        layout = trees.bin_layout(self._data)
        return layout, trees.binned_table(self._data, layout)

    def data(self) -> DataFrame:
        with self.lock:
            return self._data

    def sizes(self) -> dict[int, int]:
        """Rows by fold."""
        with self.lock:
            return self._sizes

    def binned(self) -> tuple[trees.Layout, DataFrame]:
        """What families of trees read."""
        with self.lock:
            return self._binned

    def release(self) -> None:
        if "_data" in vars(self):
            self._data.unpersist()


def train(
    name: str,
    df: DataFrame,
    scoring: str = "f1_weighted",
    seed: int = 42,
    grid: Sequence[Mapping] | str | None = None,
    parallelism: int = 8,
    shared: SharedRows | None = None,
) -> TrainedModel:
    """Grid search over the ``fold`` column, then refit the best point on all rows.

    The full grid is searched unless ``grid`` gives points or is ``'short'``. The frame holds
    ``features``, ``label`` and ``fold``; it is read once per fit, so it is cached here. Searches
    of the same frame may share what they take from it.
    """
    if name not in REGISTRY:
        raise ValueError(f"unknown model {name!r}; known: {sorted(REGISTRY)}")
    family = REGISTRY[name](name)
    if shared is not None and isinstance(family, (LinearClassifier, TreeClassifier)):
        return family.train(df, scoring, seed, grid, parallelism, shared)
    return family.train(df, scoring, seed, grid, parallelism)


@dataclass(frozen=True)
class Classifier:
    """Search procedure of one model family; subclass and register to add a family."""

    name: str
    options: Mapping = field(default_factory=dict)

    def points(self, grid) -> list[Mapping]:
        if grid is None or grid == "full":
            return FULL_GRIDS[self.name]
        return SHORT_GRIDS[self.name] if grid == "short" else list(grid)

    def estimator(self, params: Mapping, rows: int, seed: int, features: str):
        raise NotImplementedError

    def fit(self, params: Mapping, rows: int, seed: int, fourier: FourierMap | None, df: DataFrame) -> Model:
        """The model of one point over all rows."""
        data, features = _mapped(df, fourier)
        return self.estimator(params, rows, seed, features).fit(data)

    def left_out(
        self, params: Mapping, df: DataFrame, seed: int, fourier: FourierMap | None, groups: Sequence[tuple], known: Mapping[int, Model] = {},
    ) -> dict[tuple, Model]:
        """Models of one point that don't see some folds, by tuples of these; `known` has those that left out one fold."""
        sizes = _fold_sizes(df)
        return {
            g: self.fit(params, sum(n for f, n in sizes.items() if f not in g), seed, fourier, df.where(~F.col(FOLD).isin(*g)))
            for g in groups
        }

    def train(self, df, scoring="f1_weighted", seed=42, grid=None, parallelism=8) -> TrainedModel:
        data = df.select(FEATURES, LABEL, FOLD).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            sizes = _fold_sizes(data)
            rows, best = sum(sizes.values()), None
            for fourier, points in self._groups(data, self.points(grid), seed):
                view = data if fourier is None else fourier.transform(data, "__z")
                features = FEATURES if fourier is None else "__z"
                evaluator(scoring)
                score, point, copies = self._search(view, points, sizes, scoring, seed, features, parallelism)
                if best is None or score > best[0]:
                    best = (score, point, fourier, copies)
            score, params, fourier, copies = best
            return _fit_one(
                self.name, params, data, seed, fourier, rows, score=float(score), fold_models=copies
            )
        finally:
            data.unpersist()

    def _groups(self, data, points, seed):
        """Grid points that share a feature map are searched together."""
        groups: dict = {}
        for p in points:
            groups.setdefault(p.get("gamma") if p.get("kernel") == "rbf" else None, []).append(p)
        for gamma, members in groups.items():
            if gamma is None:
                yield None, members
            else:
                width = data.select(F.array_size(vector_to_array(FEATURES))).first()[0]
                value = kernel_scale(data, width) if gamma == "scale" else float(gamma)
                yield FourierMap(value, width, seed), members

    def _search(self, view, points, sizes, scoring, seed, features, parallelism):
        """Best mean fold score, its point, and that point's copy per fold.

        Folds and points are fitted side by side, each by a distributed job of its own. A point's
        copies are let go once a better point is known.
        """
        judge, rows, k = evaluator(scoring), sum(sizes.values()), max(sizes) + 1

        def attempt(task: tuple[int, int]):
            point, fold = task
            seen = rows - sizes.get(fold, 0)
            copy = self.estimator(points[point], seen, seed, features).fit(view.where(F.col(FOLD) != fold))
            return judge.evaluate(copy.transform(view.where(F.col(FOLD) == fold))), copy

        tasks, best = list(product(range(len(points)), range(k))), None
        # the target made for a session copies the thread properties once, so each task gets one of its own
        spark = view.sparkSession
        with ThreadPool(min(parallelism, len(tasks))) as pool:
            found = pool.imap(lambda call: call(), [inheritable_thread_target(spark)(partial(attempt, task)) for task in tasks])
            for point in points:
                folds = [next(found) for _ in range(k)]
                score = sum(s for s, _ in folds) / k
                if best is None or score > best[0]:
                    best = (score, point, tuple(copy for _, copy in folds))
        return best


@dataclass(frozen=True)
class _Grown:
    """What fits one point, in the manner of the library's estimators."""

    make: Callable[[DataFrame], object]

    def fit(self, df: DataFrame):
        return self.make(df)


OWN_MODELS = (trees.TreeModel, linear.LinearModel)


@dataclass(frozen=True)
class LinearClassifier(Classifier):
    """Linear families, and the kernel one through its maps: all points, maps and folds are fitted together."""

    def estimator(self, params: Mapping, rows: int, seed: int, features: str):
        return _Grown(lambda df: linear.fit(self.name, df, params, features))

    def fit(self, params, rows, seed, fourier, df):
        return linear.fit(self.name, df, params, FEATURES, fourier)

    def left_out(self, params, df, seed, fourier, groups, known={}):
        near = lambda _, g: [known[i] for i in g if i in known] or list(known.values())
        _, found = linear.search(self.name, df, [params], groups, FEATURES, [fourier], near)
        return {g: found[0, g] for g in groups}

    def train(self, df, scoring="f1_weighted", seed=42, grid=None, parallelism=8, shared=None) -> TrainedModel:
        evaluator(scoring)
        own = shared or SharedRows(df)
        try:
            data, sizes = own.data(), own.sizes()
            asked = [(p, fourier) for fourier, members in self._groups(data, self.points(grid), seed) for p in members]
            points, maps = [p for p, _ in asked], [m for _, m in asked]
            # the fits over all rows run beside the others: alone, the best one would need as many rounds again
            counts, found = linear.search(self.name, data, points, [*sorted(sizes), -1], FEATURES, maps)
            best, score = best_point({i: [held_out_score(counts[i, f], scoring) for f in sorted(sizes)] for i in range(len(points))})
            copies = [found[best, f] for f in sorted(sizes)]
            return _fit_one(
                self.name, points[best], data, seed, maps[best], sum(sizes.values()), score=float(score), fold_models=copies, model=found[best, -1])
        finally:
            if shared is None:
                own.release()


@dataclass(frozen=True)
class TreeClassifier(Classifier):
    """Families of trees: points that can be read off one growth share it, and all growths of all folds are fitted together.

    Bins are cut once, over all rows of a search; no label takes part in that.
    """

    def estimator(self, params: Mapping, rows: int, seed: int, features: str):
        return _Grown(lambda df: trees.grow(self.name, df, params, seed, features))

    def train(self, df, scoring="f1_weighted", seed=42, grid=None, parallelism=8, shared=None) -> TrainedModel:
        evaluator(scoring)
        own, points = shared or SharedRows(df), list(self.points(grid))
        try:
            data, sizes = own.data(), own.sizes()
            counts, model = trees.search(self.name, data, points, [*sorted(sizes), -1], seed, binned=own.binned())
            scores = {i: [held_out_score(counts[i, f], scoring) for f in sorted(sizes)] for i in range(len(points))}
            best, score = best_point(scores)
            copies = [model(best, f) for f in sorted(sizes)]
            return _fit_one(
                self.name, points[best], data, seed, None, sum(sizes.values()), score=float(score), fold_models=copies, model=model(best, -1))
        finally:
            if shared is None:
                own.release()


REGISTRY = {name: TreeClassifier if name in trees.GROWN else LinearClassifier for name in FULL_GRIDS}

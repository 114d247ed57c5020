"""Trees, forests and boosted trees against plain recursive versions; both ways of running fits; the thread properties of a search."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabloom.operators import fitting, trees
from tabloom.operators.models import FULL_GRIDS, TrainedModel, train


def cells(n=300, seed=1):
    rng = np.random.default_rng(seed)
    x = np.c_[np.round(rng.normal(size=n), 1), rng.integers(0, 5, n), rng.integers(0, 2, n), np.round(rng.normal(size=n), 1)]
    y = ((x[:, 0] + 0.4 * x[:, 1] - 0.8 * x[:, 2] + rng.normal(0, 0.6, n)) > 0.3).astype(float)
    return x, y, rng.integers(0, 3, n)


@pytest.fixture(scope="module")
def data(spark):
    x, y, fold = cells()
    rows = [(i, [float(v) for v in r], float(t), int(f)) for i, (r, t, f) in enumerate(zip(x, y, fold))]
    df = spark.createDataFrame(rows, "id long, v array<double>, label double, fold int").repartition(3)
    return df.select("id", array_to_vector("v").alias("features"), "label", "fold").persist()


def middle_cuts(x):
    return [(np.unique(c)[1:] + np.unique(c)[:-1]) / 2 for c in x.T]


# plain versions: recursion over rows, every cut tried in order

def plain_tree(x, y, cuts, criterion, max_depth, min_split, min_leaf, depth=0):
    n, ones = len(y), y.sum()
    if n < min_split or ones in (0, n) or (max_depth is not None and depth >= max_depth):
        return ones / n

    def impurity(part):
        p = part.mean()
        if criterion == "gini":
            return len(part) * 2 * p * (1 - p)
        return len(part) * sum(-q * math.log2(q) for q in (p, 1 - p) if q > 0)

    best = None
    for c, own in enumerate(cuts):
        for cut in own:
            left = x[:, c] <= cut
            if min(left.sum(), (~left).sum()) < max(1, min_leaf):
                continue
            value = impurity(y[left]) + impurity(y[~left])
            if best is None or value < best[0] - 1e-9:
                best = (value, c, cut)
    if best is None:
        return ones / n
    left = x[:, best[1]] <= best[2]
    rest = (cuts, criterion, max_depth, min_split, min_leaf, depth + 1)
    return best[1], best[2], plain_tree(x[left], y[left], *rest), plain_tree(x[~left], y[~left], *rest)


def plain_boost(x, y, cuts, rounds, max_depth, rate, min_child):
    share = y.mean()
    margin, grown = np.full(len(y), math.log(share / (1 - share))), []

    def grow(at, g, h, depth):
        leaf = -rate * g[at].sum() / (h[at].sum() + 1)
        if depth == max_depth:
            return leaf
        score = lambda rows: g[rows].sum() ** 2 / (h[rows].sum() + 1)
        best = None
        for c, own in enumerate(cuts):
            for cut in own:
                left, right = at[x[at, c] <= cut], at[x[at, c] > cut]
                if min(h[left].sum(), h[right].sum()) < min_child:
                    continue
                gain = score(left) + score(right) - score(at)
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, c, cut, left, right)
        if best is None:
            return leaf
        return best[1], best[2], grow(best[3], g, h, depth + 1), grow(best[4], g, h, depth + 1)

    start = margin[0]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        grown.append(grow(np.arange(len(y)), p - y, p * (1 - p), 0))
        margin = margin + said(grown[-1], x)
    return start, grown


def said(tree, x):
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    return np.where(x[:, tree[0]] <= tree[1], said(tree[2], x), said(tree[3], x))


def shares(model, df):
    return np.array([r["p"] for r in TrainedModel("decision_tree", model, {}, 0.0, 0).score(df, "").orderBy("id").select(F.col("probability").alias("p")).collect()])


# ---- equal to the plain versions ------------------------------------------------

@pytest.mark.parametrize("point", [
    {}, {"max_depth": 3}, {"criterion": "entropy", "min_samples_leaf": 4}, {"min_samples_split": 10, "max_depth": 5},
    {"criterion": "entropy", "min_samples_split": 5, "min_samples_leaf": 2, "max_depth": 10},
])
def test_a_tree_equals_the_plain_one(data, point):
    x, y, _ = cells()
    want = plain_tree(x, y, middle_cuts(x), point.get("criterion", "gini"), point.get("max_depth"), point.get("min_samples_split", 2),
                      point.get("min_samples_leaf", 1))
    assert np.allclose(shares(trees.grow("decision_tree", data, point, 1), data), said(want, x))


@pytest.mark.parametrize("point", [
    {"n_estimators": 1, "max_depth": 2, "learning_rate": 1.0}, {"n_estimators": 12, "max_depth": 3, "learning_rate": 0.3, "min_child_weight": 3},
])
def test_boosting_equals_the_plain_one(data, point):
    x, y, _ = cells()
    start, grown = plain_boost(x, y, middle_cuts(x), point["n_estimators"], point["max_depth"], point["learning_rate"], point.get("min_child_weight", 1))
    want = 1 / (1 + np.exp(-(start + sum(said(t, x) for t in grown))))
    assert np.allclose(shares(trees.grow("xgboost", data, point, 1), data), want)


def test_points_read_off_a_larger_growth_equal_their_own(data):
    """Every point of a search, fold by fold, against a model grown for it alone."""
    for name, points in {
        "decision_tree": [{"max_depth": d, "min_samples_split": s, "criterion": "gini", "min_samples_leaf": 2} for d in (None, 2, 6) for s in (2, 9)],
        "random_forest": [{"n_estimators": n, "max_depth": d, "min_samples_split": s, "max_features": "sqrt"} for n in (3, 7) for d in (2, 5) for s in (2, 5)],
        "xgboost": [{"n_estimators": n, "max_depth": 2, "learning_rate": 0.2, "subsample": 0.8, "min_child_weight": 1} for n in (4, 9)],
    }.items():
        counts, model = trees.search(name, data, points, [0, 1, 2], 5)
        for i, p in enumerate(points):
            held = data.where("fold = 1")
            scored = shares(model(i, 1), held)
            y = np.array([r["label"] for r in held.orderBy("id").select("label").collect()])
            assert np.array_equal(counts[i, 1], fitting.held_out_counts(y, scored)), (name, p)
        alone = trees._fit(name, [points[0]], 1, trees.bin_layout(data), 5, 0)
        grown, _ = fitting.fit_together(trees.binned_table(data, trees.bin_layout(data)), [alone], "uint16")[0]
        assert np.allclose(shares(trees._model(name, points[0], grown, trees.bin_layout(data), "features"), data), shares(model(0, 1), data))


@pytest.mark.parametrize("name,points", [
    ("decision_tree", [{"max_depth": 4}, {"max_depth": 2}]), ("random_forest", [{"n_estimators": 4, "max_depth": 3, "max_features": "log2"}]),
    ("xgboost", [{"n_estimators": n, "max_depth": 2, "learning_rate": 0.3, "subsample": 0.7} for n in (3, 8)]),
])
def test_rows_that_stay_give_what_a_broadcast_table_gives(data, monkeypatch, name, points):
    near, near_model = trees.search(name, data, points, [0, 2], 7)
    monkeypatch.setattr(fitting, "SMALL_BYTES", -1)
    monkeypatch.setattr(fitting, "KEPT_ROUNDS", 3)
    # ids follow partitions, so bootstrap and subsample see the same rows in both
    far, far_model = trees.search(name, data, points, [0, 2], 7)
    assert near.keys() == far.keys() and all(np.array_equal(near[k], far[k]) for k in near)
    assert np.allclose(shares(near_model(0, 2), data), shares(far_model(0, 2), data))


def test_quantile_cuts_and_odd_tables(spark):
    many = spark.range(5_000).select(array_to_vector(F.array(F.col("id").cast("double"), F.lit(1.0))).alias("features"), (F.col("id") >= 2_500).cast("double").alias("label"))
    layout = trees.bin_layout(many)
    assert len(layout.cuts[0]) == trees.BINS - 1 and len(layout.cuts[1]) == 0
    model = trees.grow("decision_tree", many, {"max_depth": 1}, 1)
    assert abs(model.trees[0].column[0]) == 0 and len(model.trees[0].column) == 3
    same = many.select("features", F.lit(1.0).alias("label"))
    for name in trees.GROWN:
        p = trees.grow(name, same, {"n_estimators": 3}, 1).shares(np.array([[3.0, 1.0]]))
        assert p[0] > 0.99


def test_full_search_and_reload(data, tmp_path):
    assert [len(FULL_GRIDS[n]) for n in ("decision_tree", "random_forest", "xgboost")] == [90, 16, 32]
    for name, grid in (("decision_tree", None), ("random_forest", [{"n_estimators": 9, "max_depth": 5}]), ("xgboost", [{"n_estimators": 9}])):
        model = train(name, data, grid=grid)
        assert model.best_score > 0.6 and len(model.fold_models) == 3
        model.save(str(tmp_path / name))
        again = TrainedModel.load(str(tmp_path / name))
        assert np.allclose(shares(again.model, data), shares(model.model, data))
        # copies of the search have bins of all rows, fresh ones of the rows they see
        kept, fresh = (model.out_of_fold(data, reuse=r).orderBy("id").toPandas() for r in (True, False))
        assert (kept["prediction"] == fresh["prediction"]).mean() > 0.9


def test_scores_of_counts_equal_those_of_rows(spark):
    from tabloom.operators.models import evaluator

    rng = np.random.default_rng(3)
    y, p = rng.integers(0, 2, 200).astype(float), rng.random(200)
    df = spark.createDataFrame([(float(a), float(b), float(b > 0.5), float(b)) for a, b in zip(y, p)], "label double, probability double, prediction double, rawPrediction double")
    counts = fitting.held_out_counts(y, p)
    ranked, df = df, df.drop("probability", "rawPrediction")
    for scoring in ("accuracy", "f1", "f1_weighted", "precision", "recall", "balanced_accuracy", "f1_macro", "f1_micro", "precision_macro", "recall_weighted"):
        assert fitting.held_out_score(counts, scoring) == pytest.approx(evaluator(scoring).evaluate(df)), scoring
    assert fitting.held_out_score(counts, "roc_auc") == pytest.approx(evaluator("roc_auc").evaluate(ranked), abs=2e-3)


def test_each_task_of_a_search_has_properties_of_its_own(spark, data, monkeypatch):
    """A search's threads must not share the Java object that holds their Spark properties."""
    from tabloom.operators import models

    seen = []

    class Recorder:
        def fit(self, df):
            own = spark.sparkContext._jsc.sc().getLocalProperties()
            seen.append(spark.sparkContext._jvm.System.identityHashCode(own))
            return self

        def transform(self, df):
            return df

    class Judge:
        def evaluate(self, df):
            return 0.5

    monkeypatch.setattr(models, "evaluator", lambda scoring: Judge())
    monkeypatch.setattr(models.Classifier, "estimator", lambda self, *a: Recorder())
    models.Classifier("svm")._search(data, [{}, {}, {}], {0: 100, 1: 100, 2: 100}, "f1", 1, "features", 3)
    assert len(seen) == 9 and len(set(seen)) == 9


def test_a_forest_keeps_a_few_trees_and_small_sums_at_a_time(monkeypatch):
    x, y, fold = cells(600)
    layout = trees.Layout(tuple(middle_cuts(x)))
    rows = fitting.Rows(np.arange(len(y)), layout.binned(x), y, fold)
    whole = fitting.alone(trees.ClassTrees(0, 1, layout, [{"n_estimators": 20}], trees=20, bootstrap=True), rows)
    monkeypatch.setattr(trees, "ROUND_BYTES", 10 * 24 * layout.size)
    fit = trees.ClassTrees(0, 1, layout, [{"n_estimators": 20}], trees=20, bootstrap=True)
    rows = fitting.Rows(np.arange(len(y)), layout.binned(x), y, fold)
    steps = fit.run()
    state = next(steps)
    with pytest.raises(StopIteration) as end:
        while True:
            sums = fit.sums(rows, state)
            assert state[0] == "score" or sums.nbytes <= trees.ROUND_BYTES
            assert sum(v.nbytes for k, held in rows.kept.items() for v in (held if isinstance(held, (list, tuple)) else [held])) <= (trees.OPEN_TREES + 1) * 4 * 8 * len(y)
            state = steps.send(sums)
    assert np.array_equal(end.value.value[1], whole[1])


def test_sums_run_over_shapes_of_rows(monkeypatch):
    """Ten copies of each row take as many steps as one."""
    x, y, fold = cells(60)
    layout = trees.Layout(tuple(middle_cuts(x)))
    held, original = [], trees._histogram
    monkeypatch.setattr(trees, "_histogram", lambda b, *a: held.append(len(b)) or original(b, *a))
    for copies in (1, 10):
        rows = fitting.Rows(np.arange(60 * copies), np.tile(layout.binned(x), (copies, 1)), np.tile(y, copies), np.tile(fold, copies))
        fitting.alone(trees.Boosted(0, 1, layout, [{"n_estimators": 3}], subsample=0.8), rows)
    assert max(held) <= 60


def test_column_choices_of_as_many_columns_share_a_forest():
    from tabloom.operators.models import FULL_GRIDS

    points = FULL_GRIDS["random_forest"]
    assert [len(trees._growths("random_forest", points, width)) for width in (6, 7, 30, 64)] == [1, 1, 2, 2]
    assert len(trees._growths("xgboost", FULL_GRIDS["xgboost"], 6)) == 16


def test_rows_numbers_may_be_arrays():
    from tabloom.operators.fitting import uniform

    numbers = np.array([1, 5, 2**60])
    assert np.array_equal(uniform(np.arange(6), 42, numbers[:, None]), np.stack([uniform(np.arange(6), 42, int(n)) for n in numbers]))


def test_boosting_sums_up_the_smaller_side_of_a_split(monkeypatch):
    """a level takes at most half of the rows that are split, the other half's sums are what is left."""
    x, y, fold = cells(600)
    layout = trees.Layout(tuple(middle_cuts(x)))
    held, original = [], trees._histogram
    monkeypatch.setattr(trees, "_histogram", lambda b, at, *a: held.append(len(at)) or original(b, at, *a))
    fitting.alone(trees.Boosted(0, 1, layout, [{"n_estimators": 3}], max_depth=5), fitting.Rows(np.arange(len(y)), layout.binned(x), y, fold))
    seen = len(np.unique(layout.binned(x)[fold != 1], axis=0))
    assert len(held) == 15 and sum(held) <= 3 * (seen + 4 * seen / 2)


def test_boosting_sums_are_exact_however_rows_are_parted():
    """the same trees to the last bit whether rows are summed up at once or in parts."""
    x, y, fold = cells(600)
    layout = trees.Layout(tuple(middle_cuts(x)))

    def grown(parts):
        fit = trees.Boosted(0, 1, layout, [{"n_estimators": 20}], max_depth=4, subsample=0.8)
        rows = [fitting.Rows(np.arange(len(y))[p], layout.binned(x)[p], y[p], fold[p]) for p in parts]
        steps = fit.run()
        state = next(steps)
        try:
            while True:
                state = steps.send(sum(fit.sums(r, state) for r in rows))
        except StopIteration as end:
            return end.value[0][1]

    whole, parted = grown([slice(None)]), grown([slice(0, 250), slice(250, 270), slice(270, None)])
    for a, b in zip(whole, parted):
        assert all(np.array_equal(getattr(a, k), getattr(b, k)) for k in ("column", "bin", "left", "value"))


def test_joined_columns_have_their_own_sums():
    rng = np.random.default_rng(3)
    layout = trees.Layout(tuple(np.arange(w - 1) + 0.5 for w in (2, 3, 2, 90, 2, 40)))
    assert layout.joined == [[0, 1, 2], [3], [4], [5]]
    x = np.stack([rng.integers(0, w, 200) for w in layout.widths], 1).astype(np.uint16)
    rows = fitting.Rows(np.arange(200), x, np.zeros(200), np.zeros(200, int))
    shapes, _ = trees._shapes(rows)
    n, place = rng.integers(0, 5, len(shapes)).astype(float), rng.integers(0, 3, len(shapes))
    found = trees._histogram(trees._codes(rows, layout), np.arange(len(shapes)), place, 3, layout, (n,))[0]
    for c, begin in enumerate(layout.begin):
        for node in range(3):
            own = place == node
            assert np.array_equal(found[node, begin : begin + layout.widths[c]], np.bincount(shapes[own, c], n[own], layout.widths[c]))


def test_fits_are_dealt_to_few_tasks_long_ones_first():
    """short fits share tasks, so a task's own cost isn't paid for each."""
    costs = [float(c) for c in np.random.default_rng(1).integers(1, 6, 162)]
    groups = fitting.dealt(costs, 48)
    sums = [sum(costs[i] for i in g) for g in groups]
    assert sorted(i for g in groups for i in g) == list(range(162)) and len(groups) == 48
    assert sums == sorted(sums, reverse=True) and max(sums) <= sum(costs) / 48 + max(costs)
    assert fitting.dealt([1.0, 3.0], 48) == [[1], [0]]


def test_families_of_one_variant_bin_its_rows_once(spark, monkeypatch):
    """a workflow's families of trees share the bins of the rows that they all read."""
    from tabloom.plans.workflow import fit_workflow

    found, original = [], trees.bin_layout
    monkeypatch.setattr(trees, "bin_layout", lambda *a, **k: found.append(1) or original(*a, **k))
    x, y, _ = cells(120)
    rows = spark.createDataFrame([(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))], "id long, a double, b double, c double, d double, y int")
    spec = {"loader": {"target_col": "y", "id_col": "id"}, "models": {"active": ["decision_tree", "random_forest", "xgboost"], "cv": 3, "grid": "short"}}
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    assert len(fit_workflow(spec, rows).entries) == 3 and len(found) == 1
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before

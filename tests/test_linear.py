"""Linear fits by their conditions of optimality, by both solvers and both ways of running them."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabloom.operators import fitting, linear
from tabloom.operators.models import FULL_GRIDS, FoldCopies, FourierMap, TrainedModel, train


def cells(n=200):
    rng = np.random.default_rng(2)
    x = np.c_[rng.normal(size=(n, 3)), rng.integers(0, 2, n)].astype(float)
    y = (x @ [1.5, -1, 0, 0.5] + rng.normal(0, 0.8, n) > 0.2).astype(float)
    return x, y, rng.integers(0, 3, n)


@pytest.fixture(scope="module")
def data(spark):
    rows = [(i, [float(v) for v in r], float(t), int(f)) for i, (r, t, f) in enumerate(zip(*cells()))]
    df = spark.createDataFrame(rows, "id long, v array<double>, label double, fold int").repartition(3)
    return df.select("id", array_to_vector("v").alias("features"), "label", "fold").persist()


def numbers(model):
    return np.r_[model.coefficients, model.intercept]


@pytest.mark.parametrize("second", [True, False])
@pytest.mark.parametrize("point", FULL_GRIDS["logreg"][::4] + [{"C": 1e-9}])
def test_logistic_optimum(data, monkeypatch, point, second):
    """Zero gradient where coefficients differ from 0, a gradient within the corner's range elsewhere."""
    x, y, fold = cells()
    fit = linear.LinearFit(0, 1, 4, point, False, second)
    w, _ = fitting.alone(fit, fitting.Rows(np.arange(len(y)), x, y, fold))
    seen = fold != 1
    p = 1 / (1 + np.exp(-(x[seen] @ w[:-1] + w[-1])))
    slope = point["C"] * np.r_[x[seen].T @ (p - y[seen]), (p - y[seen]).sum()]
    ratio = point.get("l1_ratio", 0.0)
    smooth = slope[:-1] + (1 - ratio) * w[:-1]
    near = 2e-4 * (1 + point["C"]) * (1 if second else 20)
    assert abs(slope[-1]) < near
    for s, c in zip(smooth, w[:-1]):
        assert abs(s + ratio * np.sign(c)) < near if c else abs(s) <= ratio + near


@pytest.mark.parametrize("c", [0.1, 1, 10])
def test_support_vectors_near_the_hinge_optimum(c):
    x, y, fold = cells()
    w, _ = fitting.alone(linear.LinearFit(0, -1, 4, {"C": c}, True), fitting.Rows(np.arange(len(y)), x, y, fold))
    sign, rng = 2 * y - 1, np.random.default_rng(1)

    def target(v):
        return c * np.maximum(0, 1 - sign * (x @ v[:-1] + v[-1])).sum() + (v[:-1] ** 2).sum() / 2

    for size in (1e-3, 1e-2, 0.1, 1.0):
        assert all(target(w) <= target(w + size * rng.normal(size=5)) + 0.005 * c * len(y) / 10 for _ in range(50))


@pytest.mark.parametrize("name", ["logreg", "svm"])
def test_both_ways_of_running_agree(data, monkeypatch, name):
    points = [{"C": 0.5, "l1_ratio": 0.5, "max_iter": 2}, {"C": 2.0, "max_iter": 2}]
    near, found = linear.search(name, data, points, [0, 1])
    monkeypatch.setattr(fitting, "SMALL_BYTES", -1)
    far, again = linear.search(name, data, points, [0, 1])
    assert all(np.array_equal(near[k], far[k]) for k in near)
    assert all(np.allclose(numbers(found[k]), numbers(again[k]), atol=1e-5) for k in found)


@pytest.mark.parametrize("name", ["logreg", "svm"])
def test_full_search_and_reload(data, tmp_path, name):
    model = train(name, data)
    assert model.best_score > 0.7 and len(model.fold_models) == 3
    model.save(str(tmp_path / name))
    again = TrainedModel.load(str(tmp_path / name))
    a, b = (m.score(data).orderBy("id").select("probability", "prediction").toPandas() for m in (model, again))
    assert np.allclose(a, b) and a["probability"].between(0, 1).all()
    kept, fresh = (model.out_of_fold(data, reuse=r).orderBy("id").toPandas()["probability"] for r in (True, False))
    assert np.allclose(kept, fresh, atol=1e-5)


def test_jobs_do_not_grow_with_points_and_folds(spark, data):
    def jobs(points, folds):
        group = f"count-{points}-{len(folds)}"
        spark.sparkContext.setJobGroup(group, group)
        linear.search("logreg", data, [{"C": 1.0 + i} for i in range(points)], folds)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(1, [0]) == jobs(6, [0, 1, 2]) > 0


def test_support_vectors_end_in_few_rounds():
    x, y, fold = cells(2000)
    rows = fitting.Rows(np.arange(len(y)), x, y, fold)
    for c in (0.1, 10, 100):
        fit, rounds = linear.LinearFit(0, 1, 4, {"C": c}, True), 0
        steps = fit.run()
        state = next(steps)
        with pytest.raises(StopIteration):
            while True:
                rounds, state = rounds + 1, steps.send(fit.sums(rows, state))
        assert rounds < 90


def test_mapped_rows_give_what_mapped_cells_give_and_only_cells_are_stored(data, monkeypatch):
    how, point, widths = FourierMap(0.3, 4, 7, 16), {"C": 1.0, "max_iter": 2}, []
    plain = linear.search("svm", how.transform(data, "__z"), [point], [0, 1], "__z")[1]
    original = linear.fit_together

    def seen(table, fits, kind, width=0):
        widths.append((table.selectExpr("max(length(x))").first()[0], width))
        return original(table, fits, kind, width)

    monkeypatch.setattr(linear, "fit_together", seen)
    near = linear.search("svm", data, [point], [0, 1], maps=[how])[1]
    monkeypatch.setattr(fitting, "SMALL_BYTES", -1)
    far = linear.search("svm", data, [point], [0, 1], maps=[how])[1]
    assert widths == [(4 * 8, 16 * 8)] * 2
    assert all(np.allclose(numbers(plain[k]), numbers(m[k]), atol=1e-5) for m in (near, far) for k in plain)


def test_copies_of_all_folds_are_calibrated_in_one_run(data, monkeypatch):
    model = train("svm", data, grid=[{"kernel": "rbf", "C": 1, "gamma": 0.2}])
    runs, original = [], linear.search
    monkeypatch.setattr(linear, "search", lambda *a, **k: runs.append(a[3]) or original(*a, **k))
    model.fold_copies(data, reuse=True)
    assert runs == [[(0, 1), (0, 2), (1, 2)]]


def steps_of(fit, rows):
    steps, rounds = fit.run(), 0
    state = next(steps)
    while True:
        try:
            rounds, state = rounds + 1, steps.send(fit.sums(rows, state))
        except StopIteration as end:
            return end.value[0], rounds


def test_a_start_near_the_minimum_saves_rounds_and_gives_the_same():
    x, y, fold = cells(2000)
    rows, how = fitting.Rows(np.arange(len(y)), x, y, fold), FourierMap(0.3, 4, 7, 64)
    make = lambda out, **more: linear.LinearFit(0, out, 64, {"C": 10}, True, True, how, **more)
    near, _ = steps_of(make(0), rows)
    cold, many = steps_of(make(1), rows)
    warm, few = steps_of(make(1, start=near), rows)
    assert few < many < 60
    assert np.allclose(how.cells(x) @ (cold - warm)[:-1], (warm - cold)[-1], atol=1e-3)


def test_large_tables_start_at_the_minimum_over_some_rows_and_end_at_that_of_all(data, monkeypatch):
    points, folds = [{"C": 1.0}, {"C": 5.0}], [0, 1, -1]
    how = [FourierMap(0.3, 4, 7, 16), None]
    near = linear.search("svm", data, points, folds, maps=how)[1]
    runs, original = [], linear.fit_together
    monkeypatch.setattr(linear, "fit_together", lambda table, fits, *rest: runs.append([f.start is not None for f in fits]) or original(table, fits, *rest))
    monkeypatch.setattr(fitting, "SMALL_BYTES", 16_000)
    far = linear.search("svm", data, points, folds, maps=how)[1]
    assert runs == [[False] * 2, [True] * 6]
    assert all(np.allclose(numbers(near[k]), numbers(far[k]), atol=1e-3) for k in near)


def test_sums_of_many_fits_are_those_of_each(data):
    x, y, fold = cells(500)
    rng = np.random.default_rng(4)
    maps = (None, FourierMap(0.3, 4, 7, 16), None, FourierMap(0.3, 4, 7, 16))
    fits = [linear.LinearFit(i, i % 3, how.size if how else 4, {"C": 1.0}, i > 0, True, how) for i, how in enumerate(maps)]
    steps = [None if i == 2 else rng.normal(size=f.columns + 1) for i, f in enumerate(fits)]
    asked = [(f, ("sums", rng.normal(size=f.columns + 1), s, 0.1 if f.hinge else None, False)) for f, s in zip(fits, steps)]
    asked.append((fits[1], ("score", rng.normal(size=17), None, None, False)))
    rows = fitting.Rows(np.arange(len(y)), x, y, fold)
    together = linear.LinearFit.all_sums(rows, asked)
    assert all(np.allclose(a, fit.sums(rows, state)) for a, (fit, state) in zip(together, asked))


def test_curves_over_margins_are_those_of_their_rows(data):
    """All curves in one run; each reads, row by row, the margins of the model that didn't see the row."""
    x, y, fold = cells()
    rng = np.random.default_rng(5)
    models = [linear.LinearModel(tuple(rng.normal(size=4)), 0.1 * i, False) for i in range(3)]
    plans = [((), dict(enumerate(models))), ((1,), {0: models[1], 2: models[0]})]
    for (out, known), curve in zip(plans, linear.calibrations(data, plans)):
        seen = np.isin(fold, list(known))
        margin = np.array([x[i] @ known[f].coefficients + known[f].intercept for i, f in enumerate(fold) if f in known])
        lack = 1 / (1 + np.exp(-(curve.coefficients[0] * margin + curve.intercept))) - y[seen]
        assert abs(lack.sum()) < 1e-3 and abs((lack * margin).sum()) < 1e-3


def test_copies_are_calibrated_together_without_jobs_of_each(spark, data):
    model = train("svm", data, grid=[{"kernel": "linear", "C": 1}])
    group = "copies-of-a-search"
    spark.sparkContext.setJobGroup(group, group)
    copies = model.fold_copies(data, reuse=True)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(copies) == 3 and all(isinstance(c.platt, linear.LinearModel) for c in copies)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) < 25


def test_steps_with_corners_meet_their_conditions():
    """Columns that nearly repeat each other keep coordinates moving for long; the step is still the minimum."""
    rng = np.random.default_rng(6)
    for _ in range(20):
        x = rng.normal(size=(50, 3))
        x = np.c_[x, x[:, 0] + 1e-3 * rng.normal(size=50), np.ones(50)]
        a, b, w, corner = x.T @ x, 5 * rng.normal(size=5), rng.normal(size=5) * [1, 0, 1, 1, 1], 3.0
        step = linear._descent(a, b, w, corner)
        slope, end = a @ step + b, (w + step)[:-1]
        assert abs(slope[-1]) < 1e-6
        for s, v in zip(slope[:-1], end):
            assert abs(s + corner * np.sign(v)) < 1e-6 if v else abs(s) <= corner + 1e-6


def test_rows_are_scored_by_the_copy_of_their_fold_in_one_pass(spark, data):
    for name, grid in (("svm", [{"kernel": "rbf", "C": 1, "gamma": 0.2}]), ("logreg", "short"), ("decision_tree", "short")):
        copies = train(name, data, grid=grid).fold_copies(data, reuse=True)
        found = FoldCopies(tuple(copies)).score(data, "a_").orderBy("id").toPandas()
        plain = [c.score(data.where(F.col("fold") == i), "a_") for i, c in enumerate(copies)]
        plain = plain[0].union(plain[1]).union(plain[2]).orderBy("id").toPandas()
        assert list(found.columns) == list(plain.columns)
        assert np.allclose(found["a_probability"], plain["a_probability"]) and (found["a_prediction"] == plain["a_prediction"]).all()

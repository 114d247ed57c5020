"""Splits, folds, scores, voting, models and the whole workflow."""

import inspect

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import evaluate as ev
from tabloom.operators.ensemble import hard_vote, member_weights, soft_vote
from tabloom.operators.models import FULL_GRIDS, TrainedModel, assemble, train
from tabloom.operators import split
from tabloom.operators.split import Splitter, add_folds, fold_sizes, share_out
from tabloom.plans import queries
from tabloom.plans.workflow import check_spec, fit_workflow, variants_of
from tabloom.sources import store


def test_sizes_by_hand():
    # sorted labels 0 x 5, 1 x 7 dealt to three folds
    assert fold_sizes([5, 7], 3) == [[2, 2, 1], [2, 2, 3]]
    assert share_out([10, 20, 3], 26) == [8, 16, 2]
    with pytest.raises(ValueError):
        fold_sizes([2, 2], 3)


def test_split_is_exact_and_stable(spark):
    df = spark.range(1, 51).select("id", (F.col("id") % 2).alias("y"))
    train_part, test_part = Splitter(0.2).split(df, "id", "y")
    assert train_part.count() == 40
    assert sorted(r["count"] for r in test_part.groupBy("y").count().collect()) == [5, 5]
    again = {r["id"] for r in Splitter(0.2).split(df.repartition(7), "id", "y")[1].collect()}
    assert again == {r["id"] for r in test_part.collect()}
    assert Splitter(0.3, stratify=False).split(df, "id")[1].count() == 15
    with pytest.raises(ValueError):
        Splitter().fit(df.withColumn("y", (F.col("id") == 1).cast("int")), "id", "y")


def test_folds_are_blocks_in_id_order_and_cover_skewed_classes(spark):
    df = spark.range(101).select("id", F.when(F.col("id") % 10 == 0, "rare").otherwise("hot").alias("y"))
    out = add_folds(df, "y", "id", 4).groupBy("y", "fold").agg(
        F.count("*").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi")
    ).orderBy("y", "fold").collect()
    for y in ("hot", "rare"):
        rows = [r for r in out if r["y"] == y]
        assert [r["fold"] for r in rows] == [0, 1, 2, 3]
        assert all(a["hi"] < b["lo"] for a, b in zip(rows, rows[1:]))
    # classes in order of appearance: rare (id 0) first
    assert [r["n"] for r in out if r["y"] == "rare"] == fold_sizes([11, 90], 4)[0]
    shuffled = add_folds(df, "y", "id", 4, shuffle=True)
    assert sorted(r["count"] for r in shuffled.where("y = 'rare'").groupBy("fold").count().collect()) == [2, 3, 3, 3]


def test_folds_with_ids_beyond_double_precision(spark):
    big = 2**60
    df = spark.range(40).select((F.col("id") + big).alias("id"), (F.col("id") % 2).alias("y"))
    sizes = add_folds(df, "y", "id", 4).groupBy("y", "fold").count().collect()
    assert all(r["count"] == 5 for r in sizes) and len(sizes) == 8


def parts_by_hand(rows, k):
    """Fold sizes of classes by smallest id, then name, dealt in id order: (y, id) -> folds."""
    ids = {}
    for i, y in rows:
        ids.setdefault(y, []).append(i)
    classes = sorted(ids, key=lambda y: (min(ids[y]), str(y)))
    out = {}
    for y, sizes in zip(classes, fold_sizes([len(ids[y]) for y in classes], k)):
        folds = [f for f, n in enumerate(sizes) for _ in range(n)]
        for i, f in zip(sorted(ids[y]), folds):
            out.setdefault((y, i), []).append(f)
    return out


def held_parts(frame):
    out = {}
    for r in frame.collect():
        out.setdefault((r["y"], r["id"]), []).append(r["fold"])
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("sent_bytes", [8 << 20, 0])
def test_folds_and_splits_of_5000_classes(spark, monkeypatch, sent_bytes):
    monkeypatch.setattr(split, "MAX_SENT_BYTES", sent_bytes)
    df = spark.range(40_000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5_000).alias("y"))
    got = held_parts(add_folds(df.repartition(5), "y", "id", 4))
    assert got == parts_by_hand([(r["id"], r["y"]) for r in df.collect()], 4)
    test_part = Splitter(0.25).split(df, "id", "y")[1]
    assert test_part.count() == 10_000
    off = test_part.groupBy("y").count().withColumnRenamed("count", "t").join(df.groupBy("y").count(), "y", "right")
    assert off.where("abs(coalesce(t, 0) - count / 4) >= 1").count() == 0


@pytest.mark.parametrize("classes", [3, 300])
def test_text_ids_and_repeated_ids_are_dealt_exactly(spark, classes):
    df = spark.range(6_000).select(
        F.concat(F.lit("k"), F.lpad((F.col("id") * 7919 % 6_000).cast("string"), 5, "0")).alias("id"), (F.col("id") % classes).alias("y"))
    rows = [(r["id"], r["y"]) for r in df.collect()]
    assert held_parts(add_folds(df, "y", "id", 3)) == parts_by_hand(rows, 3)
    repeated = spark.range(6_000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 900).alias("id"), (F.col("id") % classes).alias("y"), F.col("id").alias("x"))
    rows = [(r["id"], r["y"]) for r in repeated.collect()]
    assert held_parts(add_folds(repeated, "y", "id", 3)) == parts_by_hand(rows, 3)
    marked = Splitter(0.2).assign(repeated, "id", "y")
    assert marked.where("is_test = 1").count() == 1_200
    again = Splitter(0.2).assign(repeated.repartition(7, "x"), "id", "y")
    assert marked.where("is_test = 1").select("x").exceptAll(again.where("is_test = 1").select("x")).count() == 0


def test_equal_rows_and_missing_ids_keep_one_part(spark):
    df = spark.createDataFrame([(1, "a")] * 7 + [(2, "a"), (None, "a"), (3, "a")], "id int, y string")
    got = held_parts(add_folds(df, "y", "id", 2))
    assert got == {("a", None): [0], ("a", 1): [0] * 7, ("a", 2): [1], ("a", 3): [1]}


def test_threshold_scan_golden(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.45), (0, 0.4), (0, 0.6), (1, 0.35)], "label int, probability double")
    scan = {r["threshold"]: r for r in ev.threshold_scan(df).collect()}
    assert len(scan) == 41
    assert (scan[0.5]["tp"], scan[0.5]["fp"], scan[0.5]["fn"], scan[0.5]["tn"]) == (1, 1, 2, 1)
    assert scan[0.3]["score"] == 0.75
    assert ev.best_threshold(ev.threshold_scan(df)) == (0.3, 0.75)


def test_reports(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (2, 0)], "label int, prediction int")
    rows = {r["class"]: r for r in ev.class_report(df).collect()}
    assert rows["1"]["precision"] == pytest.approx(2 / 3) and rows["1"]["recall"] == 1.0
    assert rows["2"]["precision"] == 0.0 and rows["2"]["support"] == 1
    assert rows["accuracy"]["f1"] == 0.6
    assert rows["macro avg"]["f1"] == pytest.approx((0.5 + 0.8 + 0) / 3)
    assert ev.metrics(df).first()["recall"] == pytest.approx(0.6)
    two = df.where("label < 2")
    assert ev.metrics(two).first()["precision"] == pytest.approx(2 / 3)
    folds = df.withColumn("fold", F.col("label") % 2)
    assert ev.fold_accuracy(folds).first()["folds"] == 2


def test_votes(spark):
    df = spark.createDataFrame([(0.6, 0.3, 1, 0), (0.9, 0.1, 0, 0)], "a double, b double, c int, d int")
    out = df.select(soft_vote({"a": 1, "b": 1}).alias("s"), hard_vote({"c": 1, "d": 1}).alias("h")).collect()
    assert [tuple(r) for r in out] == [(0, 1), (1, 0)]
    assert member_weights(["x", "y", "z"], {"x": 0.5, "z": 0.7}) == ({"x": 0.5, "z": 0.7}, ["y"])
    assert member_weights(["x"], {"x": 0.5}, {"q": 3})[0] == {"x": 1.0}


@pytest.fixture(scope="module")
def learnable(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(0, 0.3, 200) > 0).astype(int)
    rows = [(i, *map(float, r), "ab"[i % 2], int(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, f0 double, f1 double, f2 double, c string, y int").coalesce(2)


@pytest.fixture(scope="module")
def vectors(learnable):
    data = add_folds(learnable, "y", "id", 3).withColumn("label", F.col("y").cast("double"))
    return assemble(data, ["f0", "f1", "f2"], ["id", "label", "fold"]).persist()


@pytest.mark.parametrize("name,grid", [
    ("logreg", "short"), ("decision_tree", "short"), ("random_forest", "short"),
    ("svm", [{"kernel": "linear", "C": 1, "max_iter": 10}]),
    ("svm", [{"kernel": "rbf", "C": 10, "gamma": "scale", "max_iter": 10}]),
    ("xgboost", [{"n_estimators": 3, "max_depth": 3, "learning_rate": 0.3}]),
])
def test_models_beat_the_majority(vectors, name, grid):
    model = train(name, vectors, grid=grid)
    found = model.evaluate(vectors)
    assert set(found) == {"accuracy", "precision", "recall", "f1_score"}
    assert all(0 <= v <= 1 for v in found.values()) and found["accuracy"] > 0.65
    assert 0 <= model.best_score <= 1
    row = model.score(vectors).agg(F.min("probability"), F.max("probability"), F.count("*")).first()
    assert 0 <= row[0] <= row[1] <= 1 and row[2] == 200


def test_threshold_report_and_reload(vectors, tmp_path):
    model, scan = train("logreg", vectors, grid="short").tune_threshold(vectors, reuse=True)
    assert scan.count() == 41 and 0.3 <= model.threshold <= 0.7
    refitted, _ = model.tune_threshold(vectors)
    assert refitted.threshold == model.threshold  # kept fold copies equal fresh ones
    assert model.oof_report(vectors, reuse=True).where("class = 'accuracy'").first()["f1"] > 0.6
    model.save(str(tmp_path / "m"))
    again = TrainedModel.load(str(tmp_path / "m"))
    assert again.threshold == model.threshold
    a = model.score(vectors).orderBy("id").select("prediction").collect()
    assert a == again.score(vectors).orderBy("id").select("prediction").collect()
    with pytest.raises(ValueError):
        train("nope", vectors)
    assert [len(g) for g in FULL_GRIDS.values()] == [27, 90, 16, 32, 9]


@pytest.mark.parametrize("name,points", [
    ("logreg", [{"C": 0.01}]), ("logreg", [{"C": c} for c in (0.01, 1e-9)]),
    ("svm", [{"kernel": "linear", "C": 0.01, "max_iter": 3}]),
])
def test_kept_fold_copies_equal_fresh_ones(vectors, name, points):
    model = train(name, vectors, grid=points)
    assert model.best_params == points[0] and len(model.fold_models) == 3
    kept, fresh = model.fold_copies(vectors, reuse=True), model.fold_copies(vectors)
    for a, b in zip(kept, fresh):
        assert a.rows == b.rows < 200 and np.allclose(a.model.coefficients, b.model.coefficients)
        if a.platt is not None:  # calibrated on the rows the copy has seen
            assert np.allclose(a.platt.coefficients, b.platt.coefficients)
    if model.platt is not None:
        return
    a, b = (model.out_of_fold(vectors, reuse=r).orderBy("id").toPandas()["probability"] for r in (True, False))
    assert np.allclose(a, b)


def test_scores_of_a_search(spark):
    from tabloom.operators.models import evaluator

    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0), (1.0, 0.0), (1.0, 1.0)], "label double, prediction double")
    assert evaluator("balanced_accuracy").evaluate(df) == pytest.approx((0.5 + 0.75) / 2)
    assert evaluator("f1_macro").evaluate(df) == pytest.approx((0.5 + 0.75) / 2)
    assert evaluator("recall_micro").evaluate(df) == pytest.approx(4 / 6)
    assert evaluator("precision_weighted").evaluate(df) == pytest.approx((2 * 0.5 + 4 * 0.75) / 6)
    ranked = spark.createDataFrame([(0.0, 0.1), (0.0, 0.6), (1.0, 0.5), (1.0, 0.9)], "label double, rawPrediction double")
    assert evaluator("roc_auc").evaluate(ranked) == pytest.approx(0.75)
    with pytest.raises(ValueError):
        evaluator("nope")


def test_workflow(spark, learnable, tmp_path):
    spec = {
        "loader": {"target_col": "y", "id_col": "id"},
        "cleaner": {"num_strategy": "median", "cat_strategy": "unknown"},
        "outliers": {"detection": ["iqr", "zscore"], "apply_to": ["logreg"]},
        "multicollinearity": {"apply_to": ["logreg"]},
        "pca": {"n_components": 2, "apply_to": ["logreg"]},
        "models": {"active": ["logreg", "decision_tree"], "cv": 3, "tune_threshold": True,
                   "grids": {"logreg": [{"C": 1}], "decision_tree": [{"max_depth": 3}]}},
        "ensemble": {"enabled": True, "voting": "soft", "weights": {"logreg": 2}, "members": ["logreg", "decision_tree", "svm"]},
        "model_cache": {"enabled": True, "path": str(tmp_path / "models")},
    }
    assert [k for k, _, _ in variants_of(spec)] == ["logreg", "logreg_pca", "decision_tree"]
    kept_before = len(spark.sparkContext._jsc.getPersistentRDDs())
    fitted = fit_workflow(spec, learnable)
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == kept_before  # nothing stays cached
    board = fitted.leaderboard(spark).collect()
    assert {r["model"] for r in board} == {"logreg", "logreg_pca", "decision_tree", "ensemble"}
    assert [r["score"] for r in board] == sorted((r["score"] for r in board), reverse=True)
    assert fitted.vote.skipped == ["svm"] and fitted.vote.members == {"logreg": 2.0, "decision_tree": 1.0}
    paths = fitted.write_predictions(learnable.drop("y"), str(tmp_path / "out"))
    assert len(paths) == 3
    back = spark.read.csv(paths[0], header=True, inferSchema=True)
    assert back.columns == ["id", "y"] and back.count() == 200
    again = fit_workflow(spec, learnable)  # from the store, thresholds included
    for key, e in fitted.entries.items():
        assert again.entries[key].model.threshold == e.model.threshold
    with pytest.raises(ValueError):
        check_spec({"models": {"active": ["unknown"]}})


def test_digest_follows_settings_and_data(spark, tmp_path):
    folder = str(tmp_path / "t")
    spark.range(3).write.parquet(folder)
    a = store.config_hash({"models": {"cv": 5}, "loader": {"x": 1}}, folder)
    assert len(a) == 12 and a == store.config_hash({"models": {"cv": 5}, "loader": {"x": 1, "train_path": "elsewhere"}}, folder)
    assert a != store.config_hash({"models": {"cv": 5}, "loader": {"x": 2}}, folder)
    assert a != store.config_hash({"models": {"cv": 3}}, folder)
    held = [store.config_hash({}, data=spark.range(n)) for n in (3, 3, 4)]
    assert held[0] == held[1] != held[2]
    spark.range(9).write.mode("overwrite").parquet(folder)
    assert a != store.config_hash({"models": {"cv": 5}}, folder)


def test_registering_a_family(vectors, monkeypatch):
    from pyspark.ml.classification import NaiveBayes

    from tabloom.operators import models

    class Bayes(models.Classifier):
        def points(self, grid):
            return list(grid or [{"smoothing": 1.0}])

        def estimator(self, params, rows, seed, features):
            return NaiveBayes(featuresCol=features, labelCol="label", modelType="gaussian", **params)

    monkeypatch.setitem(models.REGISTRY, "bayes", Bayes)
    model = train("bayes", vectors)
    assert model.platt is None and model.evaluate(vectors)["accuracy"] > 0.65


def test_registered_queries_search_full_grids(monkeypatch):
    asked = []

    class Trained:
        def __getattr__(self, _):
            return lambda *a, **k: (0, self) if _ == "tune_threshold" else self

    def noted(name, data, *rest, grid=None, **more):
        asked.append((name, data, list(grid) if grid else None))
        return Trained()

    monkeypatch.setattr(queries, "train", noted)
    monkeypatch.setattr(queries, "training_frame", lambda spark, sf_dir, folds=inspect.signature(queries.training_frame).parameters["folds"].default: folds)
    for name in ("logreg", "decision_tree", "random_forest", "svm", "boosted_trees"):
        queries.QUERIES[f"train_{name}"](None, "")
    queries.QUERIES["oof_report"](None, ""), queries.QUERIES["tuned_threshold"](None, "")
    assert {(folds, grid) for _, folds, grid in asked} == {(5, None)}
    queries.QUERIES["train_svm_rbf"](None, "")
    assert asked[-1][2] == [p for p in FULL_GRIDS["svm"] if p["kernel"] == "rbf"] and len(asked[-1][2]) == 6
    models = queries.document_spec()["models"]
    assert set(models["active"]) == set(FULL_GRIDS) and models["cv"] == 5 and "grid" not in models


def test_families_run_side_by_side_in_the_order_of_the_spec(spark):
    from threading import Barrier

    from tabloom.plans.workflow import side_by_side

    met = Barrier(3, timeout=60)

    def call(i):
        met.wait()  # breaks if one call waits for another to end
        assert store.exists("/") and type(spark).getActiveSession() is not None
        return i, spark.range(i).count()

    assert side_by_side(spark, [lambda i=i: call(i) for i in (5, 3, 4)], 8) == [(5, 5), (3, 3), (4, 4)]
    assert side_by_side(spark, [lambda: 1, lambda: 2], 1) == [1, 2]


def test_training_reads_the_texts_once(spark):
    """What a workflow or search goes on from is a table that is written, not a scan of the documents."""
    rows = queries.training_documents(spark, "/root/testdata/sf0.001")
    plan = rows._jdf.queryExecution().toString()
    assert "FileScan" not in plan and "labels" not in plan
    assert rows.count() == queries.labelled_documents(spark, "/root/testdata/sf0.001").count() > 0

"""A full configuration over a generated passenger list, read from a file and scored."""

import numpy as np
import pytest

from tabloom.plans.workflow import check_spec, fit_workflow, id_of, loader_of, variants_of

COLUMNS = "PassengerId,Survived,Pclass,Name,Sex,Age,SibSp,Parch,Ticket,Fare,Cabin,Embarked"


@pytest.fixture(scope="module")
def passengers(tmp_path_factory):
    rng = np.random.default_rng(11)
    lines = [COLUMNS]
    for i in range(1, 221):
        level, woman = int(rng.integers(1, 4)), bool(rng.integers(0, 2))
        saved = int(rng.random() < (0.85 if woman else 0.2))
        title = rng.choice(["Mrs", "Miss"]) if woman else rng.choice(["Mr", "Master", "Dr"])
        age = "" if i % 9 == 0 else f"{rng.uniform(1, 70):.1f}"
        cabin = f"{'ABC'[level - 1]}{i}" if i % 5 else ""
        lines.append(f'{i},{saved},{level},"Made, {title}. Up {i}",{"female" if woman else "male"},{age},{rng.integers(0, 3)},'
                     f'{rng.integers(0, 2)},T{i},{rng.gamma(2, 40 / level):.2f},{cabin},{rng.choice(["S", "C", "Q"]) if i % 50 else "?"}')
    path = tmp_path_factory.mktemp("made") / "train.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def passenger_spec(path: str) -> dict:
    """As a user writes it: the id among the dropped columns, blank sections, a list of models without the raw fare."""
    return {
        "loader": {"train_path": path, "test_path": path, "target_col": "Survived", "drop_cols": ["PassengerId", "Ticket"],
                   "drop_missing_thresh": 0.8},
        "feature_engineering": {"enabled": True, "drop_raw_fare_for": ["logreg", "svm"]},
        "cleaner": {"num_strategy": "knn", "cat_strategy": "knn", "knn_neighbors": 5},
        "outliers": {"detection": ["iqr", "zscore"], "treatment": "winsorization", "cols": ["Fare", "Age"], "apply_to": ["logreg"]},
        "multicollinearity": {"threshold": 0.85, "drop": True, "apply_to": ["logreg"]},
        "pca": {"n_components": 0.95, "apply_to": ["logreg"]},
        "encoder": {"num_strategy": "standard", "cat_strategy": "ohe"},
        "models": {"active": ["logreg", "decision_tree"], "cv": 3, "scoring": "f1_weighted", "random_state": 42, "grid": "short",
                   "tune_threshold": False, "threshold_scoring": "f1"},
        "model_cache": None,
        "ensemble": {"enabled": True, "voting": "soft", "weights": {"logreg": 1, "decision_tree": 1}, "members": ["logreg", "decision_tree"]},
        "output": {"submission_dir": "out"},
    }


def test_the_whole_configuration_runs(spark, passengers, tmp_path):
    spec = passenger_spec(passengers)
    raw = spark.read.csv(passengers, header=True, inferSchema=True)
    fitted = fit_workflow(spec, raw)
    assert fitted.prepared.id_col == "PassengerId"
    cleaned = fitted.prepared.clean(raw.drop("Ticket", "Survived"))
    seen = {v: fitted.prepared.matrix(cleaned, v, ["PassengerId"]).columns for _, _, v in variants_of(spec) if not v.pca}
    by_model = {base: seen[v] for key, base, v in variants_of(spec) if not v.pca}
    assert "Fare" not in by_model["logreg"] and "Fare" in by_model["decision_tree"]
    assert all("Ticket" not in c for names in seen.values() for c in names)
    board = {r["model"]: r["score"] for r in fitted.leaderboard(spark).collect()}
    assert set(board) == {"logreg", "logreg_pca", "decision_tree", "ensemble"} and min(board.values()) > 0.6
    out = fitted.score(raw.drop("Survived"), "ensemble").collect()
    assert {r["PassengerId"] for r in out} == set(range(1, 221)) and {r["Survived"] for r in out} == {0, 1}


def test_settings_without_meaning_are_refused(passengers):
    spec = passenger_spec(passengers)
    check_spec(spec)
    assert id_of(spec) == "PassengerId" and loader_of(spec).drop_cols == ("Ticket",)
    for part, key in (("loader", "targt_col"), ("models", "fold"), ("cleanr", None)):
        bad = {**spec, part: {**(spec.get(part) or {}), key: 1} if key else {}}
        with pytest.raises(ValueError, match="unknown settings"):
            check_spec(bad)
    with pytest.raises(ValueError, match="id_col"):
        id_of({**spec, "feature_engineering": {"enabled": False}})
    assert "Fare" not in str(variants_of({**spec, "feature_engineering": None}))

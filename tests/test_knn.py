import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.operators.impute import Imputer
from tabloom.operators.knn import KnnImputer

DIRTY = [
    (0, 25.0, 10.0, 1, "male"), (1, None, 20.0, 2, None), (2, 35.0, None, 3, "female"),
    (3, 30.0, 40.0, 1, "male"), (4, None, 50.0, 2, "female"),
]
SCHEMA = "id long, Age double, Fare double, Pclass int, Sex string"


def brute(fit: np.ndarray, ids, new: np.ndarray, k: int) -> np.ndarray:
    """Nearest-neighbour fill straight from the definition."""
    out = new.copy()
    means = np.array([np.nan if np.isnan(c).all() else np.nanmean(c) for c in fit.T])
    for r, x in enumerate(new):
        for j in np.flatnonzero(np.isnan(x)):
            near = []
            for i, y in zip(ids, fit):
                both = ~np.isnan(x) & ~np.isnan(y)
                if not np.isnan(y[j]) and both.any():
                    near.append((((x - y)[both] ** 2).sum() * len(x) / both.sum(), i, y[j]))
            near.sort()
            out[r, j] = np.mean([v for *_, v in near[:k]]) if near else means[j]
    return out


def test_five_row_golden(spark):
    df = spark.createDataFrame(DIRTY, SCHEMA)
    out = {r["id"]: r for r in Imputer("knn", "knn", 2).fit(df, id_col="id").transform(df).collect()}
    assert out[1]["Age"] == 30.0 and out[4]["Age"] == 32.5
    assert out[2]["Fare"] == 35.0 and out[1]["Sex"] == "female"


def test_unseen_category_and_second_frame(spark):
    df = spark.createDataFrame(DIRTY, SCHEMA)
    new = spark.createDataFrame([(9, None, 11.0, 1, "other"), (10, 5.0, 5.0, 1, None)], SCHEMA)
    first = KnnImputer(2, "id").fit(df).transform(new).orderBy("id").collect()
    assert first[0]["Sex"] == "female" and all(v is not None for r in first for v in r)
    kept = KnnImputer(2, "id", unknown="keep").fit(df).transform(new).orderBy("id").collect()
    assert kept[0]["Sex"] == "other"


@pytest.mark.parametrize("cell_rows", [4096, 16])
def test_matches_brute_force(spark, cell_rows):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(0, 10, 300), rng.exponential(5, 300), rng.integers(0, 4, 300)]).astype(float)
    x[:100] = [1.0, 2.0, 3.0]  # a third of the rows are copies of one vector
    holes = rng.random(x.shape) < 0.2
    holes[:60] = False
    x[holes] = np.nan
    x[250] = np.nan
    pdf = pd.DataFrame(x, columns=list("abc"))
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    out = KnnImputer(5, "id", cell_rows=cell_rows).fit(df).transform(df).orderBy("id").toPandas()
    assert np.allclose(out[list("abc")].to_numpy(), brute(x, range(300), x, 5))
    assert len(out) == len(pdf)


def test_row_order_and_partitioning_do_not_matter(spark):
    df = spark.createDataFrame(DIRTY, SCHEMA)
    a = KnnImputer(2, "id").fit(df).transform(df).orderBy("id").collect()
    shuffled = df.orderBy(F.desc("id")).repartition(3)
    assert a == KnnImputer(2, "id").fit(shuffled).transform(shuffled).orderBy("id").collect()


def test_a_gap_in_the_widest_column_does_not_visit_every_cell(spark):
    rng = np.random.default_rng(7)
    rows = [(i, None if i % 10 == 0 else float(a), float(b)) for i, (a, b) in
            enumerate(zip(rng.normal(0, 100, 2000), rng.normal(0, 1, 2000)))]
    df = spark.createDataFrame(rows, "id long, wide double, narrow double")
    model = KnnImputer(3, "id", cell_rows=100).fit(df)
    x = np.array([[np.nan if r[1] is None else r[1], r[2]] for r in rows])
    gaps = x[np.isnan(x[:, 0])]
    bounds = model.boxes.lower_bounds(gaps)
    assert len(model.boxes.cell) >= 16
    assert model.boxes.nearest(gaps, bounds, 3).sum() <= 2 * len(gaps)
    assert (np.isfinite(bounds) & (bounds > 0)).sum(axis=1).mean() > 0.8 * len(model.boxes.cell)
    out = model.transform(df).orderBy("id").toPandas()
    assert np.allclose(out[["wide", "narrow"]].to_numpy(), brute(x, range(2000), x, 3))


def test_several_gap_patterns_get_their_own_layout(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(0, [50.0, 40.0, 1.0], (400, 3))
    x[0:60, 0] = np.nan
    x[60:110, 1] = np.nan
    x[110:130, :2] = np.nan
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    model = KnnImputer(4, "id", cell_rows=50).fit(df)
    assert len(model.boxes.depth) > 1
    out = model.transform(df).orderBy("id").toPandas()
    assert np.allclose(out[list("abc")].to_numpy(), brute(x, range(400), x, 4))

"""Profiling, imputation, outliers, collinearity, encoding and projection."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import profile, quantiles
from tabloom.operators.collinear import Collinear
from tabloom.operators.correlate import correlations
from tabloom.operators.encode import Encoder, LabelEncoder, discover_categories
from tabloom.operators.impute import GroupMedianImputer, Imputer
from tabloom.operators.outliers import Outliers
from tabloom.operators.reduce import Reducer, kept_components

DIRTY = "id long, Age double, Fare double, Sex string, Pclass int"
ROWS = [
    (0, 25.0, 10.0, "male", 1), (1, None, 20.0, None, 2), (2, 35.0, None, "female", 3),
    (3, 30.0, 40.0, "male", 1), (4, None, 50.0, "female", 2),
]


@pytest.fixture(scope="module")
def dirty(spark):
    return spark.createDataFrame(ROWS, DIRTY)


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(10, 1, 200)
    x[0], x[1] = 100.0, -80.0
    rows = [(i, float(a), float(a + e), float(z)) for i, (a, e, z) in
            enumerate(zip(x, rng.normal(0, 0.01, 200), rng.normal(0, 1, 200)))]
    return spark.createDataFrame(rows, "id long, x double, x_clone double, z double")


@pytest.mark.parametrize("inline", [10_000, 60, 10])
def test_quantiles_are_exact_whatever_the_budget(spark, inline):
    rng = np.random.default_rng(1)
    x = np.where(rng.random(1500) < 0.4, 5.0, rng.normal(5, 1, 1500))
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    probs = [0.0, 0.25, 0.33, 0.5, 1.0]
    got = quantiles.exact_quantiles(df, ["x"], probs, inline)["x"]
    assert np.allclose(got, np.quantile(x, probs), rtol=1e-12)


@pytest.mark.parametrize("sent", [10_000, 1])
def test_grouped_quantiles(spark, monkeypatch, sent):
    monkeypatch.setattr(quantiles, "MAX_SENT_BRACKETS", sent)
    rng = np.random.default_rng(2)
    rows = [("big" if i % 3 else f"g{i % 7}", float(v)) for i, v in enumerate(rng.normal(size=600))]
    rows += [("tied", float(v)) for v in rng.integers(0, 3, 300)] + [("one", 4.0)] * 50 + [("ends", v) for v in (-np.inf, np.inf) for _ in range(30)]
    rows += [("void", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: (r["a"], r["b"]) for r in
           quantiles.grouped_quantiles(df, "g", "x", [0.33, 0.66], ["a", "b"], inline=20).collect()}
    assert got.pop("void") == (None, None) and got.pop("ends") == (-np.inf, np.inf)
    for g, pair in got.items():
        assert np.allclose(pair, np.quantile([v for k, v in rows if k == g], [0.33, 0.66]))
    assert len(got) == 10


def test_a_thousand_hot_groups_are_narrowed_together(spark):
    rng = np.random.default_rng(5)
    g = np.repeat(np.arange(1000), 60)
    x = np.where(rng.random(len(g)) < 0.2, 1.5, np.round(rng.lognormal(0, 4, len(g)), 2))
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(g, x)], "g int, x double")
    out = quantiles.grouped_quantiles(df, "g", "x", [0.0, 0.5, 1.0], ["a", "b", "c"], inline=8)
    assert "Window" not in out._jdf.queryExecution().toString()
    got = {r["g"]: (r["a"], r["b"], r["c"]) for r in out.collect()}
    assert len(got) == 1000
    for i in range(1000):
        assert np.allclose(got[i], np.quantile(x[g == i], [0, 0.5, 1]), rtol=1e-12)


def test_missing_report_and_sparse_columns(spark, dirty):
    report = {r["column"]: (r["count"], r["pct"]) for r in profile.missing_report(dirty).collect()}
    assert report == {"Age": (2, 40.0), "Fare": (1, 20.0), "Sex": (1, 20.0)}
    df = spark.range(100).select("id", F.when(F.col("id") < 19, 1).alias("a"), F.when(F.col("id") < 18, 1).alias("b"))
    assert profile.drop_sparse(df, 0.8).columns == ["id", "a"]


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "x double")
    assert profile.missing_report(df).first()["count"] == 2
    assert profile.numeric_summary(df).first()["count"] == 1


def test_summary_info_balance(dirty):
    out = profile.summary(dirty.drop("id"))
    assert out["numerical"]["Age"]["q50"] == 30.0 and out["numerical"]["Age"]["count"] == 3
    assert out["categorical"]["Sex"] == {"unique": 2, "top_5": {"female": 2, "male": 2}}
    info = profile.info(dirty, "Pclass")
    assert info["rows"] == 5 and info["target_distribution"] == {1: 2, 2: 2, 3: 1}
    balance = [tuple(r) for r in profile.class_balance(dirty, "Sex").collect()]
    assert balance == [("female", 2, 40.0), ("male", 2, 40.0)]


def test_correlation_edges(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, 4.0), (3.0, 5.0, None)], "a double, k double, b double")
    r = {(x["column"], x["other"]): x["r"] for x in profile.correlation(df).collect()}
    assert r[("a", "b")] == 1.0 and r[("a", "k")] is None and r[("k", "k")] is None
    assert profile.correlation(df, ["a"]).count() == 0
    pairs = [("a", "b"), ("a", "k"), ("a", "a")]
    wide = correlations(df, pairs, wide_above=0)
    assert wide[("a", "b")] == pytest.approx(1.0) and wide[("a", "k")] is None


def test_correlation_is_the_same_for_any_width(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=300)
    far = rng.normal(size=20)
    a[:20] = 1e8 + far
    c = [float(x + 0.1 * e) for x, e in zip(far, rng.normal(size=20))] + [None] * 280
    rows = [(float(x), y, *(float(x) * i for i in range(26))) for x, y in zip(a, c)]
    names = ["a", "c", *(f"x{i}" for i in range(26))]
    wide = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(3)
    narrow = correlations(wide, [("a", "c")])[("a", "c")]
    many = correlations(wide, [(p, q) for i, p in enumerate(names) for q in names[i + 1 :]])
    assert narrow == pytest.approx(np.corrcoef(a[:20] - 1e8, c[:20])[0, 1], abs=1e-6)
    assert many[("a", "c")] == pytest.approx(narrow, abs=1e-9) and many[("a", "x0")] is None


def test_simple_imputation(spark, dirty):
    model = Imputer("median", "most_frequent").fit(dirty, exclude=["id"])
    out = {r["id"]: r for r in model.transform(dirty).collect()}
    assert out[1]["Age"] == 30.0 and out[2]["Fare"] == 30.0 and out[1]["Sex"] == "female"
    later = spark.createDataFrame([(9, None, None, None, None)], DIRTY)
    row = model.transform(later).first()
    assert row["Age"] == 30.0 and row["Pclass"] is None  # had no gap at fit time
    mean = Imputer("mean", "unknown").fit(dirty, exclude=["id"]).transform(dirty).where("id = 1").first()
    assert mean["Age"] == 30.0 and mean["Sex"] == "unknown"


def test_all_missing_column_and_empty_frame(spark):
    df = spark.createDataFrame([(None, "a"), (None, None)], "x double, c string")
    assert [r["x"] for r in Imputer().fit(df).transform(df).collect()] == [None, None]
    empty = spark.createDataFrame([], "x double, c string")
    assert Imputer("mean", "most_frequent").fit(empty).transform(empty).count() == 0
    assert Outliers(["iqr", "zscore"]).fit(empty).bounds == {"x": (None, None)}


def test_group_median_many_groups_join(spark, monkeypatch):
    import tabloom.operators.lookup as lookup

    rows = [(g, float(v)) for g in range(30) for v in (g, g + 2)] + [(3, None), (99, None)]
    df = spark.createDataFrame(rows, "g int, x double")
    fit = df.where("g < 99")
    expected = None
    for literal, broadcast in ((200, 10_000), (5, 10_000), (5, 10)):
        monkeypatch.setattr(lookup, "MAX_LITERAL_MAP", literal)
        monkeypatch.setattr(lookup, "MAX_BROADCAST_GROUPS", broadcast)
        out = sorted(map(tuple, GroupMedianImputer("x", "g").fit(fit).transform(df).collect()))
        expected = expected or out
        assert out == expected and (3, 4.0) in out and (99, 15.5) in out


def test_outliers(noisy):
    model = Outliers("iqr", cols=["x", "z"]).fit(noisy)
    top = model.transform(noisy).agg(F.max("x"), F.min("x")).first()
    assert top[0] < 100 and top[1] > -80
    assert {r["column"] for r in model.report(noisy).collect()} >= {"x"}
    both = Outliers(["iqr", "zscore"]).fit(noisy.drop("id"))
    assert both.transform(noisy).where("x IS NULL").count() == 0
    lo, hi = both.bounds["x"]
    assert lo >= model.bounds["x"][0] and hi <= model.bounds["x"][1]
    with pytest.raises(ValueError):
        Outliers("iqr", cols=["nope"]).fit(noisy)


def test_clip_keeps_missing(spark):
    df = spark.createDataFrame([(None,), (1.0,), (2.0,), (3.0,), (1000.0,)], "x double")
    out = [r[0] for r in Outliers("iqr").fit(df).transform(df).collect()]
    assert out[0] is None and out[4] < 1000


def test_collinear(noisy):
    df = noisy.drop("id")
    model = Collinear().fit(df)
    assert [p[:2] for p in model.pairs] == [("x", "x_clone")] and len(model.cols_to_drop) == 1
    assert len(model.transform(df).columns) == 2
    assert Collinear(drop=False).fit(df).transform(df).columns == df.columns


def test_encoder(spark):
    df = spark.createDataFrame([(1.0, "b", 5.0), (3.0, "a", 5.0), (None, None, 5.0)], "x double, c string, k double")
    out = Encoder().fit(df)
    assert out.output_columns == ["x", "k", "c_b", "c_nan"]
    rows = [tuple(r) for r in out.transform(df).collect()]
    assert rows == [(-1.0, 0.0, 1.0, 0.0), (1.0, 0.0, 0.0, 0.0), (None, 0.0, 0.0, 1.0)]
    new = spark.createDataFrame([(5.0, "zzz", 6.0)], df.schema)
    assert tuple(Encoder("minmax").fit(df).transform(new).first()) == (2.0, 1.0, 0.0, 0.0)
    ordinal = Encoder("none", "ordinal").fit(df.where("c IS NOT NULL"))
    assert ordinal.transform(new).first()["c"] == -1.0
    assert ordinal.transform(df.where("c IS NULL")).first()["c"] is None
    with pytest.raises(ValueError):
        discover_categories(df, ["c"], limit=2)


def test_label_codes(spark):
    df = spark.createDataFrame([("no",), ("yes",), ("no",)], "y string")
    model = LabelEncoder.fit(df, "y")
    coded = model.encode(df, "y")
    assert [r["label"] for r in coded.collect()] == [0.0, 1.0, 0.0]
    assert [r["z"] for r in model.decode(coded, "label", "z").collect()] == ["no", "yes", "no"]
    with pytest.raises(Exception, match="not seen"):
        model.encode(spark.createDataFrame([("maybe",)], "y string"), "y").collect()


def test_pca_matches_singular_vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(100, 3))
    x = np.hstack([base, base @ rng.normal(size=(3, 5)) + rng.normal(0, 0.01, (100, 5))]) + 7
    names = [f"f{i}" for i in range(8)]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, " + ", ".join(f"{n} double" for n in names))
    model = Reducer(0.95).fit(df, names)
    out = model.transform(df, ["id"]).orderBy("id").toPandas()
    assert out.columns[1] == "PC1" and len(out) == 100 and model.components < 8
    _, s, v = np.linalg.svd(x - x.mean(0), full_matrices=False)
    v *= np.sign(v[np.arange(8), np.abs(v).argmax(1)])[:, None]
    assert np.allclose(out.drop(columns="id"), ((x - x.mean(0)) @ v.T)[:, : model.components], atol=1e-6)
    share = (s**2 / (s**2).sum())[: model.components].sum()
    assert model.report() == {"n_components_in": 8, "n_components_out": model.components,
                              "variance_explained": pytest.approx(share, abs=1e-4)}
    assert Reducer(3).fit(df, names).components == 3
    assert kept_components([0.5, 0.3, 0.2], 0.8) == 3 or kept_components([0.5, 0.3, 0.2], 0.79) == 2


def test_only_crowded_groups_are_dealt_over_keys(spark, monkeypatch):
    """A bracket of a small group is one row of the join, not one for each key."""
    monkeypatch.setattr(quantiles, "MAX_SENT_BRACKETS", 0)
    monkeypatch.setattr(quantiles, "CROWDED", 50)
    rows = spark.range(160).selectExpr("if(id < 100, 0, 1 + id % 6) g", "double(id) x")
    table = rows.groupBy("g").agg(F.count("x").alias("n"))
    copies, original = [], F.explode
    monkeypatch.setattr(quantiles.F, "explode", lambda c: copies.append(c) or original(c))
    assert quantiles._with_groups(rows, table, 7).count() == 160
    sizes = {r["g"]: r["k"] for r in table.select("g", F.size(copies[0]).alias("k")).collect()}
    assert sizes == {0: 64, **{g: 1 for g in range(1, 7)}}
    assert quantiles._with_groups(rows, table.where("g > 0"), 6, "left_anti").count() == 100

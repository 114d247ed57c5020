"""Codes and mappings of many values, sent to executors or joined."""

import pytest
from pyspark.sql import functions as F

from tabloom.operators import dictionary, profile
from tabloom.operators.dictionary import Dictionary, map_column, with_places
from tabloom.operators.encode import Encoder, LabelEncoder


@pytest.fixture(params=["sent", "joined"], autouse=True)
def way(request, monkeypatch):
    if request.param == "joined":
        monkeypatch.setattr(dictionary, "MAX_SENT_BYTES", 0)


@pytest.fixture(scope="module")
def many(spark):
    """5,000 values, one of which holds a third of the rows, and gaps."""
    rows = [(i, "hot" if i % 3 == 0 else f"v{i * 7919 % 5000}" if i % 10 else None) for i in range(20_000)]
    return spark.createDataFrame(rows, "id long, c string").repartition(5)


def test_places_follow_the_order_within_each_column(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("w"), (F.col("id") * 7919 % 3000).alias("x")).repartition(7)
    for r in with_places(df, "w", "x").collect():
        assert r["place"] == r["x"] // 3


def test_ordinal_codes_have_no_limit(spark, many):
    model = Encoder("none", "ordinal").fit(many.where("id % 7 <> 1"), ["id"])
    known = sorted({r["c"] for r in many.where("id % 7 <> 1").collect()} - {None})
    code = {v: float(i) for i, v in enumerate(known)}
    text = {r["id"]: r["c"] for r in many.collect()}
    got = {r["id"]: r["c"] for r in model.transform(many, ["id"]).collect()}
    assert len(known) > 4000 and len(got) == 20_000
    assert all(got[i] == (None if v is None else code.get(v, -1.0)) for i, v in text.items())
    assert model.output_columns == ["c"]
    with pytest.raises(ValueError):
        model.to_dict()
    with pytest.raises(ValueError):
        Encoder("none", "ohe", max_categories=100).fit(many, ["id"])


def test_columns_of_few_and_many_values_beside_each_other(spark, many):
    df = many.withColumns({"few": F.when(F.col("id") % 2 == 0, "b").otherwise("a"), "x": F.col("id") * 1.0})
    out = Encoder("none", "ordinal").fit(df, ["id"]).transform(df, ["id"])
    assert out.columns == ["id", "x", "c", "few"]
    assert out.where((F.col("few") == 1) != (F.col("id") % 2 == 0)).count() == 0


def test_label_codes_have_no_limit(spark, many):
    model = LabelEncoder.fit(many, "c")
    out = model.decode(model.encode(many, "c"), "label", "back")
    assert out.where(~F.col("back").eqNullSafe(F.col("c"))).count() == 0
    numbers = spark.range(1000).select((F.col("id") * 10 - 300).alias("y"))
    coded = LabelEncoder.fit(numbers, "y").encode(numbers, "y")
    assert coded.where(F.col("label") != (F.col("y") + 300) / 10).count() == 0
    with pytest.raises(Exception, match="not seen"):
        model.encode(spark.createDataFrame([("maybe",)], "c string"), "c").collect()


def test_mappings_of_any_size(spark, many):
    pairs = {f"v{i}": i for i in range(0, 5000, 2)}
    for mapping in (pairs, spark.createDataFrame(list(pairs.items()), "a string, b long"), {"v2": 2, "v4": 4}):
        known = mapping if isinstance(mapping, dict) else pairs
        for r in map_column(many, F.col("c"), mapping, "m", -5).collect():
            assert r["m"] == known.get(r["c"], -5)
    assert map_column(many, F.col("c"), pairs, "m").where("m IS NULL").count() > 0


def test_empty_tables(spark):
    df = spark.createDataFrame([], "c string")
    codes = Dictionary.fit(df, {"c": F.col("c")})
    assert codes.sizes == {} and codes.encode(df, "c", F.col("c"), "k").count() == 0
    assert map_column(df, F.col("c"), df.select("c", F.lit(1).alias("v")), "m").columns == ["c", "m"]


def test_info_of_a_target_of_many_values(spark, many, monkeypatch):
    monkeypatch.setattr(profile, "MAX_TARGET_VALUES", 100)
    out = profile.info(many, "c")
    assert out["rows"] == 20_000 and out["target_distribution"] is None
    assert out["target_counts"].agg(F.sum("count")).first()[0] == many.where("c IS NOT NULL").count()

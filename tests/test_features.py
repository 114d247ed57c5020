import pytest
from pyspark.sql import functions as F

from tabloom.functions import cut, map_values, normalise_markers
from tabloom.operators.features import GroupTiers, PassengerFeatures

ROWS = [
    ("Braund, Mr. Owen", 3, 100.0, 0, 0, 22.0),
    ("Heikkinen, Miss. Laina", 1, 30.0, 1, 0, 26.0),
    ("Palsson, Master. Gosta", 3, 20.0, 3, 1, 2.0),
    ("Smith, Dr. John", 2, 50.0, 0, 0, 12.0),
    ("Bonnell, Mrs. Elizabeth", 1, 80.0, 0, 0, 45.0),
]


@pytest.fixture()
def people(spark):
    rows = [(i, *r) for i, r in enumerate(ROWS)]
    return spark.createDataFrame(
        rows, "id int, Name string, Pclass int, Fare double, SibSp int, Parch int, Age double"
    )


def test_passenger_features(people):
    out = {r["id"]: r for r in PassengerFeatures(["logreg"]).fit_transform(people).collect()}
    assert [out[i]["TitleGroup"] for i in range(5)] == ["Mr", "Miss", "Master", "Officer", "Mrs"]
    assert out[0]["FarePerPerson"] == 100.0
    assert out[1]["FarePerPerson"] == 15.0
    assert [out[i]["AgeGroup"] for i in range(5)] == ["Adult", "Adult", "Child", "Child", "Middle"]
    assert all(1 <= out[i]["SocialClass"] <= 9 for i in range(5))
    assert out[2]["IsAlone"] == 0 and out[0]["IsAlone"] == 1
    assert "Name" not in out[0].asDict() and "Fare" in out[0].asDict()


def test_raw_column_dropped_only_for_listed_models(people):
    model = PassengerFeatures(["logreg"]).fit(people)
    assert "Fare" not in model.transform(people, "logreg").columns
    assert "Fare" in model.transform(people, "forest").columns


def test_group_seen_with_missing_values_stays_missing(spark):
    fit = spark.createDataFrame(
        [("A, Mr. X", 1, 1.0, 0, 0, None), ("B, Mrs. Y", 1, 2.0, 0, 0, 40.0)],
        "Name string, Pclass int, Fare double, SibSp int, Parch int, Age double",
    )
    new = spark.createDataFrame(
        [("C, Mr. Z", 1, 1.0, 0, 0, None), ("D, Master. W", 9, 1.0, 0, 0, None)], fit.schema
    )
    ages = {r["TitleGroup"]: r["Age"] for r in PassengerFeatures().fit(fit).transform(new).collect()}
    assert ages == {"Mr": None, "Master": 40.0}


def test_report_sections(people):
    model = PassengerFeatures().fit(people)
    rows = model.report(model.transform(people)).collect()
    assert {r["section"] for r in rows} == {
        "TitleGroup", "AgeGroup", "SocialClass", "FamilySize", "IsAlone", "AgeImputationByTitle", "FarePerPerson"
    }


def test_tiers_default_for_null_and_unseen(spark):
    fit = spark.createDataFrame([("a", float(i)) for i in range(101)], "g string, x double")
    model = GroupTiers("x", "g").fit(fit)
    new = spark.createDataFrame(
        [("a", 33.0), ("a", 33.5), ("a", 66.5), ("a", None), ("b", 99.0), (None, 1.0)], "g string, x double"
    )
    assert [r["t"] for r in model.transform(new, "t").collect()] == [0, 1, 2, 1, 1, 1]


def test_cut_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 12.0, 12.5, 120.0, 121.0, -1.0, None)], "x double")
    got = [r[0] for r in df.select(cut(F.col("x"), (0, 12, 120), ("low", "high"))).collect()]
    assert got == ["low", "low", "high", "high", None, None, None]
    left = [r[0] for r in df.select(cut(F.col("x"), (0, 12, 120), ("low", "high"), right=False)).collect()]
    assert left == ["low", "high", "high", "high", None, None, None]


def test_markers_and_mapping(spark):
    df = spark.createDataFrame([("?",), (" N/A ",), ("--",), ("null",), ("None",), ("ok",)], "v string")
    assert [r[0] for r in normalise_markers(df).collect()] == [None, None, None, "null", None, "ok"]
    mapped = df.select(map_values(F.col("v"), {"ok": 1}, 0)).collect()
    assert [r[0] for r in mapped] == [0, 0, 0, 0, 0, 1]


def test_social_class_golden(spark):
    rows = [(i, f"X, Mr. N{i}", *r) for i, r in enumerate(
        [(1, 100.0, 0, 0, 35.0), (2, 30.0, 1, 0, 25.0), (3, 8.0, 0, 1, 10.0), (3, 7.5, 2, 1, 5.0), (1, 90.0, 0, 0, 45.0)]
    )]
    df = spark.createDataFrame(rows, "id int, Name string, Pclass int, Fare double, SibSp int, Parch int, Age double")
    out = PassengerFeatures().fit_transform(df).orderBy("id").collect()
    assert [r["SocialClass"] for r in out] == [1, 6, 7, 9, 3]

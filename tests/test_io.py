"""Reading, writing, streams, plan shapes and agreement with SQL."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from tabloom.functions import column_kinds
from tabloom.operators.encode import Encoder
from tabloom.operators.impute import Imputer
from tabloom.operators.knn import KnnImputer
from tabloom.operators.outliers import Outliers
from tabloom.plans.queries import QUERIES
from tabloom.sources.tables import Loader, as_records, read_csv, read_records, write_predictions, write_records
from tabloom.streaming.records import chain, each_batch, record_stream, write_stream

SMALL = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")


def test_csv_types_nulls_and_quotes(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('id,name,x,flag,odd,y\n1,"A ""B"" C",1.5,True,1,0\n2,n/a,NULL,False,?,1\n3,"x, y",,True,3,0\n')
    df = read_csv(spark, str(path))
    assert [t for _, t in df.dtypes] == ["bigint", "string", "double", "boolean", "string", "bigint"]
    rows = df.orderBy("id").collect()
    assert rows[0]["name"] == 'A "B" C' and rows[1]["name"] is None and rows[1]["x"] is None
    loaded = Loader("y", str(path), drop_cols=["name", "absent"]).load(spark)
    assert loaded.orderBy("id").collect()[1]["odd"] is None and loaded.schema["odd"].dataType.simpleString() == "string"
    promoted = Loader("y", str(path), promote=True).load(spark)
    assert promoted.schema["odd"].dataType.simpleString() == "bigint"
    kinds = {r["column"]: r["kind"] for r in column_kinds(df).collect()}
    assert kinds["flag"] == "categorical" and kinds["x"] == "numeric"
    with pytest.raises(ValueError):
        Loader("absent", str(path)).load(spark)


def test_records_and_predictions(spark, tmp_path):
    df = read_records(spark, [{"a": 1, "b": None}, {"a": 2, "b": "x"}], "a int, b string")
    assert sorted(r[0] for r in as_records(df).collect()) == ['{"a":1,"b":null}', '{"a":2,"b":"x"}']
    write_records(df, str(tmp_path / "r"))
    assert sorted(map(str, read_records(spark, str(tmp_path / "r"), "a int, b string").collect())) == sorted(map(str, df.collect()))
    path = write_predictions(df, str(tmp_path), "tree", "a", "b")
    assert path.endswith("submission_tree") and spark.read.csv(path, header=True).columns == ["a", "b"]


SCHEMA = "id long, x double, c string"
FIT = [(i, float(i), "ab"[i % 2]) for i in range(20)] + [(20, None, None), (21, 500.0, "a")]


def test_stream_equals_batch(spark, tmp_path):
    fit = spark.createDataFrame(FIT, SCHEMA)
    write_records(fit.repartition(3), str(tmp_path / "in"))
    imputer = Imputer().fit(fit, exclude=["id"])
    clipper = Outliers("iqr", cols=["x"]).fit(imputer.transform(fit))
    encoder = Encoder().fit(clipper.transform(imputer.transform(fit)), ["id"])
    steps = [imputer.transform, clipper.transform, lambda d: encoder.transform(d, ["id"])]
    stream = record_stream(spark, str(tmp_path / "in"), SCHEMA, files_per_batch=1)
    write_stream(chain(stream, steps), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    expected = chain(fit, steps)
    got = spark.read.schema(expected.schema).json(str(tmp_path / "out"))
    assert sorted(got.collect()) == sorted(expected.collect())


def test_stream_with_batch_only_step(spark, tmp_path):
    fit = spark.createDataFrame(FIT, SCHEMA)
    write_records(fit, str(tmp_path / "in"))
    model = KnnImputer(2, "id").fit(fit)
    stream = record_stream(spark, str(tmp_path / "in"), SCHEMA)
    each_batch(stream, [model.transform], str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.schema(SCHEMA).json(str(tmp_path / "out/*"))
    assert sorted(got.collect()) == sorted(model.transform(fit).select("id", "x", "c").collect())


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@needs_data
def test_transforms_stay_native_and_unshuffled(spark):
    plan = physical(QUERIES["prepare_table"](spark, SMALL))
    assert "Exchange" not in plan and "Python" not in plan and "Pandas" not in plan
    folds = physical(QUERIES["folds_in_order"](spark, SMALL))
    assert "Exchange" not in folds and "Window" not in folds
    tiers = physical(QUERIES["tier_and_score"](spark, SMALL))
    assert "Exchange" not in tiers
    top = physical(QUERIES["categorical_top5"](spark, SMALL))
    assert "WindowGroupLimit" in top


@needs_data
def test_scan_reads_only_needed_columns(spark):
    plan = physical(QUERIES["outlier_modified"](spark, SMALL))
    assert "ReadSchema: struct<value:double>" in plan


def _cell(v):
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0)
    return str(float(v)) if v is not None and hasattr(v, "as_tuple") else str(v)


@needs_data
@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_agrees_with_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in os.listdir(SMALL):
        con.sql(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{SMALL}/{t}'")
    df = entry_module.queries()[name](spark, SMALL)
    wanted = con.sql(entry_module.oracle_sql()[name])
    assert sorted(df.columns) == sorted(wanted.columns)
    order = sorted(df.columns)
    mine = sorted(tuple(_cell(r[c]) for c in order) for r in df.collect())
    at = [wanted.columns.index(c) for c in order]
    assert mine == sorted(tuple(_cell(r[i]) for i in at) for r in wanted.fetchall())


@needs_data
def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_columns_with_dots_and_spaces(spark):
    df = spark.createDataFrame([(1, 1.0, "a b"), (2, None, None)], "`the id` long, `a.b` double, `c d` string")
    out = Imputer("mean").fit(df, exclude=["the id"]).transform(df)
    encoded = Encoder().fit_transform(out, ["the id"], ["the id"])
    assert encoded.columns == ["the id", "a.b", "c d_unknown"]
    assert out.where(F.col("`a.b`") == 1.0).count() == 2


def test_csv_keeps_codes_that_only_look_like_numbers(spark, tmp_path):
    (tmp_path / "t.csv").write_text("seat,grade,hex,n,x\n12D,1f,0x1,1,1e5\n3F,2d,0x2,-2,.5\n")
    df = read_csv(spark, str(tmp_path / "t.csv"))
    assert dict(df.dtypes) == {"seat": "string", "grade": "string", "hex": "string", "n": "bigint", "x": "double"}
    assert [tuple(r) for r in df.orderBy("n").collect()] == [("3F", "2d", "0x2", -2, 0.5), ("12D", "1f", "0x1", 1, 1e5)]

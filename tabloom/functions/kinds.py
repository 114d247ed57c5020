"""Column kinds: which columns are numeric, which are categorical."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(name: str) -> Column:
    """Reference a column by its literal name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def categorical_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Everything that is not numeric, booleans included."""
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if not isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def column_kinds(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """One row per column with its kind; reads the schema only."""
    skip = set(exclude)
    numeric = set(numeric_columns(df))
    rows = [
        (i, f.name, "numeric" if f.name in numeric else "categorical")
        for i, f in enumerate(df.schema.fields)
        if f.name not in skip
    ]
    return df.sparkSession.createDataFrame(rows, "position int, column string, kind string")


def is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType))


def clean_double(df: DataFrame, name: str) -> Column:
    """The column as double, with NaN turned into NULL."""
    value = col(name).cast("double")
    if is_floating(df, name):
        value = F.when(~F.isnan(value), value)
    return value


def nan_to_null(df: DataFrame) -> DataFrame:
    """Canonical missing value: NULL. Spark orders NaN above every number."""
    fixes = {
        f.name: F.when(~F.isnan(col(f.name)), col(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.FloatType, T.DoubleType))
    }
    return df.withColumns(fixes) if fixes else df


def features_and_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    return df.drop(target), df.select(col(target))


def numeric_then_categorical(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Numeric block first, categorical block second, each in original order."""
    order = numeric_columns(df, exclude) + categorical_columns(df, exclude)
    return df.select(*[col(c) for c in order])

"""Reading mixed-type tables and writing predictions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import normalise_markers
from ..functions.kinds import col, nan_to_null
from ..operators import profile

# Cell texts that a delimited file uses for a missing value.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


#: How a number is written; a cast alone would also take suffixes, so that seat 12D became 12.0.
NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(?i:inf|infinity)$"


def as_number(cell: Column, kind: str) -> Column:
    """The number a cell writes, or NULL."""
    return F.when(cell.rlike(NUMBER), cell.try_cast(kind))


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, multi_line: bool = False
) -> DataFrame:
    """A headed CSV file. Without a schema, types are found after null tokens are removed.

    ``multi_line`` reads quoted cells with line breaks; a file is then read by one task.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    if schema is not None:
        return nan_to_null(reader.schema(schema).csv(path))
    text = reader.csv(path)
    clean = text.withColumns({c: F.when(~col(c).isin(list(NULL_TOKENS)), col(c)) for c in text.columns})
    return infer_types(clean)


def infer_types(text: DataFrame) -> DataFrame:
    """Promote all-string columns whose every present cell parses, in one pass."""
    checks = []
    for i, c in enumerate(text.columns):
        cell = F.trim(col(c))
        checks += [
            F.count(col(c)).alias(f"n{i}"),
            F.count(as_number(cell, "bigint")).alias(f"i{i}"),
            F.count(as_number(cell, "double")).alias(f"d{i}"),
            F.count_if(col(c).isin("True", "False", "TRUE", "FALSE", "true", "false")).alias(f"b{i}"),
        ]
    row = text.agg(*checks).first()
    casts = {}
    for i, c in enumerate(text.columns):
        n = row[f"n{i}"]
        if n == 0 or row[f"d{i}"] == n:
            whole = n > 0 and row[f"i{i}"] == n
            casts[c] = F.trim(col(c)).try_cast("bigint" if whole else "double")
        elif row[f"b{i}"] == n:
            casts[c] = col(c).try_cast("boolean")
    return nan_to_null(text.withColumns(casts)) if casts else text


def promote_numeric(df: DataFrame) -> DataFrame:
    """Second look at the types, once markers have become NULL (opt-in)."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not names:
        return df
    typed = infer_types(df.select(*[col(c) for c in names]))
    return df.withColumns({c: col(c).try_cast(typed.schema[c].dataType) for c in names})


@dataclass(frozen=True)
class Loader:
    """Read a table, turn markers into NULL, drop listed and mostly empty columns."""

    target: str
    path: str
    format: str = "csv"
    schema: T.StructType | str | None = None
    drop_cols: Sequence[str] = field(default_factory=tuple)
    drop_missing_thresh: float | None = None
    promote: bool = False
    multi_line: bool = False  # line breaks inside quoted CSV cells

    def load(self, spark: SparkSession) -> DataFrame:
        if not self.path:
            raise ValueError("a source path is needed")
        if self.format == "csv":
            df = read_csv(spark, self.path, self.schema, multi_line=self.multi_line)
        else:
            df = nan_to_null(spark.read.format(self.format).load(self.path))
        return self.prepare(df)

    def prepare(self, df: DataFrame) -> DataFrame:
        df = normalise_markers(df)
        if self.promote:
            df = promote_numeric(df)
        df = df.drop(*self.drop_cols)
        if self.drop_missing_thresh is not None:
            df = profile.drop_sparse(df, self.drop_missing_thresh)
        if self.target not in df.columns:
            raise ValueError(f"target column {self.target!r} is not in the table")
        return df


def read_records(spark: SparkSession, source: str | Sequence[Mapping], schema: T.StructType | str) -> DataFrame:
    """Rows from JSON lines at a path, or from a short list of objects."""
    if isinstance(source, str):
        return nan_to_null(spark.read.schema(schema).json(source))
    return nan_to_null(spark.createDataFrame(list(source), schema))


def as_records(df: DataFrame) -> DataFrame:
    """One JSON object per row, keys kept for missing cells."""
    packed = F.struct(*[col(c) for c in df.columns])
    return df.select(F.to_json(packed, {"ignoreNullFields": "false"}).alias("record"))


def write_records(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_predictions(df: DataFrame, folder: str, model: str, id_col: str, prediction: str) -> str:
    """Headed CSV with id and prediction under ``folder/submission_<model>``."""
    path = f"{folder.rstrip('/')}/submission_{model}"
    df.select(col(id_col), col(prediction)).write.mode("overwrite").option("header", True).csv(path)
    return path

"""Missing-value imputation learned on one frame, applied to any frame."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.kinds import categorical_columns, clean_double, col, numeric_columns
from .lookup import GroupLookup
from .profile import missing_counts, modes
from .quantiles import grouped_quantiles, quantiles

UNKNOWN = "unknown"


@dataclass(frozen=True)
class ImputeModel:
    numbers: dict[str, float]  # column -> fill value
    labels: dict[str, str]

    def transform(self, df: DataFrame) -> DataFrame:
        fixes = {
            c: F.coalesce(clean_double(df, c), F.lit(float(v)))
            for c, v in self.numbers.items()
            if c in df.columns
        }
        for c, v in self.labels.items():
            if c in df.columns:
                kind = df.schema[c].dataType
                value = col(c) if not isinstance(v, str) or isinstance(kind, T.StringType) else col(c).cast("string")
                fixes[c] = F.coalesce(value, F.lit(v))
        return df.withColumns(fixes) if fixes else df

    def to_dict(self) -> dict:
        return {"numbers": self.numbers, "labels": self.labels}


@dataclass(frozen=True)
class Imputer:
    """Strategies: numeric median, mean, most_frequent or knn; categorical unknown,
    most_frequent or knn. Choosing knn on either side imputes all columns jointly.

    Without explicit lists only columns with a missing cell at fit time are filled.
    """

    num_strategy: str = "median"
    cat_strategy: str = UNKNOWN
    knn_neighbors: int = 5
    num_cols: Sequence[str] | None = None
    cat_cols: Sequence[str] | None = None
    exact: bool = True

    def fit(self, df: DataFrame, exclude: Sequence[str] = (), id_col: str | None = None):
        if "knn" in (self.num_strategy, self.cat_strategy):
            from .knn import KnnImputer

            if id_col is None:
                raise ValueError("knn imputation needs id_col")
            return KnnImputer(self.knn_neighbors, id_col, exclude=tuple(exclude)).fit(df)
        gaps: dict[str, int] = {}
        if self.num_cols is None or self.cat_cols is None:
            _, gaps = missing_counts(df, [c for c in df.columns if c not in exclude])
        nums = list(self.num_cols) if self.num_cols is not None else [
            c for c in numeric_columns(df, exclude) if gaps[c]
        ]
        cats = list(self.cat_cols) if self.cat_cols is not None else [
            c for c in categorical_columns(df, exclude) if gaps[c]
        ]
        numbers = {c: v for c, v in self._numbers(df, nums).items() if v is not None}
        return ImputeModel(numbers, {c: v for c, v in self._labels(df, cats).items() if v is not None})

    def _numbers(self, df: DataFrame, names: list[str]) -> dict:
        if not names:
            return {}
        if self.num_strategy == "median":
            return {c: q[0] for c, q in quantiles(df, names, [0.5], self.exact).items()}
        if self.num_strategy == "mean":
            row = df.agg(*[F.avg(clean_double(df, c)).alias(f"m{i}") for i, c in enumerate(names)]).first()
            return {c: row[i] for i, c in enumerate(names)}
        if self.num_strategy == "most_frequent":
            return modes(df, names)
        return {}

    def _labels(self, df: DataFrame, names: list[str]) -> dict:
        if self.cat_strategy == UNKNOWN:
            return dict.fromkeys(names, UNKNOWN)
        if self.cat_strategy == "most_frequent" and names:
            return modes(df, names)
        return {}

    def fit_transform(self, df: DataFrame, **kwargs) -> DataFrame:
        return self.fit(df, **kwargs).transform(df)


@dataclass(frozen=True)
class GroupMedianModel:
    value: str
    group: str
    medians: GroupLookup
    fallback: float | None

    def transform(self, df: DataFrame) -> DataFrame:
        """Fill by group median. Only a group never seen at fit gets the global median."""
        order = df.columns
        with_median = self.medians.attach(df, col(self.group), "__seen")
        x = clean_double(df, self.value)
        fill = F.when(F.col("__seen"), F.col("median")).otherwise(F.lit(self.fallback).cast("double"))
        filled = with_median.withColumn(self.value, F.coalesce(x, fill))
        return filled.select(*[col(c) for c in order])


@dataclass(frozen=True)
class GroupMedianImputer:
    value: str
    group: str
    exact: bool = True

    def fit(self, df: DataFrame) -> GroupMedianModel:
        table = grouped_quantiles(df, self.group, self.value, [0.5], ["median"])
        fallback = quantiles(df, [self.value], [0.5], self.exact)[self.value][0]
        return GroupMedianModel(self.value, self.group, GroupLookup.collect(table), fallback)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

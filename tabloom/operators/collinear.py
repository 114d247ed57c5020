"""Collinear columns: find correlated pairs and choose which column of each to drop."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.kinds import numeric_columns
from .correlate import correlations


@dataclass(frozen=True)
class CollinearModel:
    pairs: list[tuple[str, str, float]]
    cols_to_drop: list[str]
    drop: bool = True

    def transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.cols_to_drop) if self.drop else df

    def pairs_frame(self, spark) -> DataFrame:
        return spark.createDataFrame(
            self.pairs, "col_a string, col_b string, r double"
        ).withColumn("r", F.round("r", 4))

    def dropped_frame(self, spark) -> DataFrame:
        return spark.createDataFrame([(c,) for c in self.cols_to_drop], "column string")

    def report(self) -> dict:
        return {
            "pairs": [{"col_a": a, "col_b": b, "r": round(r, 4)} for a, b, r in self.pairs],
            "cols_to_drop": list(self.cols_to_drop),
        }

    def to_dict(self) -> dict:
        return asdict(self)


@dataclass(frozen=True)
class Collinear:
    threshold: float = 0.85
    drop: bool = True
    columns: Sequence[str] | None = None

    def fit(self, df: DataFrame) -> CollinearModel:
        names = list(self.columns) if self.columns is not None else numeric_columns(df)
        order = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
        strength = {p: None if r is None else abs(r) for p, r in correlations(df, order).items()}
        pairs = [
            (a, b, strength[(a, b)])
            for a, b in order
            if strength[(a, b)] is not None and strength[(a, b)] > self.threshold
        ]

        def mean_with_others(name: str) -> float:
            known = [r for p, r in strength.items() if name in p and r is not None]
            return sum(known) / len(known)

        gone: list[str] = []
        for a, b, _ in pairs:
            if a not in gone and b not in gone:
                gone.append(a if mean_with_others(a) >= mean_with_others(b) else b)
        return CollinearModel(pairs, gone, self.drop)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

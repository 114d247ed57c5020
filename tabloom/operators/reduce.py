"""Principal components with centred projection and a fixed sign."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import PCA, PCAModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.kinds import clean_double, col


@dataclass(frozen=True)
class ReducerModel:
    columns: list[str]
    means: list[float]
    components: int
    ratio: list[float]
    signs: list[float]
    model: PCAModel

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Columns PC1..PCk. The library projects without centring, so subtract the projected mean."""
        offset = self.model.pc.toArray().T @ np.array(self.means)
        doubles = df.withColumns({c: clean_double(df, c) for c in self.columns})
        packed = VectorAssembler(inputCols=self.columns, outputCol=self.model.getInputCol()).transform(doubles)
        projected = self.model.transform(packed).withColumn("__pc", vector_to_array(self.model.getOutputCol()))
        parts = [
            ((F.col("__pc")[i] - F.lit(float(offset[i]))) * F.lit(self.signs[i])).alias(f"PC{i + 1}")
            for i in range(self.components)
        ]
        return projected.select(*[col(k) for k in keep], *parts)

    def report(self) -> dict:
        return {
            "n_components_in": len(self.columns),
            "n_components_out": self.components,
            "variance_explained": round(sum(self.ratio[: self.components]), 4),
        }


@dataclass(frozen=True)
class Reducer:
    """``n_components``: a share of variance (float below 1) or a fixed number (int)."""

    n_components: float | int = 0.95

    def fit(self, df: DataFrame, columns: Sequence[str]) -> ReducerModel:
        names = list(columns)
        doubles = df.select(*[clean_double(df, c).alias(c) for c in names])
        means_row = doubles.agg(*[F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(names)]).first()
        packed = VectorAssembler(inputCols=names, outputCol="__x").transform(doubles).select("__x")
        fixed = not isinstance(self.n_components, float)
        size = min(self.n_components, len(names)) if fixed else len(names)
        model = PCA(k=size, inputCol="__x", outputCol="__z").fit(packed)
        ratio = [float(r) for r in model.explainedVariance.toArray()]
        kept = size if fixed else kept_components(ratio, self.n_components)
        pc = model.pc.toArray()
        signs = [1.0 if pc[np.argmax(np.abs(pc[:, i])), i] >= 0 else -1.0 for i in range(size)]
        return ReducerModel(names, [float(m) for m in means_row], kept, ratio, signs, model)

    def fit_transform(self, df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
        return self.fit(df, columns).transform(df, keep)


def kept_components(ratio: Sequence[float], share: float) -> int:
    """Smallest count whose cumulative ratio exceeds the wanted share."""
    total = 0.0
    for i, r in enumerate(ratio):
        total += r
        if total > share:
            return i + 1
    return len(ratio)

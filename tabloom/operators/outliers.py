"""Outlier bounds learned on one frame, clipping and reporting on any frame."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import clip
from ..functions.kinds import clean_double, numeric_columns
from ..functions.stats import pct, tidy
from .quantiles import quantiles


@dataclass(frozen=True)
class OutlierModel:
    bounds: dict[str, tuple[float | None, float | None]]  # None = unbounded
    treatment: str = "winsorization"

    def bounds_frame(self, spark, digits: int = 4) -> DataFrame:
        rows = [(c, lo, hi) for c, (lo, hi) in self.bounds.items()]
        frame = spark.createDataFrame(rows, "column string, lower_bound double, upper_bound double")
        return frame.select(
            "column", *[F.round(b, digits).alias(b) for b in ("lower_bound", "upper_bound")]
        )

    def transform(self, df: DataFrame) -> DataFrame:
        if self.treatment != "winsorization":
            return df
        fixes = {
            c: clip(clean_double(df, c), lo, hi)
            for c, (lo, hi) in self.bounds.items()
            if c in df.columns
        }
        return df.withColumns(fixes) if fixes else df

    def report(self, df: DataFrame) -> DataFrame:
        """Per column with any outlier: how many cells lie strictly outside the bounds."""
        names = [c for c in self.bounds if c in df.columns]
        aggs = [F.count(F.lit(1)).alias("n")]
        for i, c in enumerate(names):
            lo, hi = self.bounds[c]
            aggs += [
                F.count_if(self._outside(df, c)).alias(f"o{i}"),
                F.lit(lo).cast("double").alias(f"lo{i}"),
                F.lit(hi).cast("double").alias(f"hi{i}"),
            ]
        if not names:
            return df.sparkSession.createDataFrame(
                [], "column string, outliers long, pct double, lower_bound double, upper_bound double"
            )
        fields = {
            c: {"outliers": f"o{i}", "n": "n", "lo": f"lo{i}", "hi": f"hi{i}"}
            for i, c in enumerate(names)
        }
        return (
            tidy(df.agg(*aggs), fields).where("outliers > 0")
            .select(
                "column", "outliers", pct(F.col("outliers"), F.col("n")).alias("pct"),
                F.round("lo", 4).alias("lower_bound"), F.round("hi", 4).alias("upper_bound"),
            )
        )

    def modified_cells(self, df: DataFrame) -> DataFrame:
        """Number of cells that clipping changes, over all fitted columns."""
        names = [c for c in self.bounds if c in df.columns]
        changed = [F.count_if(self._outside(df, c)) for c in names]
        total = changed[0] if changed else F.lit(0)
        for c in changed[1:]:
            total = total + c
        return df.agg(total.cast("long").alias("modified"))

    def _outside(self, df: DataFrame, name: str):
        lo, hi = self.bounds[name]
        x = clean_double(df, name)
        below = (x < F.lit(lo)) if lo is not None else F.lit(False)
        above = (x > F.lit(hi)) if hi is not None else F.lit(False)
        return below | above

    def to_dict(self) -> dict:
        return asdict(self)


@dataclass(frozen=True)
class Outliers:
    """``detection`` is 'iqr', 'zscore' or both; both intersect their bounds."""

    detection: str | Sequence[str] = ("iqr",)
    treatment: str = "winsorization"
    iqr_threshold: float = 1.5
    zscore_threshold: float = 3.0
    cols: Sequence[str] = field(default_factory=tuple)
    exact: bool = True

    def fit(self, df: DataFrame) -> OutlierModel:
        rules = {self.detection} if isinstance(self.detection, str) else set(self.detection)
        names = list(self.cols) if self.cols else numeric_columns(df)
        absent = [c for c in names if c not in df.columns]
        if absent:
            raise ValueError(f"columns not in the frame: {absent}")
        quart = quantiles(df, names, [0.25, 0.75], self.exact) if "iqr" in rules else {}
        moments = {}
        if "zscore" in rules and names:
            row = df.agg(
                *[F.avg(clean_double(df, c)).alias(f"m{i}") for i, c in enumerate(names)],
                *[F.stddev_samp(clean_double(df, c)).alias(f"s{i}") for i, c in enumerate(names)],
            ).first()
            moments = {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(names)}
        bounds = {}
        for c in names:
            lows, highs = [], []
            if c in quart and quart[c][0] is not None:
                q1, q3 = quart[c]
                lows.append(q1 - self.iqr_threshold * (q3 - q1))
                highs.append(q3 + self.iqr_threshold * (q3 - q1))
            if c in moments and None not in moments[c]:
                mean, std = moments[c]
                lows.append(mean - self.zscore_threshold * std)
                highs.append(mean + self.zscore_threshold * std)
            bounds[c] = (max(lows, default=None), min(highs, default=None))
        return OutlierModel(bounds, self.treatment)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

"""Scaling, category encoding and label encoding: literal expressions for few values, joined codes for many."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.kinds import categorical_columns, clean_double, col, numeric_columns
from .dictionary import Dictionary

MAX_LITERAL_CODES = 200  # values of a column that are compared as literals; more are joined


def _as_text(df: DataFrame, name: str) -> Column:
    """Category text; booleans read True / False."""
    if isinstance(df.schema[name].dataType, T.BooleanType):
        return F.initcap(col(name).cast("string"))
    return col(name).cast("string")


def _cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("c"), _as_text(df, c).alias("v")) for c in columns])
    return df.select(F.explode(cells).alias("r")).select("r.*").distinct()


def discover_categories(df: DataFrame, columns: Sequence[str], limit: int | None = None) -> dict[str, list[str | None]]:
    """Sorted distinct values per column, NULL last, found in one job and listed on the driver.

    Stops with an error past ``limit`` values of a column, if one is given; nothing larger is collected.
    """
    if not columns:
        return {}
    pairs = _cells(df, columns)
    found: dict[str, list] = {c: [] for c in columns}
    for r in (pairs if limit is None else pairs.limit(limit * len(columns) + 1)).collect():
        found[r["c"]].append(r["v"])
    for c, values in found.items():
        if limit is not None and len(values) > limit:
            raise ValueError(f"column {c!r} has more than {limit} categories")
    return {c: sorted(v, key=lambda x: (x is None, x or "")) for c, v in found.items()}


def _wide_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with more values than are compared as literals."""
    if not columns:
        return []
    sizes = _cells(df, columns).groupBy("c").count().where(F.col("count") > MAX_LITERAL_CODES).collect()
    wide = {r["c"] for r in sizes}
    return [c for c in columns if c in wide]


@dataclass(frozen=True)
class EncoderModel:
    """Scaled numeric block followed by the encoded categorical block."""

    scale: dict[str, tuple[float, float]]  # column -> (shift, divisor)
    categories: dict[str, list[str | None]]
    cat_strategy: str = "ohe"
    codes: Dictionary | None = None  # ordinal columns of many values

    @property
    def output_columns(self) -> list[str]:
        out = list(self.scale)
        for c, values in self.categories.items():
            out += [_hot_name(c, v) for v in values[1:]] if self.cat_strategy == "ohe" else [c]
        return out

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        cols = [col(k) for k in keep]
        coded = {c: f"__code_{c}" for c in (self.codes.sizes if self.codes else ())}
        base = df
        for c, name in coded.items():
            df = self.codes.encode(df, c, _as_text(base, c), name)
        for c, (shift, divisor) in self.scale.items():
            x = clean_double(df, c)
            if (shift, divisor) != (0.0, 1.0):
                x = (x - F.lit(shift)) / F.lit(divisor)
            cols.append(x.alias(c))
        for c, values in self.categories.items():
            text = _as_text(df, c)
            if self.cat_strategy == "ohe":
                cols += [text.eqNullSafe(F.lit(v)).cast("double").alias(_hot_name(c, v)) for v in values[1:]]
            elif c in coded:
                cols.append(F.when(text.isNotNull(), F.coalesce(col(coded[c]), F.lit(-1.0))).alias(c))
            else:
                known = [F.lit(v) for v in values if v is not None]
                place = F.array_position(F.array(*known), text) - 1 if known else F.lit(-1)
                cols.append(F.when(text.isNotNull(), place.cast("double")).alias(c))
        return df.select(*cols)

    def to_dict(self) -> dict:
        if self.codes is not None:
            raise ValueError("codes of many values are a table, which no dict describes")
        return {"scale": dict(self.scale), "categories": dict(self.categories), "cat_strategy": self.cat_strategy}


def _hot_name(column: str, value: str | None) -> str:
    return f"{column}_{'nan' if value is None else value}"


@dataclass(frozen=True)
class Encoder:
    """``num_strategy``: standard, minmax or none. ``cat_strategy``: ohe or ordinal.

    Ordinal codes have no limit. One-hot columns are as many as the categories; ``max_categories`` stops them, if given.
    """

    num_strategy: str = "standard"
    cat_strategy: str = "ohe"
    max_categories: int | None = None

    def fit(self, df: DataFrame, exclude: Sequence[str] = ()) -> EncoderModel:
        nums = numeric_columns(df, exclude)
        scale = {c: (0.0, 1.0) for c in nums}
        if nums and self.num_strategy in ("standard", "minmax"):
            standard = self.num_strategy == "standard"
            aggs = []
            for i, c in enumerate(nums):
                x = clean_double(df, c)
                aggs.append((F.avg(x) if standard else F.min(x)).alias(f"a{i}"))
                aggs.append((F.stddev_pop(x) if standard else F.max(x) - F.min(x)).alias(f"b{i}"))
            row = df.agg(*aggs).first()
            for i, c in enumerate(nums):
                shift, width = row[f"a{i}"], row[f"b{i}"]
                scale[c] = (shift if shift is not None else 0.0, width if width else 1.0)
        cats = categorical_columns(df, exclude)
        wide = _wide_columns(df, cats) if self.cat_strategy == "ordinal" else []
        found = discover_categories(df, [c for c in cats if c not in wide], self.max_categories)
        codes = Dictionary.fit(df, {c: _as_text(df, c) for c in wide}) if wide else None
        return EncoderModel(scale, {c: found.get(c, []) for c in cats}, self.cat_strategy, codes)

    def fit_transform(self, df: DataFrame, exclude: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
        return self.fit(df, exclude).transform(df, keep)


@dataclass(frozen=True)
class LabelModel:
    """Sorted classes as a list, or as a table if they are many."""

    classes: list = field(default_factory=list)
    codes: Dictionary | None = None

    def encode(self, df: DataFrame, target: str, output: str = "label") -> DataFrame:
        if self.codes is not None:
            df, place = self.codes.encode(df, "label", col(target), "__place"), F.col("__place")
        else:
            at = F.array_position(F.array(*[F.lit(c) for c in self.classes]), col(target))
            place = F.when(at > 0, at - 1)
        unseen = F.raise_error(F.concat(F.lit("label not seen at fit: "), col(target).cast("string")))
        code = F.when(col(target).isNull(), F.lit(None)).when(place.isNotNull(), place).otherwise(unseen)
        return df.withColumn(output, code.cast("double")).drop("__place")

    def decode(self, df: DataFrame, code: str, output: str) -> DataFrame:
        if self.codes is not None:
            return self.codes.decode(df, "label", col(code), output)
        names = F.array(*[F.lit(c) for c in self.classes])
        return df.withColumn(output, F.try_element_at(names, col(code).cast("int") + 1))


class LabelEncoder:
    @staticmethod
    def fit(df: DataFrame, target: str) -> LabelModel:
        present = df.select(col(target).alias("v")).where("v IS NOT NULL")
        values = present.distinct().limit(MAX_LITERAL_CODES + 1).collect()
        if len(values) > MAX_LITERAL_CODES:
            return LabelModel([], Dictionary.fit(present, {"label": F.col("v")}))
        return LabelModel(sorted(r[0] for r in values))

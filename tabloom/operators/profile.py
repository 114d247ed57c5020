"""Profiling reports as tidy frames: one row per column, value, pair or class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.kinds import categorical_columns, clean_double, col, numeric_columns
from ..functions.stats import half_even, pct, tidy
from .correlate import correlations
from .quantiles import quantiles


MAX_TARGET_VALUES = 10_000  # what a report on the driver may hold


def _missing(df: DataFrame, name: str) -> Column:
    c = col(name)
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[int, dict[str, int]]:
    """Row count and missing cells per column, in one pass."""
    names = df.columns if columns is None else list(columns)
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(_missing(df, c)).alias(f"m{i}") for i, c in enumerate(names)],
    ).first()
    return row["n"], {c: row[f"m{i}"] for i, c in enumerate(names)}


def missing_report(df: DataFrame) -> DataFrame:
    """Columns with at least one missing cell: count and percentage."""
    wide = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(_missing(df, c)).alias(f"m{i}") for i, c in enumerate(df.columns)],
    )
    rows = tidy(wide, {c: {"count": f"m{i}", "n": "n"} for i, c in enumerate(df.columns)})
    return rows.where("count > 0").select("column", "count", pct(F.col("count"), F.col("n")).alias("pct"))


def drop_sparse(df: DataFrame, threshold: float) -> DataFrame:
    """Keep a column only if enough of its cells are present."""
    total, missing = missing_counts(df)
    needed = int((1 - threshold) * total)
    return df.select(*[col(c) for c in df.columns if total - missing[c] >= needed])


def info(df: DataFrame, target: str) -> dict:
    """Shape, column kinds and target distribution.

    ``target_counts`` is a frame whatever the number of values; ``target_distribution`` the same as a dict, None if
    the driver would have to hold more than its bound.
    """
    found = value_counts(df, target)
    present = found.where("value IS NOT NULL")
    listed = present.limit(MAX_TARGET_VALUES + 1).collect()
    counts = {r["value"]: r["count"] for r in listed} if len(listed) <= MAX_TARGET_VALUES else None
    total = df.count()
    return {
        "rows": total,
        "columns": len(df.columns),
        "features": len(df.columns) - 1,
        "numerical": numeric_columns(df, [target]),
        "categorical": categorical_columns(df, [target]),
        "target": target,
        "target_distribution": counts,
        "target_counts": present,
    }


def numeric_summary(
    df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True, digits: int = 4
) -> DataFrame:
    """count, mean, std, min, quartiles and max per numeric column."""
    names = numeric_columns(df) if columns is None else list(columns)
    if not names:
        return df.sparkSession.createDataFrame(
            [], "column string, count long, mean double, std double, min double, "
            "q25 double, q50 double, q75 double, max double"
        )
    cuts = quantiles(df, names, [0.25, 0.5, 0.75], exact)
    aggs = []
    for i, c in enumerate(names):
        x = clean_double(df, c)
        aggs += [
            F.count(x).alias(f"count{i}"),
            F.avg(x).alias(f"mean{i}"),
            F.stddev_samp(x).alias(f"std{i}"),
            F.min(x).alias(f"min{i}"),
            F.max(x).alias(f"max{i}"),
            *[F.lit(v).cast("double").alias(f"q{q}{i}") for q, v in zip((25, 50, 75), cuts[c])],
        ]
    fields = ("count", "mean", "std", "min", "q25", "q50", "q75", "max")
    rows = tidy(df.agg(*aggs), {c: {f: f"{f}{i}" for f in fields} for i, c in enumerate(names)})
    rounded = [F.round(f, digits).alias(f) for f in fields[1:]]
    return rows.select("column", "count", *rounded)


def value_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, count) of every distinct non-null value, combined before the shuffle."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in columns]
    )
    return (
        df.select(F.explode(cells).alias("r")).select("r.*").where("value IS NOT NULL")
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    )


def categorical_summary(
    df: DataFrame, columns: Sequence[str] | None = None, top: int = 5
) -> DataFrame:
    """Distinct count and most frequent values per categorical column.

    Equal frequencies are ordered by value.
    """
    names = categorical_columns(df) if columns is None else list(columns)
    counted = value_table(df, names)
    distinct = counted.groupBy("column").agg(F.count(F.lit(1)).alias("unique"))
    order = Window.partitionBy("column").orderBy(F.desc("count"), F.asc("value"))
    best = counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(F.broadcast(distinct), "column").select("column", "unique", "rank", "value", "count")


def summary(df: DataFrame) -> dict:
    """Numeric and categorical summaries as nested dicts."""
    out = {}
    if numeric_columns(df):
        out["numerical"] = {
            r["column"]: {k: v for k, v in r.asDict().items() if k != "column"}
            for r in numeric_summary(df).collect()
        }
    if categorical_columns(df):
        cats: dict = {c: {"unique": 0, "top_5": {}} for c in categorical_columns(df)}
        for r in categorical_summary(df).orderBy("column", "rank").collect():
            cats[r["column"]]["unique"] = r["unique"]
            cats[r["column"]]["top_5"][r["value"]] = r["count"]
        out["categorical"] = cats
    return out


def value_counts(df: DataFrame, column: str, by_value: bool = False) -> DataFrame:
    """Frequency table, most frequent first or in value order."""
    counted = df.groupBy(col(column).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy("value") if by_value else counted.orderBy(F.desc("count"), "value")


def class_balance(df: DataFrame, target: str) -> DataFrame:
    """Count and share per class. Unlabelled rows count in the denominator only."""
    counted = df.groupBy(col(target).alias("class")).agg(F.count(F.lit(1)).alias("count"))
    total = counted.agg(F.sum("count")).scalar()
    return (
        counted.where("class IS NOT NULL")
        .select("class", "count", pct(F.col("count"), total).alias("pct"))
        .orderBy(F.desc("count"), "class")
    )


def correlation(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 4) -> DataFrame:
    """Pairwise-complete Pearson matrix in long form, empty below two columns."""
    names = numeric_columns(df) if columns is None else list(columns)
    spark = df.sparkSession
    schema = "column string, other string, r double"
    if len(names) < 2:
        return spark.createDataFrame([], schema)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    values = correlations(df, pairs)
    rows = []
    for (a, b), r in values.items():
        rows.append((a, b, r))
        if a != b:
            rows.append((b, a, r))
    return spark.createDataFrame(rows, schema).withColumn("r", F.round("r", digits))


def target_correlation(
    df: DataFrame, target: str, columns: Sequence[str] | None = None, digits: int = 4
) -> DataFrame:
    """Features ranked by absolute correlation with the target, undefined ones last."""
    names = [c for c in (columns or numeric_columns(df)) if c != target]
    values = correlations(df, [(c, target) for c in names])
    frame = df.sparkSession.createDataFrame(
        [(c, values[(c, target)]) for c in names], "column string, r double"
    )
    strength = F.coalesce(F.abs("r"), F.lit(0.0))
    return frame.withColumn("r", F.round("r", digits)).orderBy(strength.desc(), "column")


def spread(df: DataFrame, column: str, digits: int = 2) -> DataFrame:
    """Mean, minimum and maximum of one column."""
    x = clean_double(df, column)
    return df.agg(
        half_even(F.avg(x), digits).alias("mean"),
        half_even(F.min(x), digits).alias("min"),
        half_even(F.max(x), digits).alias("max"),
    )


def modes(df: DataFrame, columns: Sequence[str]) -> dict:
    """Most frequent non-missing value per column; the smallest one among equals.

    Counts distinct values with partial aggregation, so no task holds them all.
    """
    kinds: dict[str, list[str]] = {}
    for c in columns:
        kinds.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    out = dict.fromkeys(columns)
    for names in kinds.values():
        values = {c: F.when(~_missing(df, c), col(c)) for c in names}
        cells = F.array(
            *[F.struct(F.lit(i).alias("i"), values[c].alias("value")) for i, c in enumerate(names)]
        )
        best = (
            df.select(F.explode(cells).alias("r")).select("r.*").where("value IS NOT NULL")
            .groupBy("i", "value").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("i").agg(F.min(F.struct(-F.col("n"), F.col("value"))).alias("best"))
        )
        for r in best.collect():
            out[names[r["i"]]] = r["best"]["value"]
    return out

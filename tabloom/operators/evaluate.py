"""Scores from a counted confusion table: rows are aggregated once, metrics follow."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.kinds import col

# Candidate decision thresholds 0.30 .. 0.70.
DEFAULT_THRESHOLDS = tuple(float(t) for t in np.arange(0.30, 0.71, 0.01))
#: Scores of a search that are taken from the counts of a class report, and its rows that are not classes.
COUNTED_SCORES = (
    "balanced_accuracy", "f1_macro", "f1_micro", "precision_macro", "precision_micro", "precision_weighted",
    "recall_macro", "recall_micro", "recall_weighted",
)
SUMMARIES = ("accuracy", "macro avg", "weighted avg")
THRESHOLD_METRICS = ("f1", "f1_weighted", "accuracy", "recall", "precision")


def _div(a: Column, b: Column) -> Column:
    """Quotient with 0 for a zero denominator."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _f1(tp: Column, support: Column, predicted: Column) -> Column:
    return _div(2 * tp, support + predicted)


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(col(label).alias("label"), col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("count")
    )


def _per_class(counted: DataFrame) -> DataFrame:
    """class, tp, support, predicted from a confusion table."""
    sides = F.array(
        F.struct(
            F.col("label").cast("string").alias("class"),
            F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(F.lit(0)).alias("tp"),
            F.col("count").alias("support"),
            F.lit(0).cast("long").alias("predicted"),
        ),
        F.struct(
            F.col("prediction").cast("string").alias("class"),
            F.lit(0).cast("long").alias("tp"),
            F.lit(0).cast("long").alias("support"),
            F.col("count").alias("predicted"),
        ),
    )
    same = counted.withColumn("prediction", F.col("prediction").cast(counted.schema["label"].dataType))
    return (
        same.select(F.explode(sides).alias("r")).select("r.*").groupBy("class")
        .agg(F.sum("tp").alias("tp"), F.sum("support").alias("support"), F.sum("predicted").alias("predicted"))
    )


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """precision, recall, f1 and support per class, then accuracy, macro and weighted rows."""
    per = _per_class(confusion(df, label, prediction)).select(
        "class", "tp", "support",
        _div(F.col("tp"), F.col("predicted")).alias("precision"),
        _div(F.col("tp"), F.col("support")).alias("recall"),
        _f1(F.col("tp"), F.col("support"), F.col("predicted")).alias("f1"),
    )
    names = ("precision", "recall", "f1")
    aggs = [F.sum("support").alias("support"), F.sum("tp").alias("tp")]
    for m in names:
        aggs.append(F.avg(m).alias(f"macro_{m}"))
        aggs.append(_div(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(f"weighted_{m}"))
    total = per.agg(*aggs)
    null = F.lit(None).cast("double")
    accuracy = _div(F.col("tp"), F.col("support"))
    rows = F.array(
        F.struct(
            F.lit("accuracy").alias("class"), null.alias("precision"), null.alias("recall"),
            accuracy.alias("f1"), F.col("support"),
        ),
        *[
            F.struct(
                F.lit(f"{kind} avg").alias("class"),
                *[F.col(f"{kind}_{m}").alias(m) for m in names], F.col("support"),
            )
            for kind in ("macro", "weighted")
        ],
    )
    totals = total.select(F.explode(rows).alias("r")).select("r.*")
    return per.select("class", *names, "support").unionByName(totals)


def metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", average: str = "weighted"
) -> DataFrame:
    """One row: accuracy, precision, recall, f1_score.

    With two classes in the labels the positive class is 1, otherwise ``average`` applies.
    """
    per = _per_class(confusion(df, label, prediction)).select(
        "class", "tp", "support",
        _div(F.col("tp"), F.col("predicted")).alias("precision"),
        _div(F.col("tp"), F.col("support")).alias("recall"),
        _f1(F.col("tp"), F.col("support"), F.col("predicted")).alias("f1"),
    )
    positive = F.col("class").isin("1", "1.0")
    aggs = [
        F.count_if(F.col("support") > 0).alias("classes"),
        _div(F.sum("tp"), F.sum("support")).alias("accuracy"),
    ]
    for m in ("precision", "recall", "f1"):
        spread = (
            F.avg(m) if average == "macro"
            else _div(F.sum(F.col(m) * F.col("support")), F.sum("support"))
        )
        aggs.append(spread.alias(f"avg_{m}"))
        aggs.append(F.coalesce(F.max(F.when(positive, F.col(m))), F.lit(0.0)).alias(f"pos_{m}"))
    pick = lambda m: F.when(F.col("classes") == 2, F.col(f"pos_{m}")).otherwise(F.col(f"avg_{m}"))
    return per.agg(*aggs).select(
        "accuracy", pick("precision").alias("precision"), pick("recall").alias("recall"),
        pick("f1").alias("f1_score"),
    )


def score_value(df: DataFrame, scoring: str, label: str = "label", prediction: str = "prediction") -> float:
    """One number in the requested metric, which decisions alone must determine."""
    metric, _, kind = scoring.rpartition("_")
    if scoring == "balanced_accuracy":
        per = class_report(df, label, prediction).where((F.col("support") > 0) & ~F.col("class").isin(*SUMMARIES))
        return per.agg(F.avg("recall")).first()[0]
    if kind in ("macro", "weighted"):
        return class_report(df, label, prediction).where(F.col("class") == f"{kind} avg").first()[metric]
    if kind == "micro":
        scoring = "accuracy"
    if scoring not in ("accuracy", "f1", "precision", "recall"):
        raise ValueError(f"{scoring!r} doesn't follow from decisions")
    row = metrics(df, label, prediction).first()
    return row["f1_score" if scoring == "f1" else scoring]


def fold_accuracy(
    df: DataFrame, fold: str = "fold", label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Mean and population deviation of the per-fold accuracy."""
    hit = (col(label) == col(prediction)).cast("double")
    per_fold = df.groupBy(col(fold).alias("fold")).agg(F.avg(hit).alias("accuracy"))
    return per_fold.agg(
        F.count(F.lit(1)).alias("folds"),
        F.avg("accuracy").alias("mean"),
        F.stddev_pop("accuracy").alias("std"),
    )


def threshold_scan(
    df: DataFrame,
    probability: str = "probability",
    label: str = "label",
    scoring: str = "f1",
    thresholds: Sequence[float] | None = None,
) -> DataFrame:
    """Score of ``probability >= t`` for every threshold, in one pass over the rows.

    Each row is reduced to how many thresholds it reaches; only those counts are shuffled.
    """
    marks = sorted(DEFAULT_THRESHOLDS if thresholds is None else thresholds)
    if not marks:
        raise ValueError("no thresholds to scan")
    metric = scoring if scoring in THRESHOLD_METRICS else "f1"
    p = col(probability).cast("double")
    reached = None
    for t in marks:
        one = (p >= F.lit(t)).cast("int")
        reached = one if reached is None else reached + one
    counted = df.groupBy(
        (col(label) == 1).alias("positive"), F.coalesce(reached, F.lit(0)).alias("reached")
    ).agg(F.count(F.lit(1)).alias("n"))
    steps = F.sequence(F.lit(0), F.lit(len(marks) - 1))
    hit = F.col("reached") > F.col("step")
    pos = F.col("positive")

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0)))

    table = (
        counted.withColumn("step", F.explode(steps)).groupBy("step")
        .agg(
            total(pos & hit).alias("tp"), total(~pos & hit).alias("fp"),
            total(pos & ~hit).alias("fn"), total(~pos & ~hit).alias("tn"),
        )
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    f1 = _div(2 * tp, 2 * tp + fp + fn)
    score = {
        "f1": f1,
        "precision": _div(tp, tp + fp),
        "recall": _div(tp, tp + fn),
        "accuracy": _div(tp + tn, tp + tn + fp + fn),
        "f1_weighted": _div(
            f1 * (tp + fn) + _div(2 * tn, 2 * tn + fp + fn) * (tn + fp), tp + tn + fp + fn
        ),
    }[metric]
    value = F.element_at(F.array(*[F.lit(t) for t in marks]), F.col("step") + 1)
    return table.select(
        F.round(value, 2).alias("threshold"), "tp", "fp", "fn", "tn", F.round(score, 4).alias("score")
    )


def best_threshold(scan: DataFrame) -> tuple[float, float] | None:
    """Highest rounded score; the lowest threshold among equals."""
    row = scan.orderBy(F.desc("score"), F.asc("threshold")).first()
    return None if row is None else (row["threshold"], row["score"])


def leaderboard(
    scores: DataFrame, name: str = "model", base: str = "base", score: str = "score", seq: str = "seq"
) -> DataFrame:
    """Models by descending score, with a flag on the best variant of each base model."""
    order = Window.partitionBy(base).orderBy(F.desc(score), F.asc(seq))
    return scores.withColumn("best_of_base", F.row_number().over(order) == 1).orderBy(F.desc(score), F.asc(seq))

"""Weighted voting over member columns of one frame."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.kinds import col


def weighted_mean(members: Mapping[str, float]) -> Column:
    """Mean of member columns with weights scaled to sum to 1."""
    total = float(sum(members.values()))
    if not members or total <= 0:
        raise ValueError("voting needs members with a positive total weight")
    out = None
    for name, weight in members.items():
        term = col(name).cast("double") * F.lit(weight / total)
        out = term if out is None else out + term
    return out


def soft_vote(probabilities: Mapping[str, float], threshold: float = 0.5) -> Column:
    return (weighted_mean(probabilities) >= F.lit(threshold)).cast("int")


def hard_vote(predictions: Mapping[str, float]) -> Column:
    """Weighted majority; a tie goes to class 1."""
    return (weighted_mean(predictions) >= F.lit(0.5)).cast("int")


def member_weights(
    wanted: list[str], scores: Mapping[str, float], weights: str | Mapping[str, float] = "auto"
) -> tuple[dict[str, float], list[str]]:
    """Weights of the trained members, and the names skipped because they were not trained."""
    found = [m for m in wanted if m in scores]
    skipped = [m for m in wanted if m not in scores]
    if weights == "auto":
        return {m: float(scores[m]) for m in found}, skipped
    return {m: float(weights.get(m, 1.0)) for m in found}, skipped

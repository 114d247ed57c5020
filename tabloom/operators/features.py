"""Fitted feature derivations, and a preset for a passenger-list table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as fn
from ..functions.kinds import clean_double, col
from .impute import GroupMedianImputer, GroupMedianModel
from .lookup import GroupLookup
from .profile import spread, value_counts
from .quantiles import grouped_quantiles


@dataclass(frozen=True)
class TierModel:
    value: str
    group: str
    cuts: GroupLookup

    def transform(self, df: DataFrame, output: str) -> DataFrame:
        """Add the tier of each value among the quantiles of its group."""
        order = [c for c in df.columns if c != output]
        wide = self.cuts.attach(df, col(self.group), "__seen")
        edges = [F.col(n) for n in self.cuts.names]
        index = fn.tier(clean_double(df, self.value), edges, F.col("__seen"))
        return wide.withColumn("__tier", index).select(*[col(c) for c in order], F.col("__tier").alias(output))


@dataclass(frozen=True)
class GroupTiers:
    value: str
    group: str
    probs: Sequence[float] = (0.33, 0.66)

    def fit(self, df: DataFrame) -> TierModel:
        names = [f"__q{i}" for i in range(len(self.probs))]
        table = grouped_quantiles(df, self.group, self.value, list(self.probs), names)
        return TierModel(self.value, self.group, GroupLookup.collect(table))


# Title -> group.
TITLE_GROUPS = {
    "Mr": "Mr", "Miss": "Miss", "Mrs": "Mrs", "Master": "Master",
    "Dr": "Officer", "Rev": "Officer", "Capt": "Officer", "Col": "Officer", "Major": "Officer",
    "Sir": "Noble", "Lady": "Noble", "Don": "Noble", "Dona": "Noble", "Jonkheer": "Noble",
    "Countess": "Noble", "Mme": "Mrs", "Mlle": "Miss", "Ms": "Miss",
}
DEFAULT_TITLE = "Rare"
TITLE_PATTERN = r",\s*([^\.]+)\."
# Age intervals, closed on the right.
AGE_EDGES = (0, 12, 17, 35, 60, 120)
AGE_LABELS = ("Child", "Teen", "Adult", "Middle", "Senior")


def title_group(name_col: str):
    title = fn.extract_group(col(name_col), TITLE_PATTERN)
    return fn.map_values(title, TITLE_GROUPS, DEFAULT_TITLE)


def _family(df: DataFrame) -> DataFrame:
    return df.withColumn("FamilySize", fn.sum_columns(["SibSp", "Parch"], 1)).withColumn(
        "FarePerPerson", fn.ratio(col("Fare"), col("FamilySize"))
    )


@dataclass(frozen=True)
class PassengerModel:
    ages: GroupMedianModel | None
    fares: TierModel
    drop_fare_for: tuple[str, ...] = ()

    def transform(self, df: DataFrame, model_name: str | None = None) -> DataFrame:
        out = df
        if "Name" in out.columns:
            out = out.withColumn("TitleGroup", title_group("Name")).drop("Name")
        if "Age" in out.columns and self.ages is not None:
            out = self.ages.transform(out)
        if "Cabin" in out.columns:
            out = out.withColumns(
                {"CabinKnown": fn.known(col("Cabin")), "CabinDeck": fn.first_char(col("Cabin"))}
            ).drop("Cabin")
        out = _family(out)
        out = out.withColumn("IsAlone", fn.flag(col("FamilySize") == 1))
        if "Age" in out.columns:
            out = out.withColumn("AgeGroup", fn.cut(clean_double(out, "Age"), AGE_EDGES, AGE_LABELS))
        out = self.fares.transform(out, "__fare_tier")
        out = out.withColumn("SocialClass", fn.rank_score(col("Pclass"), col("__fare_tier"))).drop("__fare_tier")
        return out.drop("Fare") if model_name in self.drop_fare_for else out

    def report(self, df: DataFrame) -> DataFrame:
        """Tidy rows (section, value, number): frequencies, medians used, ratio spread."""
        parts = []
        for c in ("TitleGroup", "AgeGroup", "SocialClass", "FamilySize", "IsAlone", "CabinKnown", "CabinDeck"):
            if c in df.columns:
                parts.append(
                    value_counts(df.where(col(c).isNotNull()), c).select(
                        F.lit(c).alias("section"), F.col("value").cast("string").alias("value"),
                        F.col("count").cast("double").alias("number"),
                    )
                )
        if self.ages is not None:
            parts.append(
                self.ages.medians.frame(df.sparkSession).select(
                    F.lit("AgeImputationByTitle").alias("section"), F.col("group").cast("string").alias("value"),
                    F.round("median", 1).alias("number"),
                )
            )
        if "FarePerPerson" in df.columns:
            s = spread(df, "FarePerPerson")
            pairs = F.array(*[F.struct(F.lit(c).alias("value"), F.col(c).alias("number")) for c in s.columns])
            parts.append(
                s.select(F.explode(pairs).alias("r")).select(
                    F.lit("FarePerPerson").alias("section"), "r.value", "r.number"
                )
            )
        return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class PassengerFeatures:
    """Titles, family size, fare per person, age and fare tiers of a passenger list."""

    drop_fare_for: Sequence[str] = field(default_factory=tuple)

    def fit(self, df: DataFrame) -> PassengerModel:
        ages = None
        if "Name" in df.columns and "Age" in df.columns:
            titled = df.withColumn("TitleGroup", title_group("Name"))
            ages = GroupMedianImputer("Age", "TitleGroup").fit(titled)
        fares = GroupTiers("FarePerPerson", "Pclass").fit(_family(df))
        return PassengerModel(ages, fares, tuple(self.drop_fare_for))

    def fit_transform(self, df: DataFrame, model_name: str | None = None) -> DataFrame:
        return self.fit(df).transform(df, model_name)

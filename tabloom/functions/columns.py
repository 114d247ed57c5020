"""Row-level building blocks as native column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .kinds import col

# Fixed value: cells that count as missing, matched in full and case-sensitively.
MISSING_MARKERS = r"^\s*(\?|nan|NaN|N/A|NA|none|None|--)\s*$"

# A literal map is scanned per row, so larger mappings must be joined instead.
MAX_LITERAL_MAP = 200


def marker_to_null(value: Column, pattern: str = MISSING_MARKERS) -> Column:
    return F.when(~value.rlike(pattern), value)


def normalise_markers(df: DataFrame, pattern: str = MISSING_MARKERS) -> DataFrame:
    """Turn marker cells of every string column into NULL."""
    fixes = {
        f.name: marker_to_null(col(f.name), pattern)
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType)
    }
    return df.withColumns(fixes) if fixes else df


def extract_group(value: Column, pattern: str, group: int = 1) -> Column:
    """First match of a regex group, trimmed; NULL when nothing matches."""
    return F.nullif(F.trim(F.regexp_extract(value, pattern, group)), F.lit(""))


def map_values(value: Column, mapping: Mapping, default=None) -> Column:
    """Look a value up in a small mapping; missing and unknown keys get the default. ``map_column`` takes any size."""
    if len(mapping) > MAX_LITERAL_MAP:
        raise ValueError(f"mapping has {len(mapping)} entries; use operators.dictionary.map_column")
    if not mapping:
        return F.lit(default)
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), value)
    return found if default is None else F.coalesce(found, F.lit(default))


def sum_columns(names: Sequence[str], plus: float | int = 0) -> Column:
    total = col(names[0])
    for name in names[1:]:
        total = total + col(name)
    return total + F.lit(plus) if plus else total


def flag(condition: Column) -> Column:
    """0/1 integer; an unknown comparison counts as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def known(value: Column) -> Column:
    return value.isNotNull().cast("int")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, NULL for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def first_char(value: Column, default: str = "U") -> Column:
    return F.coalesce(F.nullif(F.substring(value, 1, 1), F.lit("")), F.lit(default))


def cut(
    value: Column,
    edges: Sequence[float],
    labels: Sequence[str],
    right: bool = True,
    include_lowest: bool = True,
) -> Column:
    """Label of the interval a value falls into; NULL outside all of them."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per interval")
    out = None
    for i, label in enumerate(labels):
        low, high = F.lit(edges[i]), F.lit(edges[i + 1])
        if right:
            first = include_lowest and i == 0
            inside = ((value >= low) if first else (value > low)) & (value <= high)
        else:
            last = include_lowest and i == len(labels) - 1
            inside = (value >= low) & ((value <= high) if last else (value < high))
        out = F.when(inside, F.lit(label)) if out is None else out.when(inside, F.lit(label))
    return out


def clip(value: Column, low: float | None, high: float | None) -> Column:
    """Clamp to bounds. NULL stays NULL: greatest() would replace it by the bound."""
    out = value
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(value.isNotNull(), out)


def tier(value: Column, cuts: Sequence[Column], group_seen: Column, default: int = 1) -> Column:
    """Index of the first cut that is not exceeded; default for NULL or an unseen group."""
    out = F.when(value.isNull() | ~group_seen, F.lit(default))
    for i, edge in enumerate(cuts):
        out = out.when(value <= edge, F.lit(i))
    return out.otherwise(F.lit(len(cuts)))


def rank_score(level: Column, tier_index: Column, tiers: int = 3) -> Column:
    """Combine a 1-based level with a tier: best tier of level 1 is 1."""
    return (level - 1) * tiers + (tiers - 1 - tier_index) + 1

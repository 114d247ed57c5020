from .columns import (
    MISSING_MARKERS,
    clip,
    cut,
    extract_group,
    first_char,
    flag,
    known,
    map_values,
    marker_to_null,
    normalise_markers,
    rank_score,
    ratio,
    sum_columns,
    tier,
)
from .kinds import (
    categorical_columns,
    clean_double,
    col,
    column_kinds,
    features_and_target,
    nan_to_null,
    numeric_columns,
    numeric_then_categorical,
)
from .stats import half_even, pair_corr, pct, tidy

__all__ = [n for n in dir() if not n.startswith("_")]

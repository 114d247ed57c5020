"""Exact order statistics that do not gather a column in one task.

The built-in exact percentile keeps one map entry per distinct value, so a column goes
to it directly only while its counted rows fit a budget. Beyond that a quantile sketch
brackets every wanted rank; values outside the brackets are snapped to one marker per
gap, which keeps their order and leaves the map only the bracketed values. A rank that
lands on a marker was missed by the sketch and is bracketed again, so the result is
exact whatever the sketch did. Brackets still too wide for the budget are first
narrowed by counting. Every pass is a partial aggregate over the scan: no row is
shuffled and no value is lost.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.kinds import clean_double, col
from ..session import checkpointed

INLINE_VALUES = 200_000  # map entries one job may hold in exact percentiles
MAX_SENT_BRACKETS = 10_000  # rows of a bracket table that is sent to all executors
_ACCURACY = 10_000
_MARGIN = 2.0 / _ACCURACY
_GRID = 512
_SLOTS_PER_JOB = 64
_GROUP_GRID, _GROUP_ACCURACY = 256, 2_000  # cells and accuracy of the sketches of one round over groups
CROWDED = 200_000  # rows of a group beyond which it is dealt over keys, where brackets are too many to be sent
_SALTS = 64  # these keys


@dataclass
class Slot:
    """One searched column: a double expression, NULL where it does not apply."""

    value: Column
    ranks: list[int] = field(default_factory=list)
    count: int | None = None
    found: dict[int, float] = field(default_factory=dict)


@dataclass
class _Bracket:
    """A rank believed to lie in [low, high], inside an interval with known counts."""

    slot: int
    rank: int
    low: float
    high: float
    size: float  # expected number of values strictly inside
    floor: float = -math.inf  # known: `before` values are <= floor or outside the search
    ceil: float = math.inf
    before: int = 0
    margin: float = _MARGIN


def _lit(x: float) -> Column:
    return F.lit(float(x))


def _chunked(items: list, size: int = _SLOTS_PER_JOB):
    return (items[i : i + size] for i in range(0, len(items), size))


def order_statistics(
    df: DataFrame,
    slots: list[Slot],
    probs: Sequence[float] | None = None,
    inline: int | None = None,
) -> list[Slot]:
    """Fill ``found`` (0-based rank -> value) of every slot.

    Give either ``probs``, or slots that already carry their ranks and counts.
    """
    budget = INLINE_VALUES if inline is None else inline
    base = df.select(*[s.value.alias(f"s{i}") for i, s in enumerate(slots)])
    guesses: list[_Bracket] = []
    for part in _chunked(list(range(len(slots)))):
        if probs is None and sum(slots[i].count for i in part) <= budget:
            continue
        guesses += _first_pass(base, slots, part, probs)
    direct = []
    for i, s in enumerate(slots):
        if s.count and s.ranks:
            direct.append(i)
    if sum(slots[i].count for i in direct) <= budget:
        for part in _chunked(direct):
            _finish(base, slots, {i: None for i in part}, [])
        return slots
    while guesses:
        wide = sum(g.size for g in guesses) > budget
        if wide:
            small = [g for g in guesses if g.size <= max(1, budget // (2 * len(guesses)))]
            big = [g for g in guesses if g not in small]
            guesses = small + [b for part in _chunked(big, 16) for b in _zoom(base, slots, part)]
            if any(g.size > max(1, budget // (2 * len(guesses))) for g in guesses):
                continue
        missed: list[_Bracket] = []
        by_slot: dict[int, list[_Bracket]] = {}
        for g in guesses:
            by_slot.setdefault(g.slot, []).append(g)
        for part in _chunked(sorted(by_slot)):
            missed += _finish(base, slots, {i: by_slot[i] for i in part}, [])
        guesses = [b for part in _chunked(missed, 16) for b in _widen(base, slots, part)]
    return slots


def _first_pass(base, slots, part, probs) -> list[_Bracket]:
    """Count the slots and bracket each rank with one sketch per slot."""
    asked, aggs = {}, []
    for i in part:
        s = slots[i]
        if probs is not None:
            centres = list(probs)
            aggs.append(F.count(f"s{i}").alias(f"n{i}"))
        else:
            centres = [(r + 0.5) / s.count for r in s.ranks] if s.count else []
        asked[i] = [min(1.0, max(0.0, c + d)) for c in centres for d in (-_MARGIN, _MARGIN)]
        if asked[i]:
            aggs.append(F.percentile_approx(f"s{i}", asked[i], _ACCURACY).alias(f"g{i}"))
    row = base.agg(*aggs).first()
    out = []
    for i in part:
        s = slots[i]
        if probs is not None:
            s.count = row[f"n{i}"]
            s.ranks = sorted(set(_ranks(s.count, probs)))
        if not s.count:
            continue
        grid = row[f"g{i}"]
        for rank in s.ranks:
            at = (rank + 0.5) / s.count
            low = max((v for q, v in zip(asked[i], grid) if q <= at - _MARGIN / 2), default=-math.inf)
            high = min((v for q, v in zip(asked[i], grid) if q >= at + _MARGIN / 2), default=math.inf)
            if at <= _MARGIN * 2:
                low = -math.inf
            if at >= 1 - _MARGIN * 2:
                high = math.inf
            out.append(_Bracket(i, rank, low, high, 4 * _MARGIN * s.count))
    return out


def _finish(base, slots, brackets: dict[int, list[_Bracket] | None], missed) -> list[_Bracket]:
    """Read the wanted ranks off the exact percentile of the snapped values."""
    cols, aggs, gaps = [], [], {}
    for i, items in brackets.items():
        s = slots[i]
        ranks = s.ranks if items is None else sorted({b.rank for b in items})
        fractions = ",".join(f"{(r + 0.5) / s.count!r}D" for r in ranks)
        value, gaps[i] = (F.col(f"s{i}"), {}) if items is None else _snap(F.col(f"s{i}"), items)
        cols.append(value.alias(f"v{i}"))
        aggs.append(
            F.expr(f"percentile_disc(array({fractions})) WITHIN GROUP (ORDER BY v{i})").alias(f"p{i}")
        )
        gaps[i]["ranks"] = ranks
    row = base.select(*cols).agg(*aggs).first()
    for i, items in brackets.items():
        lookup = {b.rank: b for b in items or []}
        for rank, value in zip(gaps[i]["ranks"], row[f"p{i}"]):
            if value in gaps[i]:
                missed.append(lookup[rank])
            else:
                slots[i].found[rank] = value
    return missed


def _snap(v: Column, items: list[_Bracket]) -> tuple[Column, dict]:
    """Keep bracketed values, send each gap between brackets to one value inside it."""
    merged: list[list[float]] = []
    for low, high in sorted((b.low, b.high) for b in items):
        if merged and low <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], high)
        else:
            merged.append([low, high])
    out, gaps, previous = None, {}, -math.inf
    for low, high in merged:
        if low > -math.inf:
            if previous == -math.inf and out is None:
                marker = math.nextafter(low, -math.inf)
            else:
                marker = previous + (low - previous) / 2
            if previous < marker < low:
                gaps[marker] = True
                here = v < _lit(low)
                out = F.when(here, _lit(marker)) if out is None else out.when(here, _lit(marker))
        here = v <= _lit(high)
        out = F.when(here, v) if out is None else out.when(here, v)
        previous = high
    if previous < math.inf:
        marker = math.nextafter(previous, math.inf)
        gaps[marker] = True
        out = out.when(v > _lit(previous), _lit(marker))
    return out, gaps


def _zoom(base, slots, part: list[_Bracket]) -> list[_Bracket]:
    """Count around each bracket and sketch its open interior."""
    aggs = []
    for j, b in enumerate(part):
        v = F.col(f"s{b.slot}")
        known = (v > _lit(b.floor)) if b.floor > -math.inf else v.isNotNull()
        inner = (v > _lit(b.low)) & (v < _lit(b.high))
        aggs += [
            F.count_if(known & (v < _lit(b.low))).alias(f"b{j}"),
            F.count_if(v == _lit(b.low)).alias(f"l{j}"),
            F.count_if(inner).alias(f"m{j}"),
            F.count_if(v == _lit(b.high)).alias(f"h{j}"),
            F.percentile_approx(
                F.when(inner, v), [k / _GRID for k in range(_GRID + 1)], _ACCURACY
            ).alias(f"g{j}"),
        ]
    row = base.agg(*aggs).first()
    out = []
    for j, b in enumerate(part):
        below, at_low, mid, at_high = (row[f"{x}{j}"] for x in "blmh")
        if b.low == b.high:
            at_high = 0
        at = b.rank - b.before
        if at < below or at >= below + at_low + mid + at_high:
            out += _widen(base, slots, [b])
        elif at < below + at_low:
            slots[b.slot].found[b.rank] = b.low
        elif at >= below + at_low + mid:
            slots[b.slot].found[b.rank] = b.high
        else:
            before = b.before + below + at_low
            grid = row[f"g{j}"]
            k = int((b.rank - before + 0.5) / mid * _GRID)
            low = grid[k - 1] if k >= 2 else b.low
            high = grid[k + 2] if k + 2 < _GRID else b.high
            # An open end keeps its bound outside: those values are already counted.
            low = math.nextafter(b.low, math.inf) if low == b.low else low
            high = math.nextafter(b.high, -math.inf) if high == b.high else high
            size = 0 if low >= high else mid * 4 / _GRID
            out.append(_Bracket(b.slot, b.rank, low, high, size, b.low, b.high, before))
    return out


def _widen(base, slots, part: list[_Bracket]) -> list[_Bracket]:
    """Bracket missed ranks again over the whole slot with a wider margin."""
    out = []
    for b in part:
        margin = b.margin * 8
        n = slots[b.slot].count
        at = (b.rank + 0.5) / n
        low, high = base.agg(
            F.percentile_approx(
                f"s{b.slot}", [max(0.0, at - margin), min(1.0, at + margin)], _ACCURACY
            ).alias("g")
        ).first()["g"]
        low = -math.inf if at - margin <= 0 else low
        high = math.inf if at + margin >= 1 else high
        out.append(_Bracket(b.slot, b.rank, low, high, 3 * margin * n, margin=margin))
    return out


def _ranks(count: int, probs: Sequence[float]) -> list[int]:
    out = []
    for p in probs:
        h = (count - 1) * p
        out += [math.floor(h), math.ceil(h)]
    return out if count else []


def _interpolate(slot: Slot, p: float) -> float | None:
    if not slot.count:
        return None
    h = (slot.count - 1) * p
    k = math.floor(h)
    low, high = slot.found[k], slot.found[math.ceil(h)]
    return low if low == high else low + (high - low) * (h - k)


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], inline: int | None = None
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of each column's non-missing values."""
    slots = [Slot(clean_double(df, c)) for c in columns]
    order_statistics(df, slots, probs, inline)
    return {c: [_interpolate(s, p) for p in probs] for c, s in zip(columns, slots)}


def approximate_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], accuracy: int = _ACCURACY
) -> dict[str, list[float | None]]:
    """Sketch-based quantiles in one pass."""
    row = df.agg(
        *[
            F.percentile_approx(clean_double(df, c), list(probs), accuracy).alias(f"q{i}")
            for i, c in enumerate(columns)
        ]
    ).first()
    return {c: list(row[f"q{i}"] or [None] * len(probs)) for i, c in enumerate(columns)}


def quantiles(df, columns, probs, exact: bool = True) -> dict[str, list[float | None]]:
    if not columns:
        return {}
    return exact_quantiles(df, columns, probs) if exact else approximate_quantiles(df, columns, probs)


def grouped_quantiles(
    df: DataFrame,
    group: str,
    value: str,
    probs: Sequence[float],
    names: Sequence[str],
    inline: int | None = None,
) -> DataFrame:
    """One row per non-null group: its exact quantiles; NULL for an all-missing group.

    Groups beyond the inline bound, however many, are narrowed together: their brackets
    are rows of a table. No group is gathered or sorted in one task.
    """
    budget = INLINE_VALUES if inline is None else inline
    rows = df.select(col(group).alias("g"), clean_double(df, value).alias("x")).where("g IS NOT NULL")
    hot = checkpointed(rows.groupBy("g").agg(F.count("x").alias("n")).where(F.col("n") > budget))
    n_hot = hot.count()
    rest = _with_groups(rows, hot, n_hot, "left_anti") if n_hot else rows
    small = rest.groupBy("g").agg(F.percentile("x", F.array(*[F.lit(float(p)) for p in probs])).alias("q"))
    if n_hot:
        small = small.unionByName(_searched_quantiles(rows, hot, probs, budget))
    return small.select(F.col("g").alias(group), *[F.col("q")[i].alias(n) for i, n in enumerate(names)])


def _searched_quantiles(rows: DataFrame, hot: DataFrame, probs: Sequence[float], budget: int) -> DataFrame:
    at = [(F.col("n") - 1) * F.lit(float(p)) for p in probs]
    ends = F.array_distinct(F.array(*[f(h) for h in at for f in (F.floor, F.ceil)]))
    found = group_order_statistics(rows, hot.select("g", "n", F.explode(ends).alias("rank")), budget)
    by_rank = F.map_from_entries(F.collect_list(F.struct("rank", "value")))
    wide = found.groupBy("g", "n").agg(by_rank.alias("v"))

    def between(h: Column) -> Column:
        low, high = F.try_element_at("v", F.floor(h)), F.try_element_at("v", F.ceil(h))
        return F.when(low == high, low).otherwise(low + (high - low) * (h - F.floor(h)))

    return wide.select("g", F.array(*[between(h) for h in at]).alias("q"))


def _with_groups(rows: DataFrame, table: DataFrame, size: int, how: str = "inner") -> DataFrame:
    """Rows joined by group with a table (g, n, ...) of counted size: sent out if small, else crowded groups are dealt over several keys."""
    if size <= MAX_SENT_BRACKETS:
        return rows.join(F.broadcast(table), "g", how)
    many = F.col("n") > CROWDED
    crowded = table.where(many).select("g").distinct().withColumn("__many", F.lit(True))  # as many as the rows allow, at most
    dealt = rows.join(F.broadcast(crowded), "g", "left").withColumn(
        "__salt", F.when(F.col("__many"), F.pmod(F.monotonically_increasing_id(), F.lit(_SALTS))).otherwise(F.lit(0)).cast("int")).drop("__many")
    keys = F.when(many, F.expr(f"sequence(0, {_SALTS - 1})")).otherwise(F.array(F.lit(0)))
    return dealt.join(table.withColumn("__salt", F.explode(keys)), ["g", "__salt"], how).drop("__salt")


def group_order_statistics(rows: DataFrame, wanted: DataFrame, inline: int | None = None) -> DataFrame:
    """(g, n, rank, value): the 0-based ranks of ``wanted`` (g, n, rank) among the non-null ``x`` of ``rows`` (g, x).

    A bracket is a row (low, high, whether each end is left out, values below, values inside) that surely holds its
    rank. Each round sketches the inside of all open brackets, guesses a narrower one, counts around the guess and
    keeps the part that holds the rank; each such part is smaller. Brackets of one value or within the budget are done.
    """
    budget = INLINE_VALUES if inline is None else inline
    rows = rows.where("x IS NOT NULL").select("g", "x")
    known = ["g", "n", "rank", "low", "high", "low_out", "high_out", "before", "inside"]
    start = {"low": F.lit(-math.inf), "high": F.lit(math.inf), "low_out": F.lit(False), "high_out": F.lit(False),
             "before": F.lit(0).cast("long"), "inside": F.col("n")}
    brackets = checkpointed(wanted.withColumns(start).select(*known))
    x, low, high = F.col("x"), F.col("low"), F.col("high")
    within = ((x > low) | ((x == low) & ~F.col("low_out"))) & ((x < high) | ((x == high) & ~F.col("high_out")))
    is_open = (low < high) & (F.col("inside") > budget)
    while n_open := brackets.where(is_open).count():
        inside = _with_groups(rows, brackets.where(is_open), n_open).where(within)
        grid = [k / _GROUP_GRID for k in range(_GROUP_GRID + 1)]
        # a bracket's columns follow from its group and rank: grouping by all of them saves a join, and grids stay where they are made
        sketched = inside.groupBy(*known).agg(F.percentile_approx("x", grid, _GROUP_ACCURACY).alias("grid"))
        place = F.floor((F.col("rank") - F.col("before") + 0.5) / F.col("inside") * _GROUP_GRID).cast("int")
        left = F.get("grid", F.greatest(place - 1, F.lit(0)))
        right = F.get("grid", F.least(place + 2, F.lit(_GROUP_GRID)))
        middle, same = F.get("grid", place), (left <= low) & (right >= high)
        guesses = checkpointed(sketched.select(
            *known, F.when(same, middle).otherwise(left).alias("p"), F.when(same, middle).otherwise(right).alias("q")))
        counted = _with_groups(rows, guesses, n_open).where(within).groupBy(*known, "p", "q").agg(
            F.count_if(x < F.col("p")).alias("a"), F.count_if((x >= F.col("p")) & (x <= F.col("q"))).alias("b"))
        at = F.col("rank") - F.col("before")
        under, over = at < F.col("a"), at >= F.col("a") + F.col("b")

        def part(below, here, above):
            return F.when(under, below).when(over, above).otherwise(here)

        narrowed = counted.select(
            "g", "n", "rank", part(low, F.col("p"), F.col("q")).alias("low"), part(F.col("p"), F.col("q"), high).alias("high"),
            part(F.col("low_out"), F.lit(False), F.lit(True)).alias("low_out"),
            part(F.lit(True), F.lit(False), F.col("high_out")).alias("high_out"),
            (F.col("before") + part(F.lit(0), F.col("a"), F.col("a") + F.col("b"))).alias("before"),
            part(F.col("a"), F.col("b"), F.col("inside") - F.col("a") - F.col("b")).alias("inside"),
        )
        brackets = checkpointed(brackets.where(~is_open).unionByName(narrowed))
    sure = brackets.where(low == high).select("g", "n", "rank", low.alias("value"))
    loose = brackets.where(low < high)
    n_loose = loose.count()
    if not n_loose:
        return sure
    values = _with_groups(rows, loose, n_loose).where(within).groupBy("g", "n", "rank", "before").agg(
        F.array_sort(F.collect_list("x")).alias("xs"))
    return sure.unionByName(values.select("g", "n", "rank", F.get("xs", (F.col("rank") - F.col("before")).cast("int")).alias("value")))

"""Exact stratified splits and folds.

Fitting finds, per class, the key at which each part ends; applying compares a row's
key with those ends, so a row keeps its part however the frame is partitioned. A few
classes with numeric keys compile to a row-level expression. Many classes, ids that are
ordered as text and ids that repeat where a part ends take a table of ends: rows are
counted over ranges of (class, key, id, row), and only ranges in which a part ends are
read closely. Rows of one id may part; rows equal in every column stay together, in the
part of the first of them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.kinds import col
from ..session import checkpointed
from .dictionary import COMMON, MAX_SENT_BYTES, look_up
from .quantiles import Slot, order_statistics

MAX_LITERAL_CLASSES = 200  # more than that are looked up
MAX_CLASSES = 1_000_000  # their sizes are shared out on the driver


@dataclass(frozen=True)
class Cut:
    """End of a part: keys up to ``key``; among equal keys, ids up to ``last_id``."""

    key: float
    last_id: object = None

    def passed(self, key: Column, row_id: Column) -> Column:
        if self.last_id is None:
            return key > F.lit(self.key)
        return (key > F.lit(self.key)) | ((key == F.lit(self.key)) & (row_id > F.lit(self.last_id)))


@dataclass(frozen=True)
class Parts:
    """Fitted part ends per class; classes are None when not stratified."""

    id_col: str
    label: str | None
    seed: int | None
    cuts: dict

    def assign(self, df: DataFrame, output: str) -> DataFrame:
        """Add the 0-based part number of each row."""
        key, row_id = _order_key(df, self.id_col, self.seed), col(self.id_col)
        out = None
        for cls, cuts in self.cuts.items():
            part = F.lit(0)
            for cut in cuts:
                part = part + cut.passed(key, row_id).cast("int")
            if self.label is None:
                out = part
            else:
                here = col(self.label) == F.lit(cls)
                out = F.when(here, part) if out is None else out.when(here, part)
        return df.withColumn(output, out.cast("int"))


@dataclass(frozen=True)
class TableParts:
    """Part ends per class as a table (value, found, common), ``found`` holding the parts that are empty and the ends."""

    id_col: str
    label: str | None
    seed: int | None
    row_cols: tuple[str, ...]
    table: DataFrame
    sent: bool

    def assign(self, df: DataFrame, output: str) -> DataFrame:
        """Add the 0-based part number of each row."""
        order = [c for c in df.columns if c != output]
        cls = F.lit("") if self.label is None else col(self.label)
        found = look_up(df, cls, self.table, "__ends", self.sent)
        at = _place(df, self.id_col, self.seed, self.row_cols)
        passed = F.size(F.filter("__ends.ends", lambda end: at > end))
        return found.withColumn(output, F.col("__ends.empty") + passed).select(*[f"`{c}`" for c in order], output)


def _place(df: DataFrame, id_col: str, seed: int | None, row_cols: tuple[str, ...]) -> Column:
    """What rows are ordered by: key, id, then the whole row."""
    textual = seed is None and not isinstance(df.schema[id_col].dataType, (T.NumericType, T.TimestampType, T.DateType))
    key = F.lit(0.0) if textual else _order_key(df, id_col, seed)
    return F.struct(key.alias("key"), col(id_col).alias("id"), F.xxhash64(*[col(c) for c in row_cols]).alias("row"))


def _fit_table(df: DataFrame, label: str | None, id_col: str, seed: int | None, ends: dict, sizes: dict) -> TableParts:
    """Ends of parts for any number of classes and any ids."""
    spark = df.sparkSession
    row_cols = tuple(f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType)))
    cls = F.lit("") if label is None else col(label)
    kind = "string" if label is None else df.schema[label].dataType.simpleString()
    rows = df.select(cls.alias("c"), _place(df, id_col, seed, row_cols).alias("at")).groupBy("c", "at").agg(F.count(F.lit(1)).alias("n"))
    ordered = checkpointed(rows.repartitionByRange("c", "at")).withColumn("range", F.spark_partition_id())
    ranges = ordered.groupBy("c", "range").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("c").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    wanted = [("" if c is None else c, e) for c, own in ends.items() for e in sorted(set(own)) if e > 0]
    ends_at = spark.createDataFrame(wanted, f"c {kind}, end long")
    inside = (F.col("before") < F.col("end")) & (F.col("end") <= F.col("before") + F.col("n"))
    near = checkpointed(ranges.join(ends_at, "c").where(inside).select("c", "range", "before", "end"))
    begun = ordered.join(near.select("c", "range", "before").distinct(), ["c", "range"])
    upto = F.col("before") + F.sum("n").over(
        Window.partitionBy("c", "range").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counted = begun.select("c", "range", "at", "n", upto.alias("upto"))
    last = counted.join(near.select("c", "range", "end"), ["c", "range"]).where(
        (F.col("upto") - F.col("n") < F.col("end")) & (F.col("end") <= F.col("upto")))
    found = last.groupBy("c").agg(F.collect_list(F.struct("end", "at")).alias("found"))
    total = sum(sizes.values())
    shape = spark.createDataFrame(
        [("" if c is None else c, sizes[c], list(own)) for c, own in ends.items()], f"c {kind}, n long, own array<long>")
    each = F.flatten(F.transform("own", lambda e: F.transform(F.filter("found", lambda f: f["end"] == e), lambda f: f["at"])))
    empty = F.size(F.filter("own", lambda e: e == 0))
    none = F.array().cast(last.select(F.array("at").alias("a")).schema["a"].dataType)
    table = checkpointed(shape.join(found, "c", "left").select(
        F.col("c").alias("value"), F.struct(empty.alias("empty"), F.coalesce(each, none).alias("ends")).alias("found"),
        (F.col("n") * COMMON > total).alias("common")))
    size = table.agg(F.sum(64 + F.octet_length(F.to_json("found")) + F.octet_length(F.col("value").cast("string"))).alias("b")).first()["b"]
    return TableParts(id_col, label, seed, row_cols, table, (size or 0) <= MAX_SENT_BYTES)


def _order_key(df: DataFrame, id_col: str, seed: int | None) -> Column:
    """Seeded hash order, or id order without a seed, as an exact double."""
    if seed is not None:
        return F.shiftright(F.xxhash64(col(id_col), F.lit(seed)), 12).cast("double")
    kind = df.schema[id_col].dataType
    if isinstance(kind, (T.TimestampType, T.DateType)):
        return F.unix_micros(col(id_col).cast("timestamp")).cast("double")
    return col(id_col).cast("double")


def _class_sizes(df: DataFrame, label: str | None, id_col: str) -> list[tuple]:
    """(class, rows) ordered by first appearance in id order, then by name."""
    if label is None:
        return [(None, df.count())]
    rows = (
        df.groupBy(col(label).alias("c")).agg(F.count(F.lit(1)).alias("n"), F.min(col(id_col)).alias("first"))
        .limit(MAX_CLASSES + 1).collect()
    )
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes in {label!r}")
    if any(r["c"] is None for r in rows):
        raise ValueError(f"{label!r} has missing labels")
    return [(r["c"], r["n"]) for r in sorted(rows, key=lambda r: (r["first"] is not None, r["first"], str(r["c"])))]


def _fit(df: DataFrame, label: str | None, id_col: str, seed: int | None, ends: dict, sizes: dict) -> Parts | TableParts:
    """``ends``: class -> number of rows up to the end of each part but the last."""
    textual = not isinstance(df.schema[id_col].dataType, (T.NumericType, T.TimestampType, T.DateType))
    if len(ends) > MAX_LITERAL_CLASSES or seed is None and (textual or df.where(col(id_col).isNull()).head(1)):
        return _fit_table(df, label, id_col, seed, ends, sizes)
    key = _order_key(df, id_col, seed)
    classes = list(ends)

    def of(cls) -> Column:
        return F.lit(True) if label is None else col(label) == F.lit(cls)

    slots = [
        Slot(F.when(of(c), key), sorted({e - 1 for e in ends[c] if e > 0}), sizes[c]) for c in classes
    ]
    order_statistics(df, slots)
    wanted = {(c, v) for c, s in zip(classes, slots) for v in set(s.found.values())}
    if _repeated(df, id_col, key, wanted):
        return _fit_table(df, label, id_col, seed, ends, sizes)
    last: dict[tuple, dict] = _tied(df, label, id_col, key, classes, wanted)
    cuts = {}
    for c, s in zip(classes, slots):
        cuts[c] = []
        for e in ends[c]:
            if e == 0:
                cuts[c].append(Cut(-math.inf))
                continue
            value = s.found[e - 1]
            ties = last.get((c, value))
            cuts[c].append(Cut(value, None if ties is None else _tie_end(df, of(c), key, value, ties, e)))
    return Parts(id_col, label, seed, cuts)


def _repeated(df: DataFrame, id_col: str, key: Column, wanted: set) -> bool:
    """Whether an id repeats, or is missing, where a part ends."""
    if not wanted:
        return False
    rows = df.where(key.isin([v for _, v in wanted])).select(col(id_col).alias("i"))
    return bool(rows.groupBy("i").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR i IS NULL").head(1))


def _tied(df, label, id_col, key, classes, wanted) -> dict:
    """For cut keys shared by several rows: a frame of those rows in id order."""
    if not wanted:
        return {}
    hit = key.isin([v for _, v in wanted])
    cls = F.lit(None).cast("string") if label is None else col(label)
    rows = df.select(cls.alias("c"), key.alias("k"), col(id_col).alias("i")).where(hit)
    shared = rows.groupBy("c", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").collect()
    order = F.row_number().over(Window.partitionBy("c", "k").orderBy("i"))
    ranked = rows.withColumn("at", order)
    out = {}
    for r in shared:
        if (r["c"], r["k"]) in wanted:
            same = F.col("c").eqNullSafe(F.lit(r["c"])) & (F.col("k") == F.lit(r["k"]))
            out[(r["c"], r["k"])] = ranked.where(same)
    return out


def _tie_end(df, of_class: Column, key: Column, value: float, ranked: DataFrame, end: int):
    before = df.where(of_class & (key < F.lit(value))).count()
    return ranked.where(F.col("at") == end - before).first()["i"]


def fold_sizes(counts: list[int], k: int) -> list[list[int]]:
    """Rows of each class (in the given order) that go to each fold.

    Lay the labels out sorted; fold i takes what every k-th place from i holds.
    """
    if all(n < k for n in counts):
        raise ValueError(f"{k} folds need a class with at least {k} rows")
    out, start = [], 0
    for n in counts:
        stop = start + n

        def upto(x: int, i: int) -> int:
            return max(0, (x - i + k - 1) // k)

        out.append([upto(stop, i) - upto(start, i) for i in range(k)])
        start = stop
    return out


def fit_folds(
    df: DataFrame, label: str, id_col: str, k: int = 5, shuffle: bool = False, seed: int = 42
) -> Parts:
    """Stratified folds: contiguous blocks in id order, or in seeded hash order."""
    sizes = _class_sizes(df, label, id_col)
    table = fold_sizes([n for _, n in sizes], k)
    ends = {}
    for (cls, _), parts in zip(sizes, table):
        upto = 0
        ends[cls] = [upto := upto + n for n in parts[:-1]]
    return _fit(df, label, id_col, seed if shuffle else None, ends, dict(sizes))


def add_folds(df: DataFrame, label: str, id_col: str, k: int = 5, output: str = "fold", **kwargs) -> DataFrame:
    return fit_folds(df, label, id_col, k, **kwargs).assign(df, output)


def share_out(counts: list[int], draws: int) -> list[int]:
    """Divide draws over classes in proportion, leftovers by largest remainder."""
    total = sum(counts)
    base = [n * draws // total for n in counts]
    rest = sorted(range(len(counts)), key=lambda i: (-(counts[i] * draws % total), i))
    for i in rest[: draws - sum(base)]:
        base[i] += 1
    return base


@dataclass(frozen=True)
class Splitter:
    """Exact train/test split; stratified on the label when one is given."""

    test_size: float = 0.2
    seed: int = 42
    stratify: bool = True

    def fit(self, df: DataFrame, id_col: str, label: str | None = None) -> Parts:
        strata = label if self.stratify else None
        sizes = _class_sizes(df, strata, id_col)
        total = sum(n for _, n in sizes)
        n_test = math.ceil(self.test_size * total)
        n_train = total - n_test
        if strata is not None:
            if min(n for _, n in sizes) < 2:
                raise ValueError("every class needs at least 2 rows")
            if min(n_train, n_test) < len(sizes):
                raise ValueError("both parts need at least one row per class")
        train = share_out([n for _, n in sizes], n_train)
        ends = {cls: [n] for (cls, _), n in zip(sizes, train)}
        return _fit(df, strata, id_col, self.seed, ends, dict(sizes))

    def assign(self, df: DataFrame, id_col: str, label: str | None = None, output: str = "is_test") -> DataFrame:
        return self.fit(df, id_col, label).assign(df, output)

    def split(self, df: DataFrame, id_col: str, label: str | None = None) -> tuple[DataFrame, DataFrame]:
        marked = self.assign(df, id_col, label, "__test")
        return (
            marked.where("__test = 0").drop("__test"),
            marked.where("__test = 1").drop("__test"),
        )

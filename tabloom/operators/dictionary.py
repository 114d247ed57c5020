"""Codes of distinct values in any number: ranked over range partitions, looked up by joins."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import MAX_LITERAL_MAP, map_values
from ..session import checkpointed

MAX_SENT_BYTES = 8 << 20  # of a table that is sent to all executors
COMMON = 1000  # a value with more than one in so many rows is common; there are fewer than that of them
_SALTS = 1024


def with_places(df: DataFrame, within: str, order: str, output: str = "place") -> DataFrame:
    """Add each row's 0-based place by ``order`` among the rows of equal ``within``, of which there are few.

    Rows move once, into ranges; places are counted inside a range and shifted by the sizes of the ranges before. Only
    these sizes, a row per range, are summed in order.
    """
    ordered = checkpointed(df.repartitionByRange(within, order).sortWithinPartitions(within, order))
    marked = ordered.withColumns({"__part": F.spark_partition_id(), "__row": F.monotonically_increasing_id()})
    ranges = marked.groupBy(within, "__part").agg(F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(within).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = ranges.withColumn("__shift", F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")).drop("__first", "__n")
    placed = marked.join(F.broadcast(shifts), [within, "__part"])
    return placed.withColumn(output, F.col("__row") + F.col("__shift")).drop("__part", "__row", "__shift")


def _bytes(value: str = "value") -> Column:
    return F.sum(F.octet_length(F.col(value).cast("string")) + 64)


def look_up(df: DataFrame, key: Column, table: DataFrame, output: str, sent: bool) -> DataFrame:
    """Left join with (value, found[, common]), values distinct; ``sent`` if its checked size allows a broadcast.

    Otherwise common values are sent, and rows that hold one, or none, are dealt out instead of meeting at a key.
    """
    order = [c for c in df.columns if c != output]
    probed = df.withColumn("__probe", key)
    names = [f"`{c}`" for c in order]
    if sent:
        t = F.broadcast(table.select(F.col("value").alias("__v"), F.col("found").alias("__f")))
        return probed.join(t, F.col("__probe") == F.col("__v"), "left").select(*names, F.col("__f").alias(output))
    common = table.where("common") if "common" in table.columns else table.limit(0)
    rare = table.where("NOT common") if "common" in table.columns else table
    few = F.broadcast(common.select(F.col("value").alias("__v"), F.col("found").alias("__f")))
    first = probed.join(few, F.col("__probe") == F.col("__v"), "left").withColumn("__key", F.when(F.col("__v").isNull(), F.col("__probe")))
    dealt = first.withColumn("__salt", F.when(F.col("__key").isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(_SALTS))).otherwise(F.lit(-1)))
    many = rare.select(F.col("value").alias("__w"), F.col("found").alias("__g"), F.lit(-1).cast("long").alias("__at"))
    met = dealt.join(many, (F.col("__key") == F.col("__w")) & (F.col("__salt") == F.col("__at")), "left")
    return met.select(*names, F.coalesce("__f", "__g").alias(output))


@dataclass(frozen=True)
class Dictionary:
    """(column, value, code, common): the non-null values of each column with their sorted place from 0."""

    table: DataFrame
    sizes: dict[str, int]
    n_bytes: dict[str, int]

    @classmethod
    def fit(cls, df: DataFrame, values: Mapping[str, Column]) -> "Dictionary":
        """``values``: column name -> expression, all of one type."""
        cells = F.array(*[F.struct(F.lit(c).alias("column"), v.alias("value")) for c, v in values.items()])
        counted = df.select(F.explode(cells).alias("r")).select("r.*").where("value IS NOT NULL").groupBy("column", "value").agg(
            F.count(F.lit(1)).alias("n"))
        placed = checkpointed(with_places(counted, "column", "value", "code"))
        stats = placed.groupBy("column").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("rows"), _bytes().alias("b")).collect()
        rows = F.col("rows")
        totals = df.sparkSession.createDataFrame([(r["column"], r["rows"]) for r in stats], "column string, rows long")
        table = placed.join(F.broadcast(totals), "column").select("column", "value", "code", (F.col("n") * COMMON > rows).alias("common"))
        return cls(table, {r["column"]: r["k"] for r in stats}, {r["column"]: r["b"] for r in stats})

    def _part(self, column: str) -> DataFrame:
        return self.table.where(F.col("column") == F.lit(column))

    def _sent(self, column: str) -> bool:
        return self.n_bytes.get(column, 0) <= MAX_SENT_BYTES

    def encode(self, df: DataFrame, column: str, key: Column, output: str) -> DataFrame:
        """Add the code of ``key``; NULL for an unseen or missing value."""
        found = self._part(column).select("value", F.col("code").cast("double").alias("found"), "common")
        return look_up(df, key, found, output, self._sent(column))

    def decode(self, df: DataFrame, column: str, code: Column, output: str) -> DataFrame:
        found = self._part(column).select(F.col("code").alias("value"), F.col("value").alias("found"), "common")
        return look_up(df, code.cast("long"), found, output, self._sent(column))


def map_column(df: DataFrame, key: Column, mapping: Mapping | DataFrame, output: str, default=None) -> DataFrame:
    """Add the mapped value of ``key``, ``default`` if missing or unknown, for mappings of any size.

    A mapping is a dict, or a frame whose first two columns are distinct keys and their values.
    """
    if isinstance(mapping, Mapping) and len(mapping) <= MAX_LITERAL_MAP:
        return df.withColumn(output, map_values(key, mapping, default))
    if isinstance(mapping, Mapping):
        mapping = df.sparkSession.createDataFrame(list(mapping.items()), ["value", "found"])
    names = mapping.columns
    table = mapping.toDF("value", "found", *names[2:]).select("value", "found")
    size = table.agg((_bytes() + _bytes("found")).alias("b")).first()["b"] or 0
    out = look_up(df, key, table, output, size <= MAX_SENT_BYTES)
    return out if default is None else out.withColumn(output, F.coalesce(F.col(f"`{output}`"), F.lit(default)))

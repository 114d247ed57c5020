"""Fitted per-group numbers, attached to rows by a literal map or a join."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import MAX_LITERAL_MAP
from ..session import checkpointed

MAX_BROADCAST_GROUPS = 10_000


@dataclass(frozen=True)
class GroupLookup:
    """Group key -> numbers. ``rows`` holds a small table, ``table`` a large one."""

    names: tuple[str, ...]
    key_type: str
    rows: tuple[tuple, ...] | None
    table: DataFrame | None = None

    @classmethod
    def collect(cls, table: DataFrame) -> "GroupLookup":
        """First column is the key, the rest are numbers. The driver keeps at most the bound."""
        key = table.columns[0]
        key_type = table.schema[key].dataType.simpleString()
        head = table.limit(MAX_BROADCAST_GROUPS + 1).collect()
        if len(head) <= MAX_BROADCAST_GROUPS:
            rows = tuple(tuple(r) for r in head)
            return cls(tuple(table.columns[1:]), key_type, rows)
        return cls(tuple(table.columns[1:]), key_type, None, checkpointed(table))

    def frame(self, spark, key: str = "group") -> DataFrame:
        if self.rows is None:
            return self.table.withColumnRenamed(self.table.columns[0], key)
        schema = ", ".join([f"`{key}` {self.key_type}"] + [f"`{n}` double" for n in self.names])
        return spark.createDataFrame(list(self.rows), schema)

    def attach(self, df: DataFrame, key: Column, seen: str) -> DataFrame:
        """Add the numbers and a flag telling whether the key was seen at fit."""
        if self.rows is not None and len(self.rows) <= MAX_LITERAL_MAP:
            if not self.rows:
                added = {n: F.lit(None).cast("double") for n in self.names}
                return df.withColumns({**added, seen: F.lit(False)})
            typed = key.cast(self.key_type)
            pairs = []
            for k, *numbers in self.rows:
                values = F.array(*[F.lit(x).cast("double") for x in numbers])
                pairs += [F.lit(k).cast(self.key_type), values]
            found = F.try_element_at(F.create_map(*pairs), typed)
            added = {n: found[i] for i, n in enumerate(self.names)}
            return df.withColumns({**added, seen: found.isNotNull()})
        other = self.frame(df.sparkSession, "__key").withColumn(seen, F.lit(True))
        if self.rows is not None:
            other = F.broadcast(other)
        joined = df.withColumn("__probe", key.cast(self.key_type)).join(
            other, F.col("__probe") == F.col("__key"), "left"
        )
        return joined.drop("__probe", "__key").withColumn(seen, F.coalesce(F.col(seen), F.lit(False)))

    def to_dict(self) -> dict:
        if self.rows is None:
            raise ValueError("this lookup is too large to describe as a dict")
        return {"names": list(self.names), "key_type": self.key_type, "rows": [list(r) for r in self.rows]}

    @classmethod
    def from_dict(cls, d: dict) -> "GroupLookup":
        return cls(tuple(d["names"]), d["key_type"], tuple(tuple(r) for r in d["rows"]))

"""Line dedup by the spread of a line over distinct sites.

A line is boilerplate if it stands at `min_sites` distinct sites or more. Each line's hash gets a HyperLogLog sketch of its
sites; sketches merge by aggregation, so a line that a third of all rows have is never gathered. Where the estimate is
within the sketch's error of the threshold, the distinct sites are counted exactly; beyond, the estimate decides. Of a
boilerplate line the first occurrence stays (smallest id, then smallest place; with `keep_first` false none does).

All steps are DataFrame operations. Only hashes and places are exploded; texts are read again for the result, and moved
once, to meet the places of their removed lines.

Lines are what newlines part; ASCII white space at their ends is trimmed for comparison. Blank lines are never counted nor removed;
nor are lines shorter than `min_chars`, if it is more than 1. Null and empty texts stay as they are. A null site adds nothing to a line's spread. Rows
equal in id, text and site are treated alike: what stays in one stays in all. A null id is later than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_SITES, MIN_CHARS = 5, 1
#: What is trimmed off the ends of a line.
SPACES = " \t\x0b\x0c\r"
#: Registers of a sketch as a power of two, and standard errors that count as near the threshold.
REGISTERS, NEAR = 12, 5


def _row_key(id_col: str, text_col: str, site_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col), F.col(site_col))


def occurrences(df: DataFrame, id_col: str, text_col: str, site_col: str, min_chars: int, spare: str | None = None) -> DataFrame:
    """(row, id, site, place, line, check): every line that is long enough, by two hashes; none that holds the expression `spare`."""
    lines = df.select(_row_key(id_col, text_col, site_col).alias("row"), F.col(id_col).alias("id"), F.col(site_col).cast("string").alias("site"),
                      F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("place", "text"))
    trimmed = F.btrim(F.col("text"), F.lit(SPACES))
    if spare is not None:
        lines = lines.where(~F.col("text").rlike(spare))
    return lines.where(F.length(trimmed) >= max(1, min_chars)).select("row", "id", "site", "place", F.xxhash64(trimmed).alias("line"), F.xxhash64(F.lit(7), trimmed).alias("check"))


def spread_lines(df: DataFrame, min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text",
                 site_col: str = "source", spare: str | None = None) -> DataFrame:
    """(line, check, first): the lines at `min_sites` sites or more, with the id and place of the first occurrence."""
    found = occurrences(df, id_col, text_col, site_col, min_chars, spare)
    first = F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", "place")).alias("first")
    lines = found.groupBy("line", "check").agg(first, F.hll_sketch_agg("site", F.lit(REGISTERS)).alias("sketch"))
    error = NEAR * 1.04 / (1 << REGISTERS) ** 0.5
    rated = lines.select("line", "check", "first", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") >= min_sites * (1 - error))
    near = rated.where(F.col("sites") <= min_sites * (1 + error))
    exact = found.join(near.select("line", "check"), ["line", "check"], "left_semi").groupBy("line", "check").agg(F.countDistinct("site").alias("n"))
    sure = rated.where(F.col("sites") > min_sites * (1 + error)).select("line", "check", "first")
    counted = near.join(exact.where(F.col("n") >= min_sites), ["line", "check"]).select("line", "check", "first")
    return sure.unionByName(counted)


def _without(lines: Column, places: Column) -> Column:
    """The lines without those at the sorted places: what lies between them."""
    begin = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(places, i - 1) + 1)
    end = lambda i: F.when(i == F.size(places), F.size(lines)).otherwise(F.get(places, i))
    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(places)), lambda i: F.slice(lines, begin(i) + 1, end(i) - begin(i))))


def dedup_lines(df: DataFrame, min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS, keep_first: bool = True, id_col: str = "doc_id",
                text_col: str = "text", site_col: str = "source", spare: str | None = None) -> DataFrame:
    """The rows with boilerplate lines cut from their text, and n_lines, n_removed. Lines that hold the expression `spare` stay."""
    spread = spread_lines(df, min_sites, min_chars, id_col, text_col, site_col, spare)
    found = occurrences(df, id_col, text_col, site_col, min_chars, spare).join(spread, ["line", "check"])
    if keep_first:
        stays = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("place") == F.col("first.place"))
        found = found.where(~stays)
    cut = found.groupBy("row").agg(F.array_sort(F.collect_set("place")).alias("__cut"))
    lines = F.split(F.col(text_col), "\n", -1)
    n_removed = F.coalesce(F.size("__cut"), F.lit(0))
    joined = df.withColumn("__row", _row_key(id_col, text_col, site_col)).join(cut.withColumnRenamed("row", "__row"), "__row", "left")
    left = F.when(F.col("__cut").isNull(), F.col(text_col)).otherwise(F.array_join(_without(lines, F.col("__cut")), "\n"))
    names = [F.col(f"`{c}`") for c in df.columns if c != text_col]
    out = joined.select(*names, left.alias("__left"), F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("__lines"),
                        F.when(F.col("__cut").isNull(), 0).otherwise(n_removed).cast("long").alias("__removed"))
    kept = [F.col("__left").alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns if c not in ("n_lines", "n_removed")]
    return out.select(*kept, F.col("__lines").alias("n_lines"), F.col("__removed").alias("n_removed"))


def line_dedup_sql(min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS) -> str:
    """The same for `documents` in SQL, by exact counts."""
    spaces = " || ".join(f"chr({ord(c)})" for c in SPACES)
    return f"""
WITH parted AS (SELECT doc_id, source, string_split(text, chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, source, i - 1 AS place, ls[i] AS raw, trim(ls[i], {spaces}) AS line FROM parted, unnest(range(1, len(ls) + 1)) AS u(i)),
spread AS (SELECT line, arg_min(doc_id, (doc_id, place)) AS fd, arg_min(place, (doc_id, place)) AS fp FROM lines
           WHERE length(line) >= {max(1, min_chars)} GROUP BY line HAVING count(DISTINCT source) >= {min_sites}),
marked AS (SELECT l.*, s.line IS NOT NULL AND NOT (l.doc_id = s.fd AND l.place = s.fp) AS cut FROM lines l LEFT JOIN spread s ON l.line = s.line)
SELECT doc_id, coalesce(string_agg(raw, chr(10) ORDER BY place) FILTER (NOT cut), '') AS text,
       count(*)::BIGINT AS n_lines, (count(*) FILTER (cut))::BIGINT AS n_removed
FROM marked GROUP BY doc_id
"""

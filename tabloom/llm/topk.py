"""Exact top-k search by inner product, with a three-phase uniform threshold.

A score is a sum over segments of the components; each segment of each block of candidates is one score list.

1. Every block takes the best entries of each of its lists, adds up their whole scores and reports its k best. The
   k-th best of all reports is a score that the k-th result reaches at least: the safe cutoff of that query.
2. The cutoff goes back to every block. An entry below cutoff / lists in all lists can't reach the cutoff, so a block
   collects those that reach it in one list at least.
3. Collected entries are added up exactly; those at the cutoff or above are ranked, ties to the smaller id.

Queries against candidates are a product by nature, done in blocks: a task holds one block of each. A block has a
bounded number of rows whatever the tables' sizes, and only k rows a query and block leave it.

Null vectors and vectors that hold null or non-finite components take no part. A null id takes no part either.
Shorter vectors count as if filled up with zeros. Equal query rows (same id, same vector) are one query; candidates with
the query's id are its own rows. Repeated candidate rows are entries of their own. Scores beyond 64 bits wrap around.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.session import checkpointed

#: Rows of a block of candidates and of queries, and lists that a score is split into.
CANDIDATE_BLOCK, QUERY_BLOCK, LISTS = 4096, 1024, 4

_EXACT = float(2**52)


def scaled(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v): components as floor(scale * x), without rows that take no part."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")))
    return vectors.where(F.col(id_col).isNotNull() & x.isNotNull()).where(finite).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v"),
    )


def _matrix(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole-number products: in floating point where that is exact, else in 64-bit integers."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if top < _EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        rest = np.flatnonzero(scores >= floor)
    else:
        rest = np.arange(len(scores))
    return rest[np.lexsort((ids[rest], -scores[rest]))[:k]]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one (query block, candidate block) at a time; rows come sorted by both."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        pair = np.column_stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
        cuts = [0, *(np.flatnonzero((pair[1:] != pair[:-1]).any(axis=1)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            part = batch.slice(a, b - a)
            if held and (held[0].column(0)[0] != part.column(0)[0] or held[0].column(1)[0] != part.column(1)[0]):
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


_FOUND = pa.schema([("qkey", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _scan(k: int, lists: int, resolve: bool):
    """Phase 1 (`resolve` false) or phases 2 and 3 of one block of queries against one block of candidates."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(rows):
            query = np.asarray(block.column("is_query").to_pylist(), bool)
            id_all, key_all = block.column("id").to_numpy(), block.column("qkey").to_numpy()
            vectors = block.column("v").to_pylist()
            if query.all() or not query.any():
                continue
            width = max(map(len, vectors))
            whole = _matrix(vectors, width)
            q, c = whole[query], whole[~query]
            ids, query_ids, keys = id_all[~query], id_all[query], key_all[query]
            edges = np.linspace(0, width, min(lists, max(width, 1)) + 1).astype(int)
            parts = [_product(q[:, a:b], c[:, a:b]) for a, b in zip(edges, edges[1:])] or [np.zeros((len(q), len(c)), np.int64)]
            cut = np.asarray(block.column("cut").fill_null(0).to_numpy())[query] if resolve else None
            cut_known = ~np.asarray(block.column("cut").is_null())[query] if resolve else None
            out: list[tuple] = []
            for i, own in enumerate(query_ids):
                others = np.flatnonzero(ids != own)
                if not len(others):
                    continue
                local = [p[i, others] for p in parts]
                if resolve and cut_known[i]:
                    reach = -(-int(cut[i]) // len(parts))
                    picked = np.flatnonzero(np.logical_or.reduce([p >= reach for p in local]))
                elif resolve:
                    picked = np.arange(len(others))
                else:
                    picked = np.unique(np.concatenate([_best(p, ids[others], k) for p in local]))
                if not len(picked):
                    continue
                total = np.sum([p[picked] for p in local], axis=0)
                found = others[picked]
                best = _best(total, ids[found], k)
                out += [(keys[i], own, ids[found[j]], total[j]) for j in best if not (resolve and cut_known[i]) or total[j] >= cut[i]]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], schema=_FOUND)

    return run


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5, lists: int = LISTS) -> DataFrame:
    """The k candidates of highest inner product for each query: query_id, rank, vec_id, score.

    Both sides are (id long, v array<long>). Queries with fewer than k other rows get all of them.
    """
    if k < 1:
        raise ValueError("k must be 1 or more")
    queries = queries.select("id", "v", F.xxhash64("id", "v").alias("qkey")).dropDuplicates(["qkey"])
    sizes = queries.agg(F.count("*").alias("n")).first()["n"], candidates.agg(F.count("*").alias("n")).first()["n"]
    q_blocks, c_blocks = (max(1, -(-n // size)) for n, size in zip(sizes, (QUERY_BLOCK, CANDIDATE_BLOCK)))

    def replicated(rows: DataFrame, own: str, own_blocks: int, other: str, other_blocks: int) -> DataFrame:
        block = F.pmod(F.xxhash64("id", "v", F.lit(7)), F.lit(own_blocks)).cast("int")
        return rows.withColumn(own, block).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(other_blocks - 1))))

    columns = ["qb", "cb", "is_query", "id", "v", "qkey", "cut"]
    right = replicated(candidates, "cb", c_blocks, "qb", q_blocks).select(
        "qb", "cb", F.lit(False).alias("is_query"), "id", "v", F.lit(0).cast("long").alias("qkey"),
        F.lit(None).cast("long").alias("cut"))

    def phase(left: DataFrame, resolve: bool) -> DataFrame:
        left = replicated(left, "qb", q_blocks, "cb", c_blocks).withColumn("is_query", F.lit(True)).select(columns)
        dealt = left.unionByName(right.select(columns)).repartition("qb", "cb").sortWithinPartitions("qb", "cb")
        return dealt.mapInArrow(_scan(k, lists, resolve), "qkey long, query_id long, vec_id long, score long")

    def ranked(rows: DataFrame) -> DataFrame:
        order = Window.partitionBy("qkey").orderBy(F.desc("score"), "vec_id")
        return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    reported = ranked(phase(queries.withColumn("cut", F.lit(None).cast("long")), False))
    cuts = checkpointed(reported.where(F.col("rank") == k).select("qkey", F.col("score").alias("cut")))
    found = ranked(phase(queries.join(cuts, "qkey", "left"), True))
    return found.select("query_id", "rank", "vec_id", "score")

"""The prefix trie of rebuilt conversations, packed as double arrays shard by shard.

Texts are read once, for a digest and a length of each turn. A running combination of digests and depths names every prefix.
Conversations of equal turns count as one sequence with a number of members; a sequence is dealt to a shard by its
first prefix, at depth 1, 2, 4, 8 ..., below which at most `SHARD_TURNS` turns lie, so one opening turn that very many
conversations share is dealt out by the turns that follow. In a shard turns get dense ids, nearly consecutive among
siblings, and the trie is packed into BASE and CHECK: the child of cell s by turn t is cell BASE[s] + t if CHECK of it is s.
Sequences are then walked through the arrays, level by level and all at once, for the nodes and their sums. Nodes above the
dealing depth are shared by shards: their sums are merged globally, and what counts for a whole subtree (leaves, saved
tokens) is added up the shared nodes of each shard and merged again.

Turns go by `turn`, null first; turns of equal number go by their digest, repeated rows are turns of their own. Null roles and
texts are empty. Rows without a conversation id belong to no conversation and take no part. Without conversations there
is no root and no row. Only the four columns are read, whatever other columns hold. The ids of a node's conversations are
hashed as a stream, in blocks of ids, since a digest needs them in one order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.session import checkpointed

#: Turns below a dealing prefix, and about so many turns in a shard; ids that a row of a node's members holds, as a power of two.
SHARD_TURNS, ID_BLOCK = 2_000, 12
#: Of conversation c the first crc32(c) % TAKEN turns come from conversation c - c % FAMILY. Fixed values.
FAMILY, TAKEN = 100, 6

_KEY = ("z1", "z2")


def ordered_turns(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, place, digest, chars): every turn by its digest and the length of its text; places count from 1."""
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16)
    rows = df.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), digest.alias("digest"), F.length(text).cast("long").alias("chars"))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return rows.select("conv", F.row_number().over(order).cast("long").alias("place"), "digest", "chars")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv, depth, digest, chars, z1, z2, last): the prefixes of rebuilt conversations; depth 0 is the empty one."""
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % TAKEN
    convs = turns.where("place = 1").select("conv", head.alias("h"), (F.col("conv") - F.col("conv") % FAMILY).alias("base"))
    opening = turns.where((F.col("conv") % FAMILY == 0) & (F.col("place") < TAKEN))
    opening = opening.select(F.col("conv").alias("base"), "place", "digest", "chars")
    taken = convs.join(opening, "base").where("place <= h").select("conv", "place", "digest", "chars")
    own = turns.where(F.col("place") > head)
    root = convs.select("conv", F.lit(0).cast("long").alias("place"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("chars"))
    order = Window.partitionBy("conv").orderBy("place")
    rows = root.unionByName(taken).unionByName(own).withColumn("depth", F.row_number().over(order).cast("long") - 1)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    name = lambda seed: F.when(F.col("depth") > 0, F.xxhash64(F.lit(seed), "depth", "digest")).otherwise(F.lit(0).cast("long"))
    return rows.select("conv", "depth", "digest", "chars", F.bit_xor(name(1)).over(upto).alias("z1"), F.bit_xor(name(2)).over(upto).alias("z2"),
                       F.lead("depth").over(order).isNull().alias("last"))


def sequences(prefixes: DataFrame) -> DataFrame:
    """(z1, z2, n, members, conv, ends): each distinct whole conversation, its members' number, smallest id and digest of ids."""
    blocks = prefixes.where("last").groupBy(*_KEY, F.col("depth").alias("n"), F.shiftright("conv", ID_BLOCK).alias("block"))
    blocks = blocks.agg(F.sort_array(F.collect_list("conv")).alias("ids"))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members, first, digest, out = None, 0, 0, None, []
        for batch in rows:
            at, flat = batch.column("ids").offsets.to_numpy().tolist(), batch.column("ids").values.to_numpy()
            for i, own in enumerate(zip(*(batch.column(c).to_pylist() for c in (*_KEY, "n")))):
                ids = flat[at[i] : at[i + 1]].tolist()
                if own != key:
                    if key is not None:
                        out.append((*key, members, first, digest.hexdigest()))
                    key, members, first, digest = own, 0, ids[0], hashlib.sha256()
                digest.update((("," if members else "") + ",".join(map(str, ids))).encode())
                members += len(ids)
            if out:
                yield _made(out, _SEQUENCE)
                out = []
        if key is not None:
            yield _made([(*key, members, first, digest.hexdigest())], _SEQUENCE)

    placed = blocks.repartition(*_KEY, "n").sortWithinPartitions(*_KEY, "n", "block")
    return placed.mapInArrow(run, "z1 long, z2 long, n long, members long, conv long, ends string")


_SEQUENCE = pa.schema([*((n, pa.int64()) for n in ("z1", "z2", "n", "members", "conv")), ("ends", pa.string())])


def _made(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(x), f.type) for x, f in zip(zip(*rows), schema)], schema=schema)


class DoubleArray:
    """A trie over rows (sequence after sequence, depth 0, 1, 2 ...): turn ids, BASE, CHECK, and the cell of each row."""

    def __init__(self, depth: np.ndarray, turn: np.ndarray):
        """`turn` numbers the turns of a shard in any way; it isn't read at depth 0."""
        by_depth = np.argsort(depth, kind="stable")
        self.levels = np.split(by_depth, np.cumsum(np.bincount(depth))[:-1])
        self.id = np.zeros(int(turn.max(initial=0)) + 1, np.int64)  # dense ids from 1, siblings nearly consecutive
        node = np.zeros(len(depth), np.int64)
        parents, ids, count = [], [], 1
        given = 0
        for rows in self.levels[1:]:
            pair, at, back = np.unique(node[rows - 1] * len(self.id) + turn[rows], return_index=True, return_inverse=True)
            fresh = pair % len(self.id)
            fresh = fresh[self.id[fresh] == 0]
            fresh = fresh[np.sort(np.unique(fresh, return_index=True)[1])]
            self.id[fresh] = np.arange(given + 1, given + 1 + len(fresh))
            given += len(fresh)
            node[rows] = back + count
            parents.append(pair // len(self.id))
            ids.append(self.id[pair % len(self.id)])
            count += len(pair)
        self.turn = self.id[turn]
        self._pack(count, np.concatenate(parents) if parents else np.zeros(0, np.int64), np.concatenate(ids) if ids else np.zeros(0, np.int64))

    def _pack(self, nodes: int, parent: np.ndarray, turn: np.ndarray) -> None:
        """Cells for all nodes: first those with several children, most first, then the others into what is free."""
        order = np.lexsort((turn, parent))
        parent, turn = parent[order], turn[order]
        begin = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]]) if parent.size else np.zeros(0, np.int64)
        size = np.diff(np.r_[begin, len(parent)])
        taken = np.zeros(2 * nodes + 2, bool)
        taken[0] = True  # the root
        base, top, low = np.zeros(nodes, np.int64), 1, 1
        several = np.flatnonzero(size > 1)
        for i in several[np.argsort(-size[several], kind="stable")].tolist():
            own = turn[begin[i] : begin[i] + size[i]]
            reach = int(own[-1] - own[0]) + 1
            if len(taken) < top + reach + 1:
                taken = np.r_[taken, np.zeros(top + reach + nodes, bool)]
            while taken[low]:
                low += 1
            spots = low + np.flatnonzero(~taken[low : min(top, low + 256)])
            spot = next((s for s in spots.tolist() if s + reach <= len(taken) and not taken[s + own - own[0]].any()), top)
            base[parent[begin[i]]] = spot - own[0]
            taken[spot + own - own[0]] = True
            top = max(top, spot + reach)
        single = np.flatnonzero(size == 1)
        free = np.flatnonzero(~taken)[: len(single)]
        if len(free) < len(single):
            free = np.r_[free, np.arange(len(taken), len(taken) + len(single) - len(free))]
        base[parent[begin[single]]] = free - turn[begin[single]]
        cells = 1 + max(top, int(free.max(initial=0)))
        self.base, self.check = np.zeros(cells, np.int64), np.full(cells, -1, np.int64)
        cell = np.zeros(nodes, np.int64)
        cell[order + 1] = base[parent] + turn
        self.base[cell] = base
        self.check[cell[order + 1]] = cell[parent]

    def walk(self) -> np.ndarray:
        """The cell of every row, by following BASE and CHECK from the root."""
        cell = np.zeros(sum(map(len, self.levels)), np.int64)
        for rows in self.levels[1:]:
            above = cell[rows - 1]
            cell[rows] = self.base[above] + self.turn[rows]
            if (self.check[cell[rows]] != above).any():
                raise RuntimeError("a turn leads nowhere")
        return cell


_NODE = pa.schema([("shard", pa.int64()), ("shared", pa.bool_()), ("top", pa.bool_()), *((n, pa.int64()) for n in (
    "depth", "z1", "z2", "up1", "up2", "chars", "members", "conv", "parent", "children", "leaves", "saved")), ("ends", pa.string())])


def _nodes(shard: int, t: pa.Table) -> pa.RecordBatch:
    """The nodes of a shard. Those that other shards may have too get the sums over what hangs on them directly, here alone."""
    depth, conv, members, dealt = (t.column(c).to_numpy() for c in ("depth", "conv", "members", "dealt"))
    z1, z2, chars = (t.column(c).to_numpy() for c in ("z1", "z2", "chars"))
    digest = np.frombuffer(b"".join(x or bytes(16) for x in t.column("digest").to_pylist()), "V16")
    trie = DoubleArray(depth, np.unique(digest, return_inverse=True)[1])
    cell = trie.walk()
    size = len(trie.check)
    row = np.full(size, -1)
    row[cell[::-1]] = np.arange(len(cell))[::-1]
    used = np.flatnonzero(row >= 0)
    used = used[np.argsort(depth[row[used]], kind="stable")]
    at, above = row[used], trie.check[used]
    total, least = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
    np.add.at(total, cell, members)
    np.minimum.at(least, cell, conv)
    shared = np.zeros(size, bool)
    shared[used] = depth[at] < dealt[at]
    own = used[~shared[used] & (above >= 0)]
    children, leaves, saved = (np.zeros(size, np.int64) for _ in range(3))
    np.add.at(children, trie.check[own], 1)
    whole = used[~shared[used]]
    leaves[whole] = children[whole] == 0
    saved[whole] = (total[whole] - 1) * chars[row[whole]]
    edges = np.cumsum(np.bincount(depth[at]))
    for level in reversed(np.split(used, edges[:-1])[1:]):
        level = level[~shared[level]]
        np.add.at(leaves, trie.check[level], leaves[level])
        np.add.at(saved, trie.check[level], saved[level])
    up = np.where(above >= 0, row[above], at)
    ends: list = [None] * size
    for i in np.flatnonzero(t.column("last").to_numpy(zero_copy_only=False)).tolist():
        ends[cell[i]] = t.column("ends")[i].as_py()
    columns = [np.full(len(used), shard), shared[used], depth[at] == dealt[at], depth[at], z1[at], z2[at], z1[up], z2[up], chars[at], total[used],
               least[used], least[np.maximum(above, 0)], children[used], leaves[used], saved[used], [ends[c] for c in used.tolist()]]
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, _NODE)], schema=_NODE)


def _by_shard(rows: Iterator[pa.RecordBatch], make) -> Iterator[pa.RecordBatch]:
    """What `make` gives for the rows of each shard; rows come sorted by it."""
    shard, held = None, []
    for batch in rows:
        own = batch.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(own)]
        for b, e in zip(cuts, cuts[1:]):
            if b == e:
                continue
            if held and own[b] != shard:
                yield make(shard, pa.Table.from_batches(held))
                held = []
            shard = int(own[b])
            held.append(batch.slice(b, e - b))
    if held:
        yield make(shard, pa.Table.from_batches(held))


def sharded_nodes(prefixes: DataFrame) -> DataFrame:
    """The nodes of every shard's trie."""
    spark = prefixes.sparkSession
    known = checkpointed(sequences(prefixes))
    size = known.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_TURNS))
    rows = prefixes.join(known.select("conv", "n", "members", "ends"), "conv")
    rows = checkpointed(rows.withColumn("ends", F.when(F.col("last"), F.col("ends"))))
    steps = rows.where((F.col("depth") > 0) & (F.col("depth").bitwiseAND(F.col("depth") - 1) == 0))
    crowded = steps.groupBy("depth", *_KEY).agg(F.sum(F.col("n") - F.col("depth") + 1).alias("below")).where(F.col("below") > SHARD_TURNS)
    dealt = steps.join(crowded, ["depth", *_KEY], "left_anti").groupBy("conv").agg(F.min(F.struct("depth", *_KEY)).alias("by"))
    whole = rows.where("last").select("conv", F.struct((F.col("n") + 1).alias("depth"), *_KEY).alias("whole"))
    dealt = whole.join(dealt, "conv", "left").select("conv", F.coalesce("by", "whole").alias("by"))
    dealt = dealt.select("conv", F.col("by.depth").alias("dealt"), F.pmod(F.xxhash64("by.depth", "by.z1", "by.z2"), F.lit(shards)).alias("shard"))
    placed = rows.join(dealt, "conv").repartition(min(shards, 20_000), "shard").sortWithinPartitions("shard", "conv", "depth")
    columns = ", ".join(f"{f.name} {dict(int64='long', bool='boolean', string='string')[str(f.type)]}" for f in _NODE)
    return checkpointed(placed.mapInArrow(lambda batches: _by_shard(batches, _nodes), columns))


_SUM = pa.schema([(n, pa.int64()) for n in ("z1", "z2", "leaves", "saved")])


def _upward(shard: int, t: pa.Table) -> pa.RecordBatch:
    """Leaves and saved tokens of a shard's shared nodes, added up to the root. Several rows of a node are summed."""
    depth, leaves, saved = (t.column(c).to_numpy() for c in ("depth", "leaves", "saved"))
    keys = np.c_[t.column("z1").to_numpy(), t.column("z2").to_numpy()]
    above = np.c_[t.column("up1").to_numpy(), t.column("up2").to_numpy()]
    pair = [("a", np.int64), ("b", np.int64)]
    known, first, back = np.unique(np.ascontiguousarray(keys).view(pair).ravel(), return_index=True, return_inverse=True)
    up = np.searchsorted(known, np.ascontiguousarray(above[first]).view(pair).ravel())
    sums = np.zeros((len(known), 2), np.int64)
    np.add.at(sums, back, np.c_[leaves, saved])
    level = depth[first]
    order = np.argsort(-level, kind="stable")
    for d in range(int(level.max()), 0, -1):
        at = order[np.searchsorted(-level[order], -d, "left") : np.searchsorted(-level[order], -d, "right")]
        np.add.at(sums, up[at], sums[at])
    rows = keys[first]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (rows[:, 0], rows[:, 1], sums[:, 0], sums[:, 1])], schema=_SUM)


def prefix_trie(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: every node of the trie."""
    found = sharded_nodes(checkpointed(rebuilt(ordered_turns(df, id_col, turn_col, role_col, text_col))))
    part = found.where("shared")
    above = part.groupBy(*_KEY).agg(
        F.first("depth").alias("depth"), F.first("up1").alias("up1"), F.first("up2").alias("up2"), F.first("chars").alias("chars"),
        F.sum("members").alias("members"), F.min("conv").alias("conv"), F.sum("children").alias("children"), F.min("shard").alias("shard"), F.max("ends").alias("ends"))
    above = checkpointed(above)
    up = [F.col("up1").alias("z1"), F.col("up2").alias("z2")]
    inner = above.where("depth > 0").select(*up).groupBy(*_KEY).agg(F.count("*").alias("inner"))
    above = above.join(inner, list(_KEY), "left").withColumn("children", F.col("children") + F.coalesce("inner", F.lit(0))).drop("inner")
    own = above.select("shard", "depth", *_KEY, "up1", "up2", (F.col("children") == 0).cast("long").alias("leaves"),
                       ((F.col("members") - 1) * F.col("chars")).alias("saved"))
    sums = part.select(*own.columns).unionByName(own).repartition("shard").sortWithinPartitions("shard")
    sums = sums.mapInArrow(lambda batches: _by_shard(batches, _upward), "z1 long, z2 long, leaves long, saved long")
    sums = sums.groupBy(*_KEY).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    parents = above.select(*_KEY, F.col("conv").alias("parent"))
    upper = above.join(sums, list(_KEY)).join(parents.toDF("up1", "up2", "parent"), ["up1", "up2"])
    upper = upper.withColumn("parent", F.when(F.col("depth") > 0, F.col("parent")))
    near = part.select("shard", *_KEY).join(parents, list(_KEY)).toDF("up1", "up2", "shard", "parent")
    tops = found.where("NOT shared AND top").drop("parent").join(near, ["shard", "up1", "up2"])
    rest = found.where("NOT shared AND NOT top")
    names = ["conv", "depth", "parent", "members", "children", "leaves", "saved", "ends"]
    rows = upper.select(*names).unionByName(tops.select(*names)).unionByName(rest.select(*names))
    none = hashlib.sha256(b"").hexdigest()
    return rows.withColumn("ends", F.coalesce("ends", F.lit(none))).toDF(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")

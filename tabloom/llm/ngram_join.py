"""Near duplicates by the Jaccard similarity of word n-grams, exactly.

A document's set are the distinct hashes of its n-grams. Documents with equal sets form one class, which takes part once.

1. Tiles. Sets are banded by size, and a set meets its own band and, if it may be the larger partner of one there, the band
   below. Within a band the hash space falls into more parts than a pair above the threshold can differ in, so such a
   pair has a part in which both agree entirely. A tile is a band, a part and the n-grams in it; sets that share no tile
   are not similar. Tiles of only one set are dropped before anything larger than their key is moved, and of tiles that hold
   the same sets one stays. In a tile, sizes and
   signatures (a bit for each hashed n-gram, toggled) bound the overlap from above; only what may link is connected.
2. Groups. Sets that tiles connect form a group; only these can hold links. A group is dealt into blocks of bounded
   size, and tasks get one block or a pair of them with the sorted n-grams.
3. Links. In a task, signatures bound the overlap of two sets again: each bit that differs stands for an n-gram that only one of them has. What passes is decided by the exact intersection of the
   sorted arrays. Pairs that are connected already are skipped, so that a block of copies yields a chain, not all pairs.
4. First each block by itself, then one set of each part that came out, then the pairs of blocks that still are in
   more than one part. Components of the links are the classes' components.

No pair is lost: hashes are 64 bits wide, and that two different n-grams share one is the only way to err. No group, tile or copy
is gathered in one task beyond a block.

Texts that are null, empty or without words have an empty set, link with nothing and are their own component. Repeated rows
and equal texts are linked. A null id is nobody's component; rows with it get the smallest known id of what they reach.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.frames import small, utf8
from tabloom.llm.graph import components
from tabloom.llm.words import Words, byte_values, mixed, slices
from tabloom.session import checkpointed

#: Width of a band, n-grams of a block and sets of a block, spare parts of a band.
BAND_WIDTH, BLOCK_NGRAMS, BLOCK_SETS, SPARE = 1.25, 2_000_000, 4_096, 2
#: Sets of a tile that signatures are compared for.
TILE_SETS = 8_192
#: Sets that a task remembers to have sent.
SENT_SETS = 500_000

_WORD = byte_values(23, bytes(c + 32 if 65 <= c <= 90 else c or 255 for c in range(256)))
_NGRAM = np.random.default_rng(24).integers(1, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_PART, _GROUP = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


class Bands:
    """Sizes from which bands begin, and the n-grams in which a similar pair of a band can differ at most."""

    def __init__(self, percent: int):
        if not 50 <= percent <= 100:
            raise ValueError("the threshold must be from 50 to 100 percent")
        self.percent = percent
        starts = [1]
        while starts[-1] < 1 << 40:
            starts.append(max(starts[-1] + 1, int(starts[-1] * BAND_WIDTH), self.largest(starts[-1]) + 1))
        self.starts = np.array(starts, np.int64)

    def largest(self, size: int) -> int:
        """The size of the largest set that may link with one of this size."""
        return size * 100 // self.percent

    def differ(self, band: int) -> int:
        """At most so many n-grams are in one set only, if the smaller one is in the band."""
        smaller = int(self.starts[band + 1]) - 1
        return self.largest(smaller) - smaller

    def of(self, size: int) -> list[int]:
        """Bands in which a set meets others."""
        own = int(np.searchsorted(self.starts, size, "right")) - 1
        return [own, own - 1] if own and size <= self.largest(int(self.starts[own]) - 1) else [own]


def ngrams(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of words, and how many each text has; texts of fewer words have the whole as one."""
    words = Words(texts)
    h, count = words.hashes(_WORD), words.count
    whole = np.maximum(count - n + 1, np.minimum(count, 1))
    end = np.cumsum(count)
    first = np.repeat(end - count, whole) + np.arange(whole.sum()) - np.repeat(np.cumsum(whole) - whole, whole)
    length = np.repeat(np.minimum(count, n), whole)
    out = np.zeros(len(first), np.uint64)
    for i in range(n):
        inside = i < length
        out[inside] = out[inside] * _NGRAM[0] + h[first[inside] + i] * _NGRAM[1 + i]
    return mixed(out + length.astype(np.uint64)), whole


def sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Each text's distinct n-grams, sorted."""
    h, count = ngrams(texts, n)
    return [np.unique(x) for x in np.split(h, np.cumsum(count)[:-1])]


def set_id(ngram_set: np.ndarray) -> int:
    """A number of 63 bits that equal sets share."""
    spread = mixed(ngram_set * _GROUP)
    total = np.add.reduce(spread, keepdims=True) * _PART + np.bitwise_xor.reduce(spread, keepdims=True)
    return int(mixed(total)[0] >> np.uint64(1))


def tiles(ngram_set: np.ndarray, bands: Bands) -> list[np.ndarray]:
    """Keys of the tiles of a set."""
    out = []
    for band in bands.of(len(ngram_set)):
        differ = bands.differ(band)
        if not differ:
            continue  # only equal sets link, and these are one class
        parts = differ + 1 + SPARE
        part = (mixed(ngram_set ^ _PART) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
        order = np.argsort(part, kind="stable")
        total = np.r_[np.uint64(0), np.cumsum(mixed(ngram_set[order] + _GROUP), dtype=np.uint64)]
        edge = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
        key = mixed(total[edge[1:]] - total[edge[:-1]] + np.arange(parts, dtype=np.uint64) * _GROUP + np.full(1, band, np.uint64) * _PART)
        empty = edge[1:] == edge[:-1]
        # with so many parts at least SPARE + 1 agree; so empty ones matter only if there are more than SPARE of them
        out.append(key if empty.sum() > SPARE else key[~empty])
    return out


def _width(size: int, percent: int) -> int:
    """Bits of a signature: enough to tell what differs too much, the same for all sets of about this size."""
    return 1 << max(7, int(4 * size * (100 - percent) // percent).bit_length())


def _members(n: int, percent: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(rows):
            at = 0
            for texts in slices(utf8(batch)):
                own = sets(texts, n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(own)), batch.column(1).slice(at, len(own)), pa.array([len(s) for s in own], pa.int64()),
                     pa.array([set_id(s) if len(s) else None for s in own], pa.int64()),
                     pa.array([_bits([s], _width(len(s), percent)).tobytes() for s in own], pa.binary())], ["id", "place", "size", "set", "bits"])
                at += len(own)

    return run


def _tile_rows(n: int, bands: Bands):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in small(rows):
            for texts in slices(utf8(batch)):
                keys, owners = [], []
                if len(sent) > SENT_SETS:
                    sent.clear()
                for s in sets(texts, n):
                    own = set_id(s) if len(s) else None
                    if own is None or own in sent:
                        continue
                    sent.add(own)
                    for key in tiles(s, bands):
                        keys.append(key)
                        owners.append(np.full(len(key), own, np.int64))
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(owners))], ["tile", "set"])

    return run


def _set_rows(n: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(rows):
            at = 0
            for texts in slices(utf8(batch)):
                own = sets(texts, n)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(own)), pa.array([s.view(np.int64) for s in own], pa.list_(pa.int64())),
                                                  pa.array([set_id(s) if len(s) else None for s in own], pa.int64())], ["set", "ngrams", "found"])
                at += len(own)

    return run


class _Union:
    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: int, b: int) -> bool:
        low, high = sorted((self.root[a], self.root[b]))
        if low == high:
            return False
        self.root[self.root == high] = low
        return True


def _bits(groups: list[np.ndarray], width: int) -> np.ndarray:
    """Signatures of `width` bits; each n-gram toggles one."""
    out = np.zeros((len(groups), width // 64), np.uint64)
    owner = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
    bit = mixed(np.concatenate(groups) + _PART) % np.uint64(width)
    np.bitwise_xor.at(out, (owner, (bit >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bit & np.uint64(63)))
    return out


def linked(groups: list[np.ndarray], percent: int, part: np.ndarray, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect what is similar: of `groups`, or of those of different sides only.

    `part` says which are connected already. Sets come in any order; sizes, then signatures, then the sets themselves decide.
    """
    size = np.array([len(g) for g in groups], np.int64)
    order = np.argsort(size, kind="stable")
    groups, size, part = [groups[i] for i in order], size[order], part[order]
    sides = None if side is None else side[order]
    width = max(128, 1 << int(max(1, size[-1] * 8 * (100 - percent) // 100)).bit_length())
    bits = _bits(groups, min(width, 4096))
    known = _Union(len(groups))
    for p in np.unique(part):
        same = np.flatnonzero(part == p)
        known.root[same] = same[0]
    out = []
    for i in range(1, len(groups)):
        low = np.searchsorted(size, -(-int(size[i]) * percent // 100))
        near = np.arange(low, i)
        near = near[(known.root[near] != known.root[i]) & (True if sides is None else sides[near] != sides[i])]
        if not near.size:
            continue
        differ = np.bitwise_count(bits[near] ^ bits[i]).sum(axis=1, dtype=np.int64)
        most = (size[near] + size[i] - differ) // 2  # of the overlap
        fits = 100 * most >= percent * (size[near] + size[i] - most)
        near, most = near[fits], most[fits]
        for j in near[np.argsort(-most, kind="stable")].tolist():
            if known.root[j] == known.root[i]:
                continue
            both = np.intersect1d(groups[i], groups[j], assume_unique=True).size
            if 100 * both >= percent * (size[i] + size[j] - both):
                known.join(i, j)
                out.append((int(order[i]), int(order[j])))
    return out


def _folded(bits: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Signatures as rows of the smallest width among them; halves of a wider one are put together."""
    rows = [np.frombuffer(b, np.uint64) for b in bits]
    least = min(map(len, rows))
    return np.stack([np.bitwise_xor.reduce(r.reshape(-1, least), axis=0) for r in rows])


def _meet_rows(percent: int):
    """Sets that may link in a tile, connected; rows come sorted by tile, and one tile is held at a time."""

    def meets(held: list[tuple]) -> list[tuple[int, int]]:
        sets_, sizes, bits = zip(*sorted(held, key=lambda r: (r[1], r[0])))
        size, sign = np.array(sizes, np.int64), _folded(bits, np.array(sizes))
        known, out = _Union(len(size)), []
        for i in range(1, len(size)):
            low = np.searchsorted(size[:i], -(-int(size[i]) * percent // 100))
            near = low + np.flatnonzero(known.root[low:i] != known.root[i])
            differ = np.bitwise_count(sign[near] ^ sign[i]).sum(axis=1, dtype=np.int64)
            most = (size[near] + size[i] - differ) // 2  # of the overlap
            for j in near[100 * most >= percent * (size[near] + size[i] - most)].tolist():
                if known.join(i, j):
                    out.append((sets_[i], sets_[j]))
        return out

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, name, found = [], None, []
        for batch in rows:
            for tile, own, size, bits in zip(*(c.to_pylist() for c in batch.columns)):
                if tile != name:
                    found += meets(held) if len(held) > 1 else []
                    held, name = [], tile
                held.append((own, size, bits))
            if len(found) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["u", "v"])
                found = []
        found += meets(held) if len(held) > 1 else []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["u", "v"])

    return run


def _link_rows(percent: int):
    """Rows come sorted by (group, a, b); one of these at a time is held."""

    def links(held: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        block = pa.Table.from_batches(held)
        if block.num_rows < 2:
            return None
        groups = [np.asarray(v.values).view(np.uint64) for v in block.column("ngrams").combine_chunks()]
        ids, part = block.column("set").to_numpy(), block.column("part").to_numpy()
        own = block.column("block").to_numpy()
        side = own if block.column("a")[0] != block.column("b")[0] else None
        found = linked(groups, percent, part, side)
        if not found:
            return None
        return pa.RecordBatch.from_arrays([pa.array(ids[[i for i, _ in found]]), pa.array(ids[[j for _, j in found]])], ["u", "v"])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        name = None
        for batch in rows:
            if not batch.num_rows:
                continue
            keys = np.column_stack([batch.column(i).to_numpy() for i in range(3)])
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), batch.num_rows]
            for x, y in zip(cuts, cuts[1:]):
                own = tuple(keys[x])
                if held and own != name:
                    if (out := links(held)) is not None:
                        yield out
                    held = []
                name = own
                held.append(batch.slice(x, y - x))
        if held and (out := links(held)) is not None:
            yield out

    return run


def near_duplicates(df: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_shingles, component_id of every row: documents link from `percent` of similarity on.

    Two more columns follow: `row`, a hash of id and text, and `component`, which is the same for all rows of a component
    and null where the set is empty.
    """
    bands = Bands(percent)
    rows = df.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("place"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    members = checkpointed(rows.mapInArrow(_members(n, percent), f"id {kind}, place long, size long, set long, bits binary"))
    classes = members.where("set is not null").groupBy("set").agg(F.min("id").alias("low"), F.min("place").alias("place"), F.max("size").alias("size"))
    signed = members.where("set is not null").select("set", "size", "bits").dropDuplicates(["set"])

    # dealt out once for both uses; a task sends a set's keys once, however many copies of it there are
    keys = rows.select("text").mapInArrow(_tile_rows(n, bands), "tile long, set long").repartition("tile")
    shared = keys.groupBy("tile").agg(F.min("set").alias("least"), F.max("set").alias("most")).where("least <> most").select("tile")
    met = checkpointed(keys.join(shared, "tile").distinct())
    # tiles that hold the same sets say the same, so one of them stays before signatures are moved
    held = met.groupBy("tile").agg(F.count("*").alias("n"), F.min("set").alias("least"), F.bit_xor(F.xxhash64("set")).alias("x"),
                                   F.bit_xor(F.xxhash64(F.lit(1), "set")).alias("y"))
    kept = checkpointed(met.join(held.groupBy("n", "least", "x", "y").agg(F.min("tile").alias("tile")).select("tile", "n", "least"), "tile"))
    # a tile that is too crowded for one task connects all of its sets; in others, signatures tell which may link
    crowded = kept.where((F.col("n") > TILE_SETS) & (F.col("set") != F.col("least"))).select(F.col("set").alias("u"), F.col("least").alias("v"))
    tiled = kept.where(F.col("n") <= TILE_SETS).join(signed, "set").select("tile", "set", "size", "bits")
    bounded = tiled.repartition("tile").sortWithinPartitions("tile").mapInArrow(_meet_rows(percent), "u long, v long")
    groups = components(crowded.unionByName(bounded))

    listed = checkpointed(groups.withColumnRenamed("node", "set").withColumnRenamed("component", "grp").join(classes, "set"))
    total = listed.groupBy("grp").agg(F.sum("size").alias("ngrams"), F.count("*").alias("members"))
    blocks = F.greatest(F.ceil(F.col("ngrams") / BLOCK_NGRAMS), F.ceil(F.col("members") / BLOCK_SETS))
    total = total.withColumn("blocks", blocks.cast("long"))
    dealt = listed.join(total, "grp").select("set", "grp", "blocks", "place", F.pmod(F.xxhash64("set"), F.col("blocks")).alias("block"))
    texts = rows.select("place", "text").join(dealt.select("set", "place"), "place")
    loaded = texts.select("set", "text").mapInArrow(_set_rows(n), "set long, ngrams array<long>, found long").where("set = found").drop("found")
    loaded = loaded.dropDuplicates(["set"])
    whole = checkpointed(loaded.join(dealt.drop("place"), "set"))

    link = lambda given: given.select("grp", "a", "b", "set", "ngrams", "part", "block").repartition("grp", "a", "b").sortWithinPartitions(
        "grp", "a", "b").mapInArrow(_link_rows(percent), "u long, v long")
    first = checkpointed(link(whole.withColumn("a", F.col("block")).withColumn("b", F.col("block")).withColumn("part", F.col("set"))))
    links = first
    split = whole.where("blocks > 1")
    if not split.isEmpty():
        parts = lambda found: split.join(components(found).withColumnRenamed("node", "set"), "set", "left").withColumn(
            "part", F.coalesce("component", "set")).drop("component")
        # one set of each part of a block, dealt out anew
        heads = parts(first).where("set = part or part = set").withColumn("a", F.pmod(F.xxhash64("set", F.lit(1)), F.greatest(F.lit(1), F.col("blocks") / 8)).cast("long"))
        second = checkpointed(link(heads.withColumn("b", F.col("a"))))
        links = links.unionByName(second)
        now = parts(links)
        open_groups = now.groupBy("grp").agg(F.min("part").alias("x"), F.max("part").alias("y")).where("x <> y").select("grp")
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
        pairs = now.join(open_groups, "grp", "left_semi").select("*", other).where("other <> block")
        third = link(pairs.withColumn("a", F.least("block", "other")).withColumn("b", F.greatest("block", "other")))
        links = links.unionByName(checkpointed(third))

    joined = components(links).withColumnRenamed("node", "set")
    low = classes.join(joined, "set", "left").withColumn("component", F.coalesce("component", "set"))
    least = low.groupBy("component").agg(F.min("low").alias("component_id"))
    named = low.join(least, "component").select("set", "component", "component_id")
    return members.join(named, "set", "left").select(
        F.col("id").alias(id_col), F.col("size").alias("n_shingles"),
        F.when(F.col("set").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        F.col("place").alias("row"), "component")


def one_of_each(df: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `df` that have the smallest id of their component, or an empty set; rows repeated in id and text stay once."""
    found = near_duplicates(df, n, percent, id_col, text_col)
    first = F.min(F.struct(F.col(id_col).isNull().alias("unknown"), F.col(id_col).alias("id"), "row")).alias("first")
    heads = found.where("component is not null").groupBy("component").agg(first).select(F.col("first.row").alias("__row"))
    kept = heads.unionByName(found.where("component is null").select(F.col("row").alias("__row")))
    rows = df.withColumn("__row", F.xxhash64(F.col(id_col), F.col(text_col)))
    return rows.join(kept, "__row", "left_semi").dropDuplicates(["__row"]).drop("__row")

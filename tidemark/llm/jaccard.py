"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures.

The 5-word shingles of a text are a set of 64-bit hashes. Two sets of a Jaccard
similarity of at least 0.75 share one of the first quarter of their hashes, in any
order common to all, so sets meet in lists, one for each hash of such a quarter. The
order puts hashes known to be frequent last. The quarters travel as packed arrays
and become lists in numpy, so Spark moves rows of some kilobytes and not one for each
hash. What meets is compared by size, then by
parity bitmaps, whose differing bits bound the overlap from above, and what is left
by the sets themselves. This is done twice:

1. each set of a list with the list's first one; of these pairs for every set the
   most promising is verified. This joins the bulk of large groups of near copies.
2. in lists that still hold several components, all pairs of sets of different
   components: short lists as pairs, longer ones as tiles (list, size band, block and
   block), in which bitmaps are compared in numpy and only pairs that may link leave.

No link between sets of different components is lost, so the components are exact.

The links inside a component are counted in tiles as well, block by block of its
distinct sets: sizes and bitmaps first, then exact intersections. No pair leaves a
tile, only each set's number of links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import few_bytes, join_few, lean, most_common, tidied, written
from .components import components
from .shingles import shingle_sets
from .word_hashes import mix

#: Of so many texts one is looked at for frequent hashes; frequent is what so many of those have.
ONE_OF, FREQUENT = 16, 16
#: Frequent hashes that go to every task, 16 bytes each; others stand in their usual place in the order. Their lists
#: are split into blocks before they travel, others' when their size is known: these have at most a 500,000th of all entries.
MOST_FREQUENT = 500_000
#: Sets in a block of a tile; sets up to which a list is taken as pairs.
BLOCK, SHORT = 2048, 48
#: Entries of lists that a task holds before it packs them, and that it turns into lists at once on average.
PACKED, GATHERED = 1 << 19, 1 << 18
#: Parts that the entries of one such task come from.
PARTS = 16

#: A set's place in a list: the hash, the blocks that the list is split into and the set's own one.
_HEAD = np.dtype([("h", "u8"), ("blocks", "i4"), ("block", "i4")])
_ENTRY = np.dtype([*_HEAD.descr, ("key", "i8"), ("n", "i8")])


def _first() -> Column:
    """What the row to stay of a group has least: an id rather than none, the id, the place."""
    return F.struct(F.col("id").isNull().alias("none"), "id", "place")


def bitmap(codes: np.ndarray) -> bytes:
    """Parity of the hashes that fall on each bit; the number of bits is the power of two from twice the set's size on."""
    bits = 64
    while bits < 2 * len(codes):
        bits *= 2
    odd = np.bincount((codes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _folded(maps: np.ndarray, width: int) -> np.ndarray:
    while maps.shape[1] > width:
        half = maps.shape[1] // 2
        maps = maps[:, :half] ^ maps[:, half:]
    return maps


def _groups(maps: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Places and matrix of the bitmaps of each width."""
    sizes = np.array([len(m) for m in maps])
    return {
        int(w): (at := np.flatnonzero(sizes == w), np.frombuffer(b"".join(maps[i] for i in at), np.uint8).reshape(len(at), w))
        for w in np.unique(sizes)
    }


def differing(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Bits that differ of each pair: at most the number of shingles that only one of both has."""
    out = np.zeros(len(left), np.int64)
    sizes = np.array([(len(a), len(b)) for a, b in zip(left, right)]).reshape(-1, 2)
    for a, b in np.unique(sizes, axis=0):
        at = np.flatnonzero((sizes[:, 0] == a) & (sizes[:, 1] == b))
        x = np.frombuffer(b"".join(left[i] for i in at), np.uint8).reshape(len(at), a)
        y = np.frombuffer(b"".join(right[i] for i in at), np.uint8).reshape(len(at), b)
        width = min(a, b)
        out[at] = np.bitwise_count(_folded(x, width) ^ _folded(y, width)).sum(axis=1)
    return out


def _differing(a: str, b: str) -> Column:
    def bits(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array(differing(a.to_pylist(), b.to_pylist()), pa.int64())

    return F.arrow_udf(bits, "long")(a, b)


def _shared(a: str, b: str) -> Column:
    """Size of the intersection of two sorted arrays."""

    def one(x: bytes, y: bytes) -> int:
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        if len(x) > len(y):
            x, y = y, x
        at = np.searchsorted(y, x)
        return int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(x) else 0

    def size(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array(map(one, a.to_pylist(), b.to_pylist()), pa.int64())

    return F.arrow_udf(size, "long")(a, b)


def _near_sizes(a: Column, b: Column) -> Column:
    return (4 * F.least(a, b)) >= (3 * F.greatest(a, b))


def _frequent(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes found in many texts, sorted, and estimates in how many. Only the order depends on it, no result."""

    @lean
    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_bytes(batches, 0):
            sets = list(shingle_sets(batch.column(0)))
            flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64))], ["h"])

    some = texts.where(F.pmod(F.xxhash64("text"), F.lit(ONE_OF)) == 0).select("text")
    counts = some.mapInArrow(every, "h long").groupBy("h").agg(F.count("*").alias("c")).where(F.col("c") >= FREQUENT)
    found = most_common(written(counts, "jaccard-frequent"), MOST_FREQUENT)
    hashed, seen = (found[c].to_numpy().astype(np.int64) for c in ("h", "c"))
    order = np.argsort(hashed.view(np.uint64))
    return hashed.view(np.uint64)[order], seen[order] * ONE_OF


def _key(codes: np.ndarray) -> np.int64:
    """64 bits that tell a set from others."""
    total = mix(codes ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64, keepdims=True)
    return mix(total).view(np.int64)[0]


def _sets(texts: DataFrame) -> DataFrame:
    """A row for each of ``texts`` (id, place, text), written: id, place, row, n, key, map, heads.

    That is the set's size, key and bitmap and its first quarter, packed; each of these
    has the hash and, for frequent ones, the number of blocks and the set's own block.
    """
    frequent, counts = _frequent(texts)
    sent = texts.sparkSession.sparkContext.broadcast((frequent, np.maximum(1, counts // BLOCK)))

    def head(codes: np.ndarray, key: int) -> bytes:
        frequent, blocks = sent.value
        size = len(codes)
        wanted = size - (3 * size + 3) // 4 + 1 if size else 0
        count, often = np.ones(size, np.int64), np.zeros(size, bool)
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, codes), len(frequent) - 1)
            often = frequent[at] == codes
            count[often] = blocks[at[often]]
        order = np.concatenate([np.flatnonzero(~often), np.flatnonzero(often)])[:wanted]
        out = np.empty(len(order), _HEAD)
        out["h"], out["blocks"], out["block"] = codes[order], count[order], (int(key) >> 8) % count[order]
        return out.tobytes()

    @lean
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_bytes(batches, 2):
            sizes, keys, maps, heads = [], [], [], []
            for codes in shingle_sets(batch.column(2)):  # a set goes when its bitmap and quarter are made
                key = _key(codes)
                sizes.append(len(codes))
                keys.append(key)
                maps.append(bitmap(codes))
                heads.append(head(codes, key))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.int64()),
                    pa.array(maps, pa.binary()),
                    pa.array(heads, pa.binary()),
                ],
                ["id", "place", "n", "key", "map", "heads"],
            )

    table = texts.mapInArrow(of, "id long, place long, n long, key long, map binary, heads binary")
    return written(table.withColumn("row", F.monotonically_increasing_id()), "jaccard-sets")


def _lists(sets: DataFrame, entries: int) -> DataFrame:
    """(h, blocks, block, key, n, pivot, pivot_n), written: the sets (key, n, heads) of each list that has several.

    ``pivot`` is the least key of the list's part that met in one task. ``entries``
    is the number of all entries. They are packed by parts of the hashes, several to a
    task, which sorts them. Lists of frequent hashes come in blocks; another list that
    turns out to be long is split here.
    """
    tasks = max(1, entries // GATHERED)
    parts = np.uint64(tasks * PARTS)

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(held)
        part = mix(rows["h"] + rows["block"].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % parts
        order = np.argsort(part, kind="stable")
        part, cuts = np.unique(part[order], return_index=True)
        data = rows[order]
        blobs = [x.tobytes() for x in np.split(data, cuts[1:])]
        return pa.RecordBatch.from_arrays([pa.array(part.astype(np.int64)), pa.array(blobs, pa.binary())], ["part", "rows"])

    @lean
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for key, n, heads in zip(*(c.to_pylist() for c in batch.columns)):
                own = np.frombuffer(heads, _HEAD)
                rows = np.empty(len(own), _ENTRY)
                for name in _HEAD.names:
                    rows[name] = own[name]
                rows["key"], rows["n"] = key, n
                held.append(rows)
                count += len(rows)
                if count >= PACKED:
                    yield packed(held)
                    held, count = [], 0
        if count:
            yield packed(held)

    @lean
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.frombuffer(x, _ENTRY) for batch in batches for x in batch.column(1).to_pylist()]
        if not held:
            return
        rows = np.concatenate(held)
        del held
        rows = rows[np.lexsort((rows["key"], rows["block"], rows["h"]))]
        new = np.ones(len(rows), bool)
        new[1:] = (rows["h"][1:] != rows["h"][:-1]) | (rows["block"][1:] != rows["block"][:-1])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(rows)))
        pivot = np.repeat(first, size)
        size = np.repeat(size, size)
        keep = (size > 1) | (rows["blocks"] > 1)
        rows, pivot, size = rows[keep], rows[pivot[keep]], size[keep]
        long = (rows["blocks"] == 1) & (size > BLOCK)
        blocks = np.where(long, -(-size // BLOCK), rows["blocks"]).astype(np.int32)
        block = np.where(long, (rows["key"] >> 8) % blocks, rows["block"]).astype(np.int32)
        columns = [rows["h"].view(np.int64), blocks, block, rows["key"], rows["n"], pivot["key"], pivot["n"]]
        for at in range(0, len(rows), 1 << 16):
            part = [pa.array(np.ascontiguousarray(c[at : at + (1 << 16)])) for c in columns]
            yield pa.RecordBatch.from_arrays(part, ["h", "blocks", "block", "key", "n", "pivot", "pivot_n"])

    rows = sets.select("key", "n", "heads").mapInArrow(pack, "part long, rows binary").repartition(tasks, "part")
    return written(rows.mapInArrow(gather, "h long, blocks int, block int, key long, n long, pivot long, pivot_n long"), "jaccard-lists")


def _sparse(few: DataFrame, most: int = 1_000_000) -> DataFrame:
    """``few``, a written table of some 16 bytes a row, to be broadcast if it has at most ``most`` rows."""
    return F.broadcast(few) if few.limit(most + 1).count() <= most else few


def _codes(nodes: DataFrame, texts: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, codes) of the sets ``nodes`` (key), made again from a text of each; texts that repeat give several."""
    wanted = _sparse(written(classes.join(nodes, "key").select("place"), "jaccard-wanted"))
    rows = texts.join(wanted, "place").select("text")

    @lean
    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_bytes(batches, 0):
            sets = list(shingle_sets(batch.column(0)))
            keys = pa.array([_key(x) for x in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([keys, pa.array([x.tobytes() for x in sets], pa.binary())], ["key", "codes"])

    return rows.mapInArrow(codes, "key long, codes binary")


def _verified(pairs: DataFrame, texts: DataFrame, classes: DataFrame) -> DataFrame:
    """The links among ``pairs`` (a, b): exact intersections of the sets."""
    nodes = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    sets = written(_codes(nodes, texts, classes), "jaccard-codes")
    left = sets.select(F.col("key").alias("a"), F.col("codes").alias("x"))
    right = sets.select(F.col("key").alias("b"), F.col("codes").alias("y"))
    common = pairs.join(right, "b").join(left, "a").select(
        "a", "b", (F.octet_length("x") / 8 + F.octet_length("y") / 8).alias("sizes"), _shared("x", "y").alias("shared")
    )
    return written(common.where(100 * F.col("shared") >= 75 * (F.col("sizes") - F.col("shared"))).select("a", "b"), "jaccard-links")


def _promising(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Of ``pairs`` (a, b) those whose bitmaps allow a link, with the number of differing bits."""
    left = classes.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("map").alias("x"))
    right = classes.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("map").alias("y"))
    bits = pairs.join(right, "b").join(left, "a").where(_near_sizes(F.col("na"), F.col("nb")))
    # overlap <= (na + nb - bits) / 2, and a link needs 7 * overlap >= 3 * (na + nb)
    return bits.select("a", "b", "na", "nb", _differing("x", "y").alias("bits")).where("na + nb >= 7 * bits").select("a", "b", "bits")


def _pairs(left: dict, right: dict, same: bool) -> Iterator[np.ndarray]:
    """Keys of pairs of different components whose sizes and bitmaps allow a link; ``same``: both are one table.

    Rows of the most frequent component, the bulk of a large group, meet only those of others.
    """
    if not len(left["key"]) or not len(right["key"]):
        return
    kinds, counts = np.unique(left["component"], return_counts=True)
    bulk = kinds[counts.argmax()]
    for wa, (at_a, maps_a) in _groups(left["map"]).items():
        for wb, (at_b, maps_b) in _groups(right["map"]).items():
            if same and wb < wa:
                continue  # the pair of widths comes the other way round
            x, y = _folded(maps_a, min(wa, wb)), _folded(maps_b, min(wa, wb))
            key_a, n_a, c_a = (left[c][at_a] for c in ("key", "n", "component"))
            key_b, n_b, c_b = (right[c][at_b] for c in ("key", "n", "component"))
            others = np.flatnonzero(c_b != bulk)
            for k in range(len(x)):
                rest = others if c_a[k] == bulk else np.flatnonzero(c_b != c_a[k])
                if same and wa == wb and c_a[k] != bulk:
                    rest = rest[np.searchsorted(rest, k) :]
                rest = rest[4 * np.minimum(n_a[k], n_b[rest]) >= 3 * np.maximum(n_a[k], n_b[rest])]
                if not len(rest):
                    continue
                bits = np.bitwise_count(x[k] ^ y[rest]).sum(axis=1)
                keys = key_b[rest[n_a[k] + n_b[rest] >= 7 * bits]]
                if len(keys):
                    yield np.stack([np.minimum(key_a[k], keys), np.maximum(key_a[k], keys)], axis=1)


def _groups_of(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """Rows that are alike in ``by``, of batches sorted by it, also where they go on in the next batch."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
        codes = np.stack([table[c].to_numpy() for c in by])
        cuts = np.flatnonzero((codes[:, 1:] != codes[:, :-1]).any(axis=0)) + 1
        for a, b in zip([0, *cuts], cuts):
            yield table.slice(a, b - a)
        held = table.slice(cuts[-1] if len(cuts) else 0)
    if held is not None and held.num_rows:
        yield held


def _settled(pairs: DataFrame, joined: DataFrame, texts: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, component) after all links among ``pairs`` (a, b, bits), with ``joined`` as those known before.

    Pairs inside a component need no look. First the most promising pair of every two
    components is verified and components are joined by what is found; then all pairs
    of different components that are left.
    """
    for every in (False, True):
        named = _sparse(joined)
        for side in ("a", "b"):
            own = named.select(F.col("node").alias(side), F.col("component").alias(f"c{side}"))
            pairs = pairs.drop(f"c{side}").join(own, side, "left").withColumn(f"c{side}", F.coalesce(f"c{side}", side))
        open_pairs = written(pairs.where("ca != cb"), "jaccard-open")
        if open_pairs.isEmpty():
            break
        if every:
            first = open_pairs.select("a", "b")
        else:
            between = open_pairs.groupBy(F.least("ca", "cb"), F.greatest("ca", "cb"))
            first = written(between.agg(F.min(F.struct("bits", "a", "b")).alias("p")).select("p.a", "p.b"), "jaccard-first")
        found = _verified(first, texts, classes)
        if not found.isEmpty():
            joined = written(components(found, joined), "jaccard-components")
        pairs = open_pairs.join(first, ["a", "b"], "left_anti")
    return joined


def _tiles(rows: DataFrame) -> DataFrame:
    """Pairs that may link in long lists; ``rows`` (h, blocks, block, key, n, component, map).

    A row goes to the tiles of its own block with each other and, as a guest, to those
    of the next size band, bands being powers of 4 / 3.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(4 / 3)) + 1e-9).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    spread = rows.withColumn("band", band).withColumn("other", other).select(
        "*", F.explode(F.array(F.lit(0), F.lit(1))).alias("guest")
    )
    keyed = spread.select(
        "h",
        (F.col("band") + F.col("guest")).alias("band"),
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "block",
        "guest",
        "key",
        "n",
        "component",
        "map",
    )

    tile = ["h", "band", "i", "j"]

    @lean
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups_of(batches, tile):
            if rows.num_rows < 2:
                continue
            cols = {c: rows[c].to_numpy() for c in ("block", "guest", "key", "n", "component")} | {"map": rows["map"].to_pylist()}
            i, j = rows["i"][0].as_py(), rows["j"][0].as_py()

            def part(block: int, guest: int, cols=cols) -> dict:
                at = np.flatnonzero((cols["block"] == block) & (cols["guest"] == guest))
                return {c: [x[k] for k in at] if c == "map" else x[at] for c, x in cols.items()}

            found = [np.zeros((0, 2), np.int64)]
            for one, two in {((i, 0), (j, 0)), ((i, 0), (j, 1)), ((i, 1), (j, 0))}:
                found += _pairs(part(*one), part(*two), one == two)
            pairs = np.unique(np.concatenate(found), axis=0)
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return keyed.repartition(*tile).sortWithinPartitions(*tile).mapInArrow(compare, "a long, b long")


class Links:
    """Counts links between the sets of two blocks, or of one, given as rows with key, n, n_equal, map and codes."""

    def __init__(self, rows: list[dict], apart: int):
        """The rows from ``apart`` on are the second block; with 0 all are one."""
        self.n = np.array([r["n"] for r in rows], np.int64)
        self.equal = np.array([r["n_equal"] for r in rows], np.int64)
        self.apart = apart
        self.groups = _groups([r["map"] for r in rows])
        self.width = np.array([len(r["map"]) for r in rows])
        self.sets = [np.frombuffer(r["codes"], np.uint64) for r in rows]
        self.first = np.concatenate([[0], np.cumsum(self.n)])
        self.words, self.ids = np.unique(np.concatenate(self.sets), return_inverse=True)
        self.seen = np.zeros(len(self.words), bool)

    def _others(self, k: int) -> np.ndarray:
        """Sets of the other block, or after ``k``, whose sizes and bitmaps allow a link with ``k``."""
        found = []
        start = self.apart if self.apart else k + 1
        at, maps = self.groups[self.width[k]]
        own = maps[np.searchsorted(at, k)]
        for width, (at, maps) in self.groups.items():
            rest = np.searchsorted(at, start)
            near = rest + np.flatnonzero(4 * np.minimum(self.n[k], self.n[at[rest:]]) >= 3 * np.maximum(self.n[k], self.n[at[rest:]]))
            if len(near):
                least = min(width, len(own))
                bits = np.bitwise_count(_folded(own[None], least) ^ _folded(maps[near], least)).sum(axis=1)
                found.append(at[near[self.n[k] + self.n[at[near]] >= 7 * bits]])
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def _shared(self, k: int, others: np.ndarray) -> np.ndarray:
        """Sizes of the intersections: place by place in the sorted sets, or for many others by the words of all sets in order."""
        if len(others) < 16:
            return np.array([np.isin(self.sets[j], self.sets[k], assume_unique=True).sum() for j in others], np.int64)
        own = self.ids[self.first[k] : self.first[k + 1]]
        self.seen[own] = True
        low, high = int(others.min()), int(others.max()) + 1
        flat = self.seen[self.ids[self.first[low] : self.first[high]]]
        sums = np.add.reduceat(flat, self.first[low:high] - self.first[low], dtype=np.int64)
        self.seen[own] = False
        return sums[others - low]

    def count(self) -> np.ndarray:
        """How many rows each set's links lead to."""
        links = np.zeros(len(self.n), np.int64)
        for k in range(self.apart or len(self.n)):
            others = self._others(k)
            if len(others):
                shared = self._shared(k, others)
                others = others[100 * shared >= 75 * (self.n[k] + self.n[others] - shared)]
                links[k] += self.equal[others].sum()
                links[others] += self.equal[k]
        return links


def _link_counts(texts: DataFrame, by_key: DataFrame, classes: DataFrame, linked: DataFrame) -> DataFrame:
    """(key, n_links), written: how many rows of other sets the links of each set in ``linked`` lead to."""
    named = linked.select(F.col("node").alias("key"), "component")
    sizes = written(named.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "jaccard-sizes")
    codes = _codes(named.select("key"), texts, classes).groupBy("key").agg(F.first("codes").alias("codes"))
    rows = codes.join(named, "key").join(classes.select("key", "n", "map"), "key").join(by_key.select("key", "n_equal"), "key")
    rows = join_few(rows, sizes, ["component"]).withColumn("block", F.pmod(F.shiftright("key", 8), "blocks").cast("int"))
    tile = ["component", "i", "j"]
    keyed = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "key", "n", "n_equal", "map", "codes"
    )

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups_of(batches, tile):
            i, j = table["i"][0].as_py(), table["j"][0].as_py()
            rows = sorted(table.select(["block", "key", "n", "n_equal", "map", "codes"]).to_pylist(), key=lambda r: r["block"])
            apart = sum(r["block"] == i for r in rows) if i < j else 0
            if len(rows) > 1 and (i == j or 0 < apart < len(rows)):
                keys = pa.array([r["key"] for r in rows], pa.int64())
                yield pa.RecordBatch.from_arrays([keys, pa.array(Links(rows, apart).count())], ["key", "n"])

    counts = keyed.repartition(*tile).sortWithinPartitions(*tile).mapInArrow(count, "key long, n long")
    return written(counts.groupBy("key").agg(F.sum("n").alias("n_links")), "jaccard-counts")


def _linked(texts: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Classes of equal sets (key, n, row, first, n_equal) and one row of each (key, n, map, place), and (node, component) of those that are linked."""
    some = sets.where("n > 0")
    by_key = some.groupBy("key").agg(
        F.min("n").alias("n"), F.min("row").alias("row"), F.min(_first()).alias("first"), F.count("*").alias("n_equal")
    )
    by_key = written(by_key, "jaccard-keys")
    one_each = some.join(_sparse(by_key.select("row")), "row")
    classes = written(one_each.select("key", "n", "map", "place"), "jaccard-classes")
    entries = by_key.agg(F.sum(F.col("n") - F.floor((3 * F.col("n") + 3) / 4) + 1)).first()[0] or 0
    shared = _lists(one_each, entries)
    pivots = shared.where("blocks > 1").select("h", "pivot", "pivot_n").distinct()
    across = pivots.groupBy("h").agg(F.min(F.struct("pivot", "pivot_n")).alias("first")).join(pivots, "h")
    stars = shared.select(F.col("pivot").alias("a"), F.col("key").alias("b"), F.col("pivot_n").alias("na"), F.col("n").alias("nb")).unionByName(
        across.select(F.col("first.pivot").alias("a"), F.col("pivot").alias("b"), F.col("first.pivot_n").alias("na"), F.col("pivot_n").alias("nb"))
    )
    stars = stars.where((F.col("a") != F.col("b")) & _near_sizes(F.col("na"), F.col("nb"))).select("a", "b").distinct()
    best = _promising(stars, classes).groupBy("b").agg(F.min_by("a", F.struct("bits", "a")).alias("a"))
    links = _verified(written(best.select("a", "b"), "jaccard-best"), texts, classes)
    joined = written(components(links), "jaccard-components")
    named = _sparse(joined.select(F.col("node").alias("key"), "component"))
    members = shared.select("h", "blocks", "block", "key", "n").join(named, "key", "left")
    members = members.withColumn("component", F.coalesce("component", "key"))
    lists = members.groupBy("h").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"), F.max("blocks").alias("most")
    )
    lists = lists.where("low < high").select("h", "size", "most")
    members = members.join(lists, "h")
    short = (F.col("size") <= SHORT) & (F.col("most") == 1)
    few = members.where(short).groupBy("h").agg(F.collect_set(F.struct("key", "n", "component")).alias("m"))
    differ = lambda x, y: (x["key"] < y["key"]) & (x["component"] != y["component"]) & _near_sizes(x["n"], y["n"])
    pairs = F.flatten(
        F.transform("m", lambda x: F.transform(F.filter("m", lambda y: differ(x, y)), lambda y: F.struct(x["key"].alias("a"), y["key"].alias("b"))))
    )
    few = few.select(F.explode(pairs).alias("p")).select("p.a", "p.b").distinct()
    long_rows = members.where(~short).select("h", "blocks", "block", "key", "n", "component").distinct()
    many = _tiles(long_rows.join(classes.select("key", "map"), "key"))
    rest = few.unionByName(many).distinct()
    rest = written(_promising(rest, classes), "jaccard-rest")
    return by_key, classes, _settled(rest, joined, texts, classes)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    return texts.select("id", F.xxhash64("id", "text").alias("place"), "text")


def _grouped(texts: DataFrame, count_links: bool = False) -> tuple[DataFrame, DataFrame]:
    """The sets, and for each key of a set with words (key, first, n_equal), ``first`` being that of its component; ``n_links`` if asked."""
    sets = _sets(texts)
    by_key, classes, linked = _linked(texts, sets)
    groups = by_key.join(linked, by_key["key"] == linked["node"], "left").select(
        "key", F.coalesce("component", "key").alias("component"), F.col("first").alias("own"), "n_equal"
    )
    least = groups.groupBy("component").agg(F.min("own").alias("first"))
    groups = groups.join(least, "component").select("key", "first", "n_equal")
    if count_links:
        others = _link_counts(texts, by_key, classes, linked)
        links = F.coalesce("n_links", F.lit(0)) + F.col("n_equal") - 1
        groups = groups.join(others, "key", "left").withColumn("n_links", links)
    return sets, written(groups, "jaccard-groups")


@tidied
def join_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, n_equal, n_links) for each row of ``docs``.

    ``component_id`` is the smallest id that links lead to, the row's own included; a
    link joins two rows whose sets have a Jaccard similarity of at least 0.75.
    ``n_equal`` is the number of rows with the same set, ``n_links`` that of the rows, but
    for itself, that a row is linked with, those of the same set included. A text that is null or has no
    word has the empty set, size 0, and is linked with nothing: its component is its
    own id. Rows may repeat, also their ids; a null id is passed over for the
    component's id, unless the component has no other. The empty table gives an empty
    result; other columns are not looked at.
    """
    sets, groups = _grouped(_texts(docs, id_col, text_col), count_links=True)
    none = F.lit(0).cast("long")
    alone = sets.where("n = 0").select("id", "n", F.col("id").alias("component_id"), none.alias("n_equal"), none.alias("n_links"))
    rest = sets.where("n > 0").select("id", "n", "key").join(groups, "key")
    rest = rest.select("id", "n", F.col("first.id").alias("component_id"), "n_equal", "n_links")
    return rest.unionByName(alone).withColumnRenamed("n", "n_shingles")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component, with its columns as they came; rows without a word all stay.

    That of the smallest id stays, a row without id only where no other has one; of
    rows alike in id and text one stays. Other cases are those of :func:`join_classes`.
    """
    sets, groups = _grouped(_texts(docs, id_col, text_col))
    placed = sets.where("n > 0").select("place", "key").join(groups.select("key", "first"), "key")
    gone = placed.where(F.col("place") != F.col("first.place")).select("place").distinct()
    again = placed.where(F.col("place") == F.col("first.place")).groupBy("place").agg(F.count("*").alias("n")).where("n > 1")
    gone, again = written(gone, "jaccard-gone"), written(again.select("place"), "jaccard-again")
    rows = docs.select(
        F.xxhash64(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit(""))).alias("place"),
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
    )
    rows = rows.join(_sparse(gone), "place", "left_anti")
    once = rows.join(_sparse(again), "place", "left_anti").select("row")
    more = rows.join(_sparse(again), "place", "left_semi").groupBy("place").agg(F.first("row").alias("row")).select("row")
    return once.unionByName(more).select("row.*")

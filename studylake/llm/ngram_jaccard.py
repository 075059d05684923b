"""N-gram Jaccard join: size-banded tiles, bitmap bounds, exact intersection.

A text's set holds the 64-bit hashes of its distinct n-word shingles.  Two
texts link when ``den * |A & B| >= num * |A | B|``.  The steps:

1. *Sets.*  Texts with one set (by a 128-bit digest) collapse to one numbered node.
2. *Size bands.*  A link bounds both the sizes' ratio and the number of
   shingles in which two sets differ.  Inside a band of sizes, the hash space
   is cut into more parts than can differ, so two linked sets agree in a
   non-empty part.  Part hashes lead every set to the sets it may link with,
   and losing a link is impossible (see ``parts``).  There are more parts than
   that needs, so every set leaves out its most popular ones: passages that
   many texts share do not lead them to each other.  What is popular is learnt
   on a bounded sample; it decides the order of parts, not the result.
3. *Families.*  Connected components over equal parts; no link leaves one.
4. *Tiles.*  A family is cut by bands of sizes and hash into blocks of bounded
   bytes; pairs of blocks whose sizes can link are the tiles, dealt out over all
   tasks.  So a huge family becomes many tiles, and none is one task's group.
5. *Screening.*  Members meet in their tiles as hashed bitmaps, a small part of
   their sets' bytes.  Bit counts bound the overlap from above: shingles of A
   whose bit is not set in B cannot be shared.  Only members that pass with
   some partner of a tile bring their sets to that tile.
   *Inside a tile*, pairs that pass the bound are counted exactly by searching
   sorted arrays.  A tile returns a spanning forest of its links and each
   member's number of links, never all pairs.
6. Components over the forests, and over the nodes that one doc_id holds, give
   the classes.

Edge cases: null or empty texts, and texts without words, have an empty set
and link with nothing; a null doc_id has no component; rows that repeat a
doc_id share one node, so they are in one component; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studylake.llm.common import _U, components, grams, groups, kept_until, mix, small_batches, string_buffers, table, words, written

NUM, DEN = 90, 100
SHINGLE = 3
BAND_RATIO = 1.5
#: Parts are added until a set seldom (beyond so many deviations) has so many empty parts that they must be emitted.
SPREAD = 3.1
#: So many times as many parts are cut: the surplus is what a set can leave out.
FINER = 2
#: Texts (about), shingles of a text, and shingles kept as popular: bounds of the sample.  They set how many texts meet, not the result.
SAMPLE_TEXTS = 1 << 14
SAMPLE_SHINGLES = 1 << 11
POPULAR = 1 << 18
#: Bounds of a block: shingles (8 bytes each) and members.  They set the size of a task's work, not the result.
BLOCK_SHINGLES = 1 << 20
BLOCK_MEMBERS = 1024
#: Blocks hold members of sizes within this ratio.
TILE_RATIO = 1.1


class Bands:
    """Size bands for a threshold num/den, and the number of parts of each band."""

    def __init__(self, num: int = NUM, den: int = DEN, ratio: float = BAND_RATIO):
        self.num, self.den = num, den
        # a low threshold allows many differences: narrower bands then keep the parts large
        self.ratio = max(min(ratio, 1 + 5 * (den - num) / den), den / num)
        self.start, self.parts = [1], [1]

    def differ(self, hi: int) -> int:
        """The most shingles in which linked sets of sizes a, b <= hi differ: |A xor B| <= (a + b) (den - num) / (den + num)."""
        return 2 * hi * (self.den - self.num) // (self.den + self.num)

    def _grow(self, size: int) -> None:
        while self.start[-1] <= size:
            lo = self.start[-1]
            hi = max(lo, int(lo * self.ratio))
            d = self.differ(hi)
            spare = 0
            while d and self._empties(lo, d + 1 + spare) >= spare + 1:
                spare += 1
            self.parts[-1] = FINER * (d + 1 + spare)
            self.start.append(hi + 1)
            self.parts.append(0)

    @staticmethod
    def _empties(size: int, k: int) -> float:
        """A number of empty parts that a set of this size seldom exceeds: the occupancy's mean and SPREAD deviations.

        With more parts than shingles the mean nears k - size and the deviation
        falls, so the search for a number of parts always ends.
        """
        none = math.exp(-size / k)
        mean = k * (1 - 1 / k) ** size
        return mean + SPREAD * math.sqrt(max(0.0, k * none * (1 - (1 + size / k) * none)))

    def of(self, size: int) -> list[tuple[int, int, int]]:
        """(band, parts, most parts that differ) in which a set of this size has to appear: its own, and the next if a partner can be there."""
        largest = size * self.den // self.num
        self._grow(largest)
        own, far = bisect.bisect_right(self.start, size) - 1, bisect.bisect_right(self.start, largest) - 1
        out = []
        for b in range(own, far + 1):
            d = self.differ(self.start[b + 1] - 1)
            if d:  # else only equal sets can link there, and those are one set already
                # a partner has size * den / num shingles at most, which bounds the difference by the set's own size
                out.append((b, self.parts[b], min(d, size * (self.den - self.num) // self.num)))
        return out


Popular = tuple[np.ndarray, np.ndarray]
NONE_POPULAR: Popular = np.zeros(0, dtype=_U), np.zeros(0, dtype=np.int64)


def popular(documents: DataFrame, n: int) -> Popular:
    """(sorted shingle hashes, number of texts) of the shingles that several texts of a sample hold, the most frequent POPULAR at most.

    The tasks make the sample's sets, at most SAMPLE_SHINGLES of a set; one task counts them.
    """
    def some(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 250):
                sets = [s[:SAMPLE_SHINGLES].tobytes() for s in sets_of(b.column("text").slice(lo, 250), n)]
                yield pa.RecordBatch.from_arrays([pa.array([b"".join(sets)], pa.binary())], ["shingles"])

    def count(batches):
        held = [np.frombuffer(x.as_buffer(), dtype=_U) for b in batches for x in b.column("shingles")]
        if held:
            shingle, texts = np.unique(np.concatenate(held), return_counts=True)
            most = np.sort(np.argsort(-texts, kind="stable")[:min(POPULAR, int((texts > 1).sum()))])
            yield pa.RecordBatch.from_arrays([pa.array([shingle[most].tobytes()], pa.binary()), pa.array([texts[most].astype(np.int64).tobytes()], pa.binary())], ["shingles", "texts"])

    rows = documents.count()
    texts = documents.select("text")
    got = (texts.sample(SAMPLE_TEXTS / rows, 1) if rows > SAMPLE_TEXTS else texts).mapInArrow(some, "shingles binary").repartition(1).mapInArrow(count, "shingles binary, texts binary").collect()
    return (np.frombuffer(got[0]["shingles"], dtype=_U), np.frombuffer(got[0]["texts"], dtype=np.int64)) if got else NONE_POPULAR


def parts(shingles: np.ndarray, bands: Bands, known: Popular = NONE_POPULAR) -> np.ndarray:
    """Part hashes of a sorted set: of its non-empty parts the d + 1 that come first, least popular ones before others.

    Linked sets agree in all but d parts (d: the most shingles that can
    differ).  So of two linked sets' non-empty parts at most d differ, and a
    set's first d + 1 hold one that agrees.  The order is one of the parts'
    contents, the same for all sets: of the two sets, the one whose first parts
    end earlier holds an agreeing part that is among the other's first too,
    whatever the order is.  It goes by the ``known`` number of texts of a part's
    rarest shingle, then by size, as large parts seldom agree by chance.

    A set with d non-empty parts or fewer emits all parts, so that agreeing in
    empty parts is found too.
    """
    out = []
    texts = np.zeros(len(shingles), dtype=np.int64)
    if len(known[0]):
        at = np.minimum(np.searchsorted(known[0], shingles), len(known[0]) - 1)
        texts = np.where(known[0][at] == shingles, known[1][at], 0)
    total = np.zeros(len(shingles) + 1, dtype=_U)
    np.cumsum(mix(shingles + _U(0x51ED270B)), out=total[1:])
    top = shingles >> _U(32)
    for band, k, d in bands.of(len(shingles)):
        edge = np.searchsorted((top * _U(k)) >> _U(32), np.arange(k + 1, dtype=_U))
        full = edge[1:] > edge[:-1]
        key = mix((total[edge[1:]] - total[edge[:-1]]) ^ mix(np.arange(k, dtype=_U) + (_U(band + 1) << _U(32))))
        if full.sum() > d:
            key, size, rarest = key[full], (edge[1:] - edge[:-1])[full], np.minimum.reduceat(texts, edge[:-1][full])
            key = key[np.lexsort((key, -size, rarest))[:d + 1]]
        out.append(key)
    return np.concatenate(out) if out else np.zeros(0, dtype=_U)


def sets_of(column, n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text of an Arrow column."""
    data, off = string_buffers(column)
    h, _, _, first = words(data, off)
    g, at = grams(h, first, n)
    edge = np.searchsorted(at, first)
    return [np.unique(g[edge[i]:edge[i + 1]]) for i in range(len(off) - 1)]


def digest(s: np.ndarray) -> bytes:
    return int(mix(s).sum(dtype=_U)).to_bytes(8, "little") + int(mix(s ^ _U(0xA5A5A5A5A5A5A5A5)).sum(dtype=_U)).to_bytes(8, "little")


def signature(s: np.ndarray) -> bytes:
    """Packed bitmap of a set: bit (hash modulo the number of bits) for every shingle."""
    bits = 1 << int(np.clip(np.ceil(np.log2(2 * max(len(s), 1))), 9, 15))
    m = np.zeros(bits, dtype=bool)
    m[(s & _U(bits - 1)).astype(np.int64)] = True
    return np.packbits(m, bitorder="little").tobytes()


def _bitmaps(packed: list[bytes], n_bytes: int) -> np.ndarray:
    """Bitmaps as a matrix of 0 and 1, folded to ``n_bytes`` bytes each."""
    rows = [np.bitwise_or.reduce(np.frombuffer(p, dtype=np.uint8).reshape(-1, n_bytes), axis=0) for p in packed]
    return np.unpackbits(np.stack(rows), axis=1, bitorder="little").astype(np.float32)


def _screened(members: DataFrame, num: int, den: int) -> DataFrame:
    """(rep, tile) of ``members`` (tile, side, rep, n, bitmap) that may link with another member of the tile's other block."""
    def run(batches):
        for t in groups(batches, "tile"):
            rep, n, side = (t[c].to_numpy() for c in ("rep", "n", "side"))
            packed = t["bitmap"].to_pylist()
            at_l, at_r = (np.arange(len(rep)),) * 2 if (side == 0).all() else (np.flatnonzero(side == 1), np.flatnonzero(side == 2))
            if not len(at_l) or not len(at_r):
                continue
            maps = _bitmaps(packed, min(map(len, packed)))
            a, b, size_a, size_b = maps[at_l], maps[at_r], n[at_l].astype(np.float64), n[at_r].astype(np.float64)
            bound = np.minimum((size_a - a.sum(1))[:, None], (size_b - b.sum(1))[None, :]) + a @ b.T
            maybe = ((den + num) * bound >= num * (size_a[:, None] + size_b[None, :])) & (rep[at_l][:, None] != rep[at_r][None, :])
            keep = np.unique(np.r_[rep[at_l[maybe.any(1)]], rep[at_r[maybe.any(0)]]])
            if len(keep):
                yield pa.RecordBatch.from_arrays([pa.array(keep), pa.array(np.full(len(keep), t["tile"][0].as_py()))], ["rep", "tile"])

    return members.repartition("tile").sortWithinPartitions("tile").mapInArrow(run, "rep bigint, tile bigint")


def _sets_frame(documents: DataFrame, n: int, num: int, den: int, known: Popular = NONE_POPULAR) -> DataFrame:
    def run(batches):
        bands = Bands(num, den)
        for b in batches:
            for lo in range(0, b.num_rows, 250):
                part = b.slice(lo, 250)
                sets = sets_of(part.column("text"), n)
                keys = [parts(s, bands, known) for s in sets]
                off = np.cumsum([0] + [len(k) for k in keys])
                flat = np.concatenate(keys) if keys else np.zeros(0, dtype=_U)
                yield pa.RecordBatch.from_arrays([
                    *[part.column(c) for c in kept], pa.array([len(s) for s in sets], pa.int64()), pa.array([digest(s) for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(flat.view(np.int64))),
                    pa.array([signature(s) for s in sets], pa.binary())], [*kept, "n", "digest", "keys", "bitmap"])

    kept = [c for c in ("doc_id", "row") if c in documents.columns]
    return (documents.withColumn("doc_id", F.col("doc_id").cast("bigint")).select(*kept, "text")
            .mapInArrow(run, f"doc_id bigint, {'row string, ' if 'row' in kept else ''}n bigint, digest binary, keys array<bigint>, bitmap binary"))


def _arrays_frame(texts: DataFrame, n: int) -> DataFrame:
    """Adds the sorted set of the text, where it is the set that the row asks for."""
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 250):
                part = b.slice(lo, 250)
                sets = sets_of(part.column("text"), n)
                keep = pa.array([digest(s) == d for s, d in zip(sets, part.column("digest").to_pylist(), strict=True)], pa.bool_())
                out = pa.RecordBatch.from_arrays([part.column("rep"), part.column("mult"), part.column("tiles"), pa.array([s.tobytes() for s in sets], pa.binary())],
                                                 schema=pa.schema([part.schema.field("rep"), part.schema.field("mult"), part.schema.field("tiles"), pa.field("shingles", pa.binary())]))
                yield out.filter(keep)

    return texts.select("rep", "mult", "tiles", "digest", "text").mapInArrow(run, "rep bigint, mult bigint, tiles array<struct<tile:bigint,side:int>>, shingles binary")


def overlap_bound(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Upper bounds of |A & B| for all pairs of a tile, from the bit counts of hashed bitmaps."""
    bits = 1 << int(np.clip(np.ceil(np.log2(2 * max(map(len, left + right)))), 9, 15))

    def bitmap(sets):
        m = np.zeros((len(sets), bits), dtype=np.float32)
        m[np.repeat(np.arange(len(sets)), [len(s) for s in sets]), (np.concatenate(sets) & _U(bits - 1)).astype(np.int64)] = 1
        return m

    a = bitmap(left)
    b = a if right is left else bitmap(right)
    common = a @ b.T
    sizes = [np.array([len(s) for s in x], dtype=np.float32) for x in (left, right)]
    return np.minimum((sizes[0] - a.sum(1))[:, None], (sizes[1] - b.sum(1))[None, :]) + common


def tile_links(left: list[np.ndarray], right: list[np.ndarray], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) of the links of a tile; for a diagonal tile (right is left) with i < j."""
    found = []
    size_l, size_r = np.array([len(s) for s in left]), np.array([len(s) for s in right])
    bound = overlap_bound(left, right)
    maybe = (den + num) * bound >= num * (size_l[:, None] + size_r[None, :])
    if right is left:
        maybe = np.triu(maybe, 1)
    for i in np.flatnonzero(maybe.any(1)):
        js = np.flatnonzero(maybe[i])
        flat = np.concatenate([right[j] for j in js])
        at = np.searchsorted(left[i], flat)
        hit = np.r_[0, np.cumsum(left[i][np.minimum(at, size_l[i] - 1)] == flat)]
        edge = np.r_[0, np.cumsum(size_r[js])]
        shared = hit[edge[1:]] - hit[edge[:-1]]
        js = js[(den + num) * shared >= num * (size_l[i] + size_r[js])]
        found.append(np.column_stack([np.full(len(js), i), js]))
    out = np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)
    return out[:, 0], out[:, 1]


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = up
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = find(x), find(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def _verified(tiles: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b, links): forest edges (links 0) and each member's number of links (a = b), from rows sorted by tile."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])

    def run(batches):
        edges: list[tuple[int, int, int]] = []
        for t in groups(batches, "tile"):
            t = t.take(np.unique(t["rep"].to_numpy(), return_index=True)[1])  # a text comes once for each row that repeats it with its doc_id
            rep, mult, side = (t[c].to_numpy() for c in ("rep", "mult", "side"))
            sets = [np.frombuffer(x.as_buffer(), dtype=_U) for x in t["shingles"].combine_chunks()]
            if (side == 0).all():
                at_l = at_r = np.arange(len(rep))
                left = right = sets
            else:
                at_l, at_r = np.flatnonzero(side == 1), np.flatnonzero(side == 2)
                left, right = [sets[i] for i in at_l], [sets[i] for i in at_r]
            if len(left) and len(right):
                i, j = tile_links(left, right, num, den)
                i, j = at_l[i], at_r[j]
                other = rep[i] != rep[j]
                i, j = i[other], j[other]
                edges += [(x, y, 0) for x, y in _forest(rep[i], rep[j])]
                count = np.bincount(i, mult[j], len(rep)) + np.bincount(j, mult[i], len(rep))
                edges += [(int(rep[k]), int(rep[k]), int(count[k])) for k in np.flatnonzero(count)]
            if len(edges) > 10_000:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, e, strict=True)) for e in edges], schema)
                edges = []
        if edges:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, e, strict=True)) for e in edges], schema)

    return tiles.repartition("tile").sortWithinPartitions("tile").mapInArrow(run, "a bigint, b bigint, links bigint")


#: Keys that a task sorts at a time; a bound of its memory, not of the result.
KEY_BLOCK = 1 << 22


def _key_rows(rows: DataFrame) -> DataFrame:
    """(key, uid): the least row of every key of a block of rows, and the other rows under a key of their own with it.

    Rows that agree are joined where they are read: a key that a third of all rows hold is shuffled once a block.
    """
    def block(uid: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((uid, key))
        uid, key = uid[order], key[order]
        start = np.r_[True, key[1:] != key[:-1]]
        least = uid[start][np.cumsum(start) - 1]
        pairs = np.unique(np.column_stack([least, uid])[~start & (least != uid)], axis=0)
        # the pair's own key leads only to other rows that go with the same least row
        own = mix(pairs[:, 0].astype(_U) ^ _U(0xC2B2AE3D27D4EB4F)).view(np.int64)
        heads, at = np.unique(pairs[:, 0], return_index=True)
        return pa.record_batch({"key": pa.array(np.r_[key[start], own, own[at]]), "uid": pa.array(np.r_[uid[start], pairs[:, 1], heads])})

    def run(batches):
        uids, keys, size = [], [], 0
        for b in batches:
            col = b.column("keys")
            uids.append(np.repeat(b.column("uid").to_numpy(), np.diff(col.offsets.to_numpy())))
            keys.append(col.flatten().to_numpy())
            size += len(keys[-1])
            if size >= KEY_BLOCK:
                yield block(np.concatenate(uids), np.concatenate(keys))
                uids, keys, size = [], [], 0
        if size:
            yield block(np.concatenate(uids), np.concatenate(keys))

    return rows.select("uid", "keys").mapInArrow(run, "key bigint, uid bigint")


def tiles_of(members: DataFrame, num: int, den: int) -> DataFrame:
    """(rep, tiles: array of (tile, side)) from ``members`` (family, rep, n); side 0: diagonal tile, 1 and 2: the two blocks.

    A block holds members of one family and one band of sizes, chosen by hash;
    their number follows from pre-aggregated sums, so no task sees a family.
    Placed members and blocks are written, as several joins read them: else
    one plan repeats all that leads to them for each of those joins.
    """
    weight = F.greatest(F.col("n"), F.lit(BLOCK_SHINGLES // BLOCK_MEMBERS))
    band = F.floor(F.log("n") / math.log(TILE_RATIO))
    banded = members.withColumn("band", band)
    many = banded.groupBy("family", "band").agg(F.ceil(F.sum(weight) / BLOCK_SHINGLES).alias("many"))
    placed = banded.join(many, ["family", "band"]).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("many"))).drop("many")
    placed = written(placed, "jaccard-placed")
    blocks = written(placed.groupBy("family", "band", "block").agg(F.min("n").alias("lo"), F.max("n").alias("hi")), "jaccard-blocks")
    a, b = blocks.alias("a"), blocks.alias("b")
    pairs = (a.join(b, F.col("a.family") == F.col("b.family"))
             .where(F.expr(f"(a.band, a.block) = (b.band, b.block) or (a.band, a.block) < (b.band, b.block) and {den} * a.hi >= {num} * b.lo and {den} * b.hi >= {num} * a.lo"))
             .select(F.col("a.family").alias("family"), *[F.col(f"{x}.{c}").alias(f"{x}_{c}") for x in "ab" for c in ("band", "block")]))
    own = F.expr("(a_band, a_block) = (b_band, b_block)")
    tile = F.xxhash64("family", "a_band", "a_block", "b_band", "b_block").alias("tile")

    def side(x: str, k):
        return F.struct(F.col(f"{x}_band").alias("band"), F.col(f"{x}_block").alias("block"), F.struct(tile, k.alias("side")).alias("t"))

    sides = (pairs.select("family", F.explode(F.when(own, F.array(side("a", F.lit(0)))).otherwise(F.array(side("a", F.lit(1)), side("b", F.lit(2))))).alias("s"))
             .groupBy("family", "s.band", "s.block").agg(F.collect_list("s.t").alias("tiles")))
    return placed.join(sides, ["family", "band", "block"]).select("rep", "tiles")


def link(documents: DataFrame, n: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) per row of ``documents`` (doc_id, text)."""
    rows, sets = _linked(documents, n, num, den, True)
    return (rows.join(sets, "digest", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("low"))).otherwise(F.col("doc_id")).alias("component_id"),
                    F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("links")).otherwise(F.lit(0)).alias("n_links")))


def text_classes(documents: DataFrame, n: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """(doc_id, row, class, low) per row of ``documents`` (doc_id, text, row) that can link: the class of its text, and the class's smallest doc_id.

    Other texts of the same doc_id do not join classes.
    """
    rows, sets = _linked(documents, n, num, den, False)
    return rows.where("n > 0 and doc_id is not null").join(sets, "digest").select("doc_id", "row", "class", "low")


def _linked(documents: DataFrame, n: int, num: int, den: int, by_id: bool) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, n, digest; row if given), and (digest, class, low, links) of every set; ``by_id``: sets of one doc_id are in one class."""
    small_batches(documents.sparkSession)
    full, drop_keys = kept_until(_sets_frame(documents, n, num, den, popular(documents, n)).withColumn("uid", F.monotonically_increasing_id()), "jaccard-sets")
    rows = written(full.drop("keys", "bitmap"), "jaccard-rows")
    some = rows.where("n > 0 and doc_id is not null")
    # rep: the set's node, the number of one of its rows, as an id may hold several sets; doc: that row's id, to find the text again
    reps = written(some.groupBy("digest").agg(F.min(F.struct("uid", "doc_id")).alias("first"), F.count("*").alias("mult"), F.max("n").alias("n"))
                   .select("digest", F.col("first.uid").alias("rep"), F.col("first.doc_id").alias("at"), "mult", "n"), "jaccard-reps")
    low_doc = some.groupBy("digest").agg(F.min("doc_id").alias("doc"))
    # one exchange of the keys: the least row of a key and the rows it leads to come from the same partitions
    keys = _key_rows(full.where("n > 0 and doc_id is not null").select("uid", "keys")).repartition("key")
    first = keys.groupBy("key").agg(F.min("uid").alias("first"), F.max("uid").alias("last")).where("first != last").select("key", "first")
    agree = keys.join(first.hint("merge"), "key").where("uid != first").select(F.col("uid").alias("src"), F.col("first").alias("dst")).distinct()
    same = some.join(reps.where("mult > 1").select("digest", "rep"), "digest").where("uid != rep").select(F.col("uid").alias("src"), F.col("rep").alias("dst"))
    agree = written(agree, "jaccard-agree")
    linked = written(components(agree.unionByName(same)), "jaccard-families")
    families = linked.join(reps.select(F.col("rep").alias("node")), "node", "left_semi")
    # a family of one set has nothing to compare
    several = families.groupBy("component").agg(F.count("*").alias("sets")).where("sets > 1").select("component")
    members = (families.join(several, "component").select(F.col("node").alias("rep"), F.col("component").alias("family"))
               .join(reps.withColumnRenamed("at", "doc"), "rep"))
    members = written(members, "jaccard-members")
    wanted = written(members.select("rep", "doc", "mult", "digest").join(tiles_of(members.select("family", "rep", "n"), num, den), "rep"), "jaccard-tiles")
    bitmaps = full.select(F.col("uid").alias("rep"), "n", "bitmap")
    meet = wanted.join(bitmaps, "rep").select("rep", "n", "bitmap", F.explode("tiles").alias("t")).select("t.tile", "t.side", "rep", "n", "bitmap")
    screened = _screened(meet, num, den).groupBy("rep").agg(F.collect_set("tile").alias("passed"))
    wanted = wanted.join(screened, "rep").select("rep", "doc", "mult", "digest", F.filter("tiles", lambda t: F.array_contains("passed", t["tile"])).alias("tiles"))
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc"), "text").join(wanted, "doc")
    arrays = _arrays_frame(texts, n)
    tiles = arrays.select("rep", "mult", "shingles", F.explode("tiles").alias("t")).select(F.col("t.tile").alias("tile"), F.col("t.side").alias("side"), "rep", "mult", "shingles")
    found = written(_verified(tiles, num, den), "jaccard-links")
    drop_keys()
    edges = found.where("a != b").select(F.col("a").alias("src"), F.col("b").alias("dst"))
    if by_id:
        held = some.groupBy("doc_id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).where("lo != hi").select("doc_id")
        held = some.select("doc_id", "digest").join(held, "doc_id").join(reps.select("digest", "rep"), "digest").select("doc_id", "rep").distinct()
        edges = edges.unionByName(held.join(held.groupBy("doc_id").agg(F.min("rep").alias("dst")), "doc_id").select(F.col("rep").alias("src"), "dst"))
    classes = components(edges).select(F.col("node").alias("rep"), "component")
    counts = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    reps = reps.join(low_doc, "digest")
    of_set = (reps.select("digest", "rep", "mult", "doc").join(classes, "rep", "left").join(counts, "rep", "left")
              .select("digest", F.coalesce("component", "rep").alias("class"), "doc", "component",
                      (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("links")))
    low = reps.join(classes, "rep").groupBy("component").agg(F.min("doc").alias("low"))
    sets = of_set.join(low, "component", "left").select("digest", "class", F.coalesce("low", "doc").alias("low"), "links")
    return rows.drop("uid"), sets


def op8_bitmap_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "documents"))


SQL = r"""
with recursive w as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
s as (select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
  else list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) end as s from w),
g as (select doc_id, len(s) as n, unnest(s) as g from s),
p as (select a.doc_id as x, b.doc_id as y from g a join g b on a.g = b.g and a.doc_id < b.doc_id and 100 * a.n >= 90 * b.n and 100 * b.n >= 90 * a.n
  group by 1, 2 having 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))),
e as (select x, y from p union all select y, x from p),
r as (select x as node, y as other from e union select r.node, e.y from r join e on r.other = e.x)
select s.doc_id, len(s.s)::bigint as n_shingles, least(s.doc_id, coalesce(c.low, s.doc_id)) as component_id, coalesce(k.n, 0)::bigint as n_links
from s left join (select node, min(other) as low from r group by 1) c on s.doc_id = c.node left join (select x, count(*) as n from e group by 1) k on s.doc_id = k.x
"""

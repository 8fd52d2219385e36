"""N-gram Jaccard join: documents whose sets of word n-grams overlap by ``num / den`` or more, and the
groups these links form.

A set is a sorted array of 64-bit shingle hashes; equal sets are one node, so copies never meet each
other.  Work is tiled so that no link is lost and no all-pairs join is made:

1. Size bands: linked sets differ in size by at most ``num / den``, so bands growing by that ratio
   hold a pair in the same or in neighbouring bands.  In its own band and as a guest of the next, a
   set's bitmap signature (one bit for each hash) is cut into segments, more of them than a linked
   pair may differ in bits: at least one segment of a linked pair is equal.  A tile is the sets of a
   band that share a segment.  Segments with fewer than two bits set, which say little, are left out
   by sets that have no more of them than there are spare segments (the pair then still shares
   another one); sets with more keep them all.
2. Each tile links its smallest member to the others (a star, as many pairs as members).  A hashed
   bitmap of each set bounds the overlap of a pair from above by bit counts,
   ``(|A| + |B| - popcount(a xor b)) / 2``; only pairs that could reach the ratio are checked, by
   intersecting their sorted arrays.
3. Connected components of those links.  Tiles that still hold more than one component are cut into
   blocks of bounded size, in which members show a folded bitmap (a bound as well, if a looser one).
   Of tiles with the same members one is enough.  Within each pair of blocks the pairs across components
   pass the same bit count bound and exact check: in a first round the likeliest pair of each node, which
   joins most components that belong together (as in Boruvka's algorithm), then all pairs that are left
   of the nodes that were in one not sent, tile by tile.  In this round members show whole bitmaps, so that only
   pairs close to the ratio leave a tile, however many of its texts are somewhat alike.  Every pair that
   shares a tile is thereby joined by verified links or tested itself.

Tiles (1) and blocks (3) are shuffled in as many passes as their bytes need; what a pass has shuffled is released
before the next, and each tile is in one pass.

Defined results: null or empty texts and texts without words have an empty set, are linked with
nothing and are their own group; texts of fewer words than n have one shingle, the whole sequence;
ties and repeated rows share a set; a null id is kept, and a group's id is its least non-null id; an
empty table gives no rows.  Hash collisions (64 bits) are the only deviation from exact sets.
Only the id and the text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import fs
from .common import KEY, Words, as_large, key_columns, release, slices
from .components import connected_components

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
#: sets remembered by a task so that copies in one task send their segments once
_SEEN = 200_000
#: rows of a tile that one block holds
BLOCK = 2048
#: bytes that a shuffle of tiles may take in one pass, at least: more tiles than that are worked on in several passes
PASS_BYTES = 64 << 20
#: pairs of rows, and words of their bitmaps, that are compared at once
PAIRS, WORDS = 1 << 17, 1 << 19


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _A
        x = (x ^ (x >> np.uint64(27))) * _B
        return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all texts, start of each text's with the total appended)."""
    words = Words(texts, lower=True)
    hashed = np.array([xxhash.xxh3_64_intdigest(w) for w in words.distinct] or [0], dtype=np.uint64)
    w, counts, starts = hashed[words.codes], words.counts, words.starts
    with np.errstate(over="ignore"):
        chain = np.zeros(max(len(w) - n + 1, 0), np.uint64) + np.uint64(n)
        for i in range(n):
            chain = _mix(chain) * _C + w[i:i + len(chain)]
        chain = _mix(chain)
    size = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    ends = np.concatenate(([0], np.cumsum(size)))
    take = np.repeat(starts[:-1] - ends[:-1], size) + np.arange(ends[-1])
    out = np.zeros(ends[-1], np.uint64)
    full = np.repeat(counts >= n, size)
    out[full] = chain[take[full]]
    for i in np.flatnonzero((counts > 0) & (counts < n)).tolist():  # at most n - 1 words each
        h = np.uint64(counts[i])
        with np.errstate(over="ignore"):
            for x in w[starts[i]:starts[i + 1]]:
                h = _mix(np.array([h]))[0] * _C + x
        out[ends[i]] = _mix(np.array([h]))[0]
    keep = np.ones(len(out), bool)
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        part = out[a:b]
        part.sort()
        keep[a + 1:b] = part[1:] != part[:-1]
    kept = np.concatenate(([0], np.cumsum(keep)))
    return out[keep], kept[ends]


def bitmap_words(size: int) -> int:
    """64-bit words of the bitmap of a set: eight bits an element or more, 8 to 128 words; sets that may
    be linked can have different lengths, so the longer is folded to the shorter."""
    return min(128, max(8, 1 << max(0, size // 8 - 1).bit_length()))


class Bands:
    """Size bands of a ratio: upper sizes, segments and spare segments of each."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.upper, self.segments, self.spare = [0], [1], [0]

    def reach(self, size: int) -> None:
        while self.upper[-1] < size:
            u = max(self.upper[-1] + 1, self.upper[-1] * self.den // self.num)
            differ = (self.den - self.num) * 2 * u // (self.den + self.num)
            spare = 1 + (differ + 1) // 16 if differ else 0
            self.upper.append(u)
            self.segments.append(differ + 1 + spare)
            self.spare.append(spare)


def segment_keys(sets: np.ndarray, starts: np.ndarray, band: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """(tile keys, document of each) of the sets in the given bands."""
    size = np.diff(starts)
    count, spare = (np.array(x, dtype=np.int64)[band] for x in (bands.segments, bands.spare))
    base = np.concatenate(([0], np.cumsum(count)))
    doc = np.repeat(np.arange(len(size)), size)
    # segments cut the hash range evenly, so a sorted set meets them in order
    at = base[:-1][doc] + ((sets >> np.uint64(32)) * count.astype(np.uint64)[doc] >> np.uint64(32)).astype(np.int64)
    filled = np.bincount(at, minlength=base[-1])
    total = np.zeros(base[-1], np.uint64)
    if len(at):
        first = np.flatnonzero(np.diff(at, prepend=-1))
        total[at[first]] = np.add.reduceat(_mix(sets), first)
    owner = np.repeat(np.arange(len(size)), count)
    weak = filled < 2
    n_weak = np.bincount(owner[weak], minlength=len(size))
    keep = (~weak | (n_weak > spare)[owner]) & (size > 0)[owner] & (count > 1)[owner]
    with np.errstate(over="ignore"):
        salt = band[owner].astype(np.uint64) * _B + (np.arange(base[-1]) - base[:-1][owner]).astype(np.uint64) * _C
        keys = _mix(total + _mix(salt))
    return keys[keep], owner[keep]


def bitmaps(sets: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    out = []
    position = _mix(sets + _C)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        bits = np.zeros(64 * bitmap_words(b - a), np.uint8)
        bits[(position[a:b] & np.uint64(len(bits) - 1)).astype(np.int64)] = 1
        out.append(np.packbits(bits, bitorder="little").view("<u8"))
    return out


def overlap_bound(size_a: np.ndarray, size_b: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Upper bound on the overlap of pairs from their bitmaps (rows of 64-bit words, equal widths)."""
    differ = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
    return np.minimum(np.minimum(size_a, size_b), (size_a + size_b - differ) // 2)


def _fold(bits: np.ndarray, words: int) -> np.ndarray:
    """A bitmap at fewer words: bit i goes to bit i mod the new length, as if hashed so at first."""
    return np.bitwise_or.reduce(bits.reshape(-1, words), axis=0)


@lru_cache(maxsize=8)
def _bands(num: int, den: int) -> Bands:
    return Bands(num, den)


def _sketch(n: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen = _bands(num, den), {}
        for batch in batches:
            texts = as_large(batch.column(3))
            for a, b in slices(texts):
                sets, starts = shingle_sets(texts[a:b], n)
                size = np.diff(starts)
                bands.reach(int(size.max(initial=0)))
                bands.reach(bands.upper[-1] + 1)  # the next band, for guests
                nodes = [xxhash.xxh3_64_intdigest(sets[s:e].tobytes()) if e > s else None
                         for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
                fresh = []
                for x in nodes:
                    fresh.append(x is not None and x not in seen)
                    if x is not None:
                        seen[x] = None
                        if len(seen) > _SEEN:
                            seen.pop(next(iter(seen)))
                own = np.searchsorted(np.array(bands.upper), size)
                (k1, d1), (k2, d2) = (segment_keys(sets, starts, band, bands) for band in (own, own + 1))
                keys, doc = np.concatenate((k1, k2)), np.concatenate((d1, d2))
                use = np.array(fresh, bool)[doc]
                keys, doc = keys[use], doc[use]
                keys = keys[np.argsort(doc, kind="stable")].view(np.int64)
                cuts = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=b - a)))).astype(np.int32)
                maps = bitmaps(sets, starts)
                at = np.concatenate(([0], np.cumsum([len(m) for m in maps]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(i)[a:b] for i in range(3)), pa.array(size, pa.int64()),
                    pa.array([None if x is None else x - (1 << 63) for x in nodes], pa.int64()),
                    pa.ListArray.from_arrays(at, pa.array(np.concatenate(maps).view(np.int64) if maps else [], pa.int64())),
                    pa.ListArray.from_arrays(cuts, pa.array(keys, pa.int64()))],
                    names=["_id", "_null", "_h", "n_shingles", "node", "bits", "tiles"])
    return run


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (tile, node) in order -> (tile, centre, node) for every node but its tile's first."""
    last_tile = last_centre = last_node = None
    for batch in batches:
        tile, node = (c.to_numpy() for c in batch.columns)
        if not len(tile):
            continue
        first = np.diff(tile, prepend=tile[0] + (0 if last_tile == tile[0] else 1)) != 0
        group = np.cumsum(first)  # 0: the tile that the last batch ended in
        centres = np.concatenate(([0 if last_centre is None else last_centre], node[first]))
        centre = centres[group]
        repeated = np.zeros(len(tile), bool)
        repeated[1:] = (node[1:] == node[:-1]) & ~first[1:]
        repeated[0] = not first[0] and last_node == node[0]
        out = (node != centre) & ~repeated
        last_tile, last_centre, last_node = int(tile[-1]), int(centre[-1]), int(node[-1])
        yield pa.RecordBatch.from_arrays([pa.array(x[out]) for x in (tile, centre, node)],
                                         names=["tile", "centre", "node"])


def _set_arrays(n: int):
    def run(texts: pa.Array) -> pa.Array:
        out, texts = [], as_large(texts)
        for a, b in slices(texts):
            sets, starts = shingle_sets(texts[a:b], n)
            raw, starts = sets.tobytes(), (8 * starts).tolist()
            out += [raw[s:e] for s, e in zip(starts, starts[1:])]
        return pa.array(out, pa.binary())

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "binary")


def _linked(num: int, den: int):
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(a, b, strict=True):
            x, y = (np.frombuffer(v.as_buffer(), "<u8") for v in (x, y))
            at = np.searchsorted(y, x)
            both = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0
            out.append(den * both >= num * (len(x) + len(y) - both))
        return pa.array(out, pa.bool_())

    run.__annotations__ = {"a": pa.Array, "b": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "boolean")


def _at_width(bits: pa.ListArray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(bitmaps of ``words`` words of all rows that have as many or more, each row's place among them or -1)."""
    at = bits.offsets.to_numpy().astype(np.int64)
    flat, size = bits.values.to_numpy().view(np.uint64), np.diff(at)
    place = np.full(len(size), -1, np.int64)
    parts, n = [np.zeros((0, words), np.uint64)], 0
    for width in np.unique(size[size >= words]).tolist():
        some = np.flatnonzero(size == width)
        whole = flat[at[:-1][some][:, None] + np.arange(width)]
        parts.append(np.bitwise_or.reduce(whole.reshape(len(some), width // words, words), axis=1))
        place[some] = n + np.arange(len(some))
        n += len(some)
    return np.concatenate(parts), place


def _across(num: int, den: int, most_likely: int | None):
    """Rows (tile, blocks, side, node, size, label, bits), one block pair after another, side 0 first -> pairs of
    nodes of different components whose bit counts leave the ratio possible; with ``most_likely``,
    for each node only that many, those of the highest bounds, and (as u, more) the nodes of the others with their tiles."""
    sent: set[tuple[int, int]] = set()

    def able(size: np.ndarray, width: np.ndarray, bits: pa.ListArray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the pairs of rows i and j could reach the ratio, the bound on the overlap of each)."""
        most, words = np.zeros(len(i), np.int64), np.minimum(width[i], width[j])
        for w in np.unique(words).tolist():
            some = np.flatnonzero(words == w)
            maps, place = matrices[w] if w in matrices else matrices.setdefault(w, _at_width(bits, w))
            for k in range(0, len(some), max(1, WORDS // w)):
                part = some[k:k + max(1, WORDS // w)]
                a, b = i[part], j[part]
                most[part] = overlap_bound(size[a], size[b], maps[place[a]], maps[place[b]])
        return den * most >= num * (size[i] + size[j] - most), most

    matrices: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def pairs(rows: pa.RecordBatch) -> tuple[list[int], list[int], list[int], list[int]]:
        tile, blocks, side, node, size, label = (c.to_numpy() for c in rows.columns[:6])
        bits = rows.column(6)
        width = np.diff(bits.offsets.to_numpy()).astype(np.int64)
        matrices.clear()
        first = np.concatenate(([True], (tile[1:] != tile[:-1]) | (blocks[1:] != blocks[:-1])))
        group = np.cumsum(first) - 1
        ends = np.append(np.flatnonzero(first)[1:], len(tile))
        other = ends - np.bincount(group, weights=side).astype(np.int64)  # where side 1 begins
        left = np.flatnonzero(side == 0)
        # a row of side 0 meets side 1, or within one block the rows behind it
        begin = np.where(other[group[left]] < ends[group[left]], other[group[left]], left + 1)
        count = ends[group[left]] - begin
        total = np.cumsum(count)
        out: tuple[list[int], list[int]] = ([], [])
        pending = np.zeros(len(tile), bool)  # rows in a pair that is not sent
        k = 0
        while k < len(left):
            # as many rows as have about PAIRS pairs, one at least
            stop = max(k + 1, int(np.searchsorted(total, (total[k - 1] if k else 0) + PAIRS, side="right")))
            n = count[k:stop]
            i = np.repeat(left[k:stop], n)
            j = np.arange(len(i)) + np.repeat(begin[k:stop] - np.cumsum(n) + n, n)
            k = stop
            fit = (label[i] != label[j]) & (den * np.minimum(size[i], size[j]) >= num * np.maximum(size[i], size[j]))
            i, j = i[fit], j[fit]
            fit, most = able(size, width, bits, i, j)
            i, j, most = i[fit], j[fit], most[fit]
            if most_likely and len(i):
                order = np.lexsort((-most / (size[i] + size[j]), i))
                i, j = i[order], j[order]
                nth = np.arange(len(i)) - np.searchsorted(i, i)
                pending[i[nth >= most_likely]] = pending[j[nth >= most_likely]] = True
                i, j = i[nth < most_likely], j[nth < most_likely]
            # tiles repeat the pairs of one another; a pair is sent once while it is remembered
            new = [p for p in dict.fromkeys(zip(node[i].tolist(), node[j].tolist(), strict=True)) if p not in sent]
            if len(sent) + len(new) > _SEEN:
                sent.clear()
            sent.update(new)
            out[0].extend(p[0] for p in new)
            out[1].extend(p[1] for p in new)
        return *out, node[pending].tolist(), tile[pending].tolist()

    def batch(u: list[int], v: list[int], left: list[int], more: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (u + left, v + [None] * len(more), [None] * len(u) + more)],
                                          names=["u", "v", "more"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the rows of the block pair that the last batch ended in
        for rows in batches:
            if not rows.num_rows:
                continue
            if held is not None:
                rows = pa.concat_batches([held, rows])
            tile, blocks = (rows.column(i).to_numpy() for i in (0, 1))
            cut = len(tile) - int(np.argmin(((tile == tile[-1]) & (blocks == blocks[-1]))[::-1])) if (
                tile[0] != tile[-1] or blocks[0] != blocks[-1]) else 0
            held = pa.concat_batches([rows.slice(cut)])
            if cut:
                yield batch(*pairs(pa.concat_batches([rows.slice(0, cut)])))
        if held is not None:
            yield batch(*pairs(held))
    return run


def near_duplicates(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, the row's KEY, and ``group``: a number of the group (null for
    documents without shingles)."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "jaccard")
    base = docs.select(*key_columns(id_col, text_col), F.col(text_col).alias("text"))
    kind = "_id long, _null int, _h long, n_shingles long, node long, bits array<long>, tiles array<long>"
    base.mapInArrow(_sketch(n, num, den), kind).write.parquet(f"{folder}/sketch")
    sketch = spark.read.schema(kind).parquet(f"{folder}/sketch")

    def passes(rows: int, width: float, room: int) -> int:
        """In how many passes tiles are shuffled, so that rows of so many bytes take no more than ``room``."""
        return max(1, math.ceil(rows * width / max(room, PASS_BYTES)))

    def nth(of: int, k: int):
        return F.pmod(F.xxhash64("tile"), F.lit(of)) == k

    # tiles: sorted by (tile, node), each tile's first node is the centre of its star
    of = passes(sketch.agg(F.sum(F.size("tiles"))).first()[0] or 0, 20, fs.stored(spark, f"{folder}/sketch") // 3)
    for k in range(of):
        (sketch.select(F.explode("tiles").alias("tile"), "node").filter(nth(of, k)).repartition("tile").sortWithinPartitions("tile", "node")
         .mapInArrow(_stars, "tile long, centre long, node long").write.mode("append").parquet(f"{folder}/stars"))
        if k + 1 < of:
            release(spark)
    stars = spark.read.schema("tile long, centre long, node long").parquet(f"{folder}/stars")
    # the tiles of all sets, by far the largest part, have done their work
    kind = kind.replace(", tiles array<long>", "")
    sketch.drop("tiles").write.parquet(f"{folder}/nodes-of-rows")
    sketch = spark.read.schema(kind).parquet(f"{folder}/nodes-of-rows")
    fs.delete(spark, f"{folder}/sketch")
    release(spark)

    # bitmaps and one text of every node that has a candidate
    met = stars.select("node").union(stars.select("centre")).distinct()
    # (copies are aggregated before they are shuffled, so a large group of them is a row a task)
    (sketch.filter("node is not null").groupBy("node")
     .agg(F.min(F.struct(*KEY)).alias("rep"), F.first("n_shingles").alias("size"), F.first("bits").alias("bits"))
     .join(met, "node", "left_semi").withColumn("coarse", _coarse("bits", "size")).write.parquet(f"{folder}/met"))
    met = spark.read.schema("node long, rep struct<_id: long, _null: int, _h: long>, size long, bits array<long>, "
                            "coarse array<long>").parquet(f"{folder}/met")

    def side(name: str) -> DataFrame:
        return met.select(F.col("node").alias(name), F.col("size").alias(f"size_{name}"), F.col("bits").alias(f"bits_{name}"))

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        """Links (u, v) among pairs that the bit counts leave possible, by their sorted arrays."""
        pairs.write.parquet(f"{folder}/{name}-pairs")
        pairs = spark.read.schema("u long, v long").parquet(f"{folder}/{name}-pairs")
        used = pairs.select("u").union(pairs.select("v")).distinct().withColumnRenamed("u", "node")
        reps = met.select("node", "rep.*").join(used, "node", "left_semi")
        # rows that repeat id and text give one set more than once; one is enough
        copy = Window.partitionBy(*KEY).orderBy("node")
        text = (base.join(reps, KEY).withColumn("_copy", F.row_number().over(copy)).filter("_copy = 1")
                .select("node", _set_arrays(n)("text").alias("elements")))
        text.write.parquet(f"{folder}/{name}-sets")
        sets = spark.read.schema("node long, elements binary").parquet(f"{folder}/{name}-sets")
        out = (pairs.join(sets.select(F.col("node").alias("u"), F.col("elements").alias("a")), "u")
               .join(sets.select(F.col("node").alias("v"), F.col("elements").alias("b")), "v")
               .filter(_linked(num, den)("a", "b")).select("u", "v").distinct())
        out.write.parquet(f"{folder}/{name}-links")
        del pairs, used, reps, text, sets, out
        release(spark)
        return spark.read.schema("u long, v long").parquet(f"{folder}/{name}-links")

    differ = F.aggregate(F.zip_with(_folded("bits_u", "bits_v"), _folded("bits_v", "bits_u"),
                                    lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    total = F.col("size_u") + F.col("size_v")
    most = F.least("size_u", "size_v", F.floor((total - differ) / 2))

    def possible(pairs: DataFrame) -> DataFrame:
        """Pairs that sizes and the bit counts of whole bitmaps leave possible."""
        return (pairs.join(side("u"), "u").join(side("v"), "v")
                .filter(den * F.least("size_u", "size_v") >= num * F.greatest("size_u", "size_v"))
                .filter(den * most >= num * (total - most)).select("u", "v"))

    first = possible(stars.select(F.col("centre").alias("u"), F.col("node").alias("v")).distinct())
    links = verified(first, "stars")
    labels = connected_components(links)
    labels.write.parquet(f"{folder}/labels")
    labels = spark.read.schema("node long, label long").parquet(f"{folder}/labels")

    # tiles with more than one component: bounded blocks, pairs across components; the likeliest
    # of each node first (no more pairs than members), then, components formed anew, all that are left
    everyone = stars.select("tile", "node").union(stars.select("tile", "centre")).distinct()
    for name, most_likely in (("likely", 1), ("rest", None)):
        member = everyone.join(labels, "node", "left").select("tile", "node", F.coalesce("label", "node").alias("label"))
        # copies of a passage share many segments: of tiles with the same members one is enough
        split = (member.groupBy("tile").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("m"),
                                            F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
                 .filter("lo <> hi").groupBy("m", "x", "y").agg(F.min("tile").alias("tile"))
                 .select("tile", F.ceil(F.col("m") / BLOCK).alias("g")))
        member.join(split, "tile").write.parquet(f"{folder}/{name}-members")
        del member, split
        release(spark)
        members = spark.read.schema("tile long, node long, label long, g long").parquet(f"{folder}/{name}-members")
        # a node meets others in many tiles: there it shows a bitmap folded to a bit an element or so at first, and
        # the pairs that this leaves possible meet their whole bitmaps afterwards; few nodes are left to the second
        # round, where such a bitmap would leave possible nearly all pairs of a family of texts, so they show the whole
        shown = met.select("node", "size", F.col("coarse" if most_likely else "bits").alias("bits"))
        # a member of a large tile goes to as many block pairs as the tile has blocks, so these rows are the most by far
        width = 60 + 8 * (shown.agg(F.avg(F.size("bits"))).first()[0] or 0)
        of = passes(members.agg(F.sum("g")).first()[0] or 0, width, fs.stored(spark, f"{folder}/nodes-of-rows"))
        for k in range(of):
            blocks = members.filter(nth(of, k)).select(
                "tile", "node", "label", "g", F.pmod(F.xxhash64("node"), F.col("g")).alias("c"),
                F.explode(F.sequence(F.lit(0).cast("long"), F.col("g") - 1)).alias("o"))
            (blocks.join(shown, "node")
             .select("tile", (F.least("c", "o") * F.col("g") + F.greatest("c", "o")).alias("blocks"),
                     F.when(F.col("c") > F.col("o"), 1).otherwise(0).alias("side"), "node", "size", "label", "bits")
             .repartition("tile", "blocks").sortWithinPartitions("tile", "blocks", "side", "node")
             .mapInArrow(_across(num, den, most_likely), "u long, v long, more long").write.mode("append").parquet(f"{folder}/{name}-found"))
            del blocks
            release(spark)
        across = spark.read.schema("u long, v long, more long").parquet(f"{folder}/{name}-found")
        found = across.filter("more is null").select("u", "v").distinct()
        links = links.union(verified(possible(found) if most_likely else found, name))
        labels = connected_components(links)
        labels.write.parquet(f"{folder}/labels-{name}")
        labels = spark.read.schema("node long, label long").parquet(f"{folder}/labels-{name}")
        # all other possible pairs have been sent
        everyone = across.filter("more is not null").select(F.col("more").alias("tile"), F.col("u").alias("node")).distinct()
        if not everyone.head(1):
            break

    # the least id of every group, by node first, so copies are aggregated before the shuffle
    own = F.when(F.col("_null") == 0, F.col("_id"))
    nodes = sketch.filter("node is not null").groupBy("node").agg(F.min(own).alias("least"))
    nodes = nodes.join(labels, "node", "left").select("node", "least", F.coalesce("label", "node").alias("label"))
    nodes.write.parquet(f"{folder}/nodes")
    nodes = spark.read.schema("node long, least long, label long").parquet(f"{folder}/nodes")
    groups = nodes.groupBy("label").agg(F.min("least").alias("component_id"))
    of = nodes.join(groups, "label").select("node", F.col("label").alias("group"), "component_id")
    return (sketch.select(*KEY, "n_shingles", "node").join(of, "node", "left")
            .select(own.alias("doc_id"), "n_shingles",
                    F.when(F.col("node").isNull(), own).otherwise(F.col("component_id")).alias("component_id"), *KEY, "group"))


def keep_one(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row of each group (of the least key: non-null ids first, by id), and all rows without
    shingles, with all columns of ``docs``."""
    found = near_duplicates(docs, n, num, den, id_col, text_col)
    first = (found.filter("group is not null").groupBy("group").agg(F.min(F.struct("_null", "_id", "_h")).alias("k"))
             .select(*[F.col("k").getField(c).alias(c) for c in KEY], F.lit(True).alias("_one")))
    blank = found.filter("group is null").select(*KEY).distinct().withColumn("_one", F.lit(False))
    row = docs.select(*key_columns(id_col, text_col), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    copy = Window.partitionBy(*KEY).orderBy("_one")
    return (row.join(first.unionByName(blank), KEY).withColumn("_copy", F.row_number().over(copy))
            .filter("not _one or _copy = 1").select("row.*"))


def _coarse(bits: str, size: str):
    """A bitmap folded to 0.75 bits an element or more, eight words at least."""
    words = f"cast(least(size({bits}), greatest(8, pow(2, ceil(log2(greatest({size}, 1) * 3 / 256.0))))) as int)"
    return F.expr(f"transform(array({words}), w -> transform(sequence(0, w - 1), i -> aggregate("
                  f"sequence(0, size({bits}) div w - 1), 0L, (s, j) -> s | {bits}[i + j * w])))[0]")


def _folded(one: str, other: str):
    """``one`` at the length of the shorter of two bitmaps (lengths are powers of two)."""
    return F.expr(f"if(size({one}) <= size({other}), {one}, transform(sequence(0, size({other}) - 1), i -> aggregate("
                  f"sequence(0, size({one}) div size({other}) - 1), 0L, (s, j) -> s | {one}[i + j * size({other})])))")

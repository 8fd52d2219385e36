"""Prefix trie of conversations: which conversations share their first turns, and what sharing saves.

Every turn becomes a digest (SHA-256 of role and text, as two longs) before anything is shuffled, so texts never
move.  A prefix's digest is the exclusive or of its turns' digests, each hashed with its depth: it can be taken in
any order and over partition borders, so a very long conversation is not one task.

Most prefixes belong to one conversation.  A count-min sketch of all prefix digests (two rows of counters
that stop at two; tasks send the counters they touched, bitmaps of the counters at two are broadcast) proves
which: an estimate of one is a singleton, since estimates are never too low.  Singleton nodes, the tails, are
emitted where they are, with all their columns; only prefixes with an estimate of two or more are shuffled and
grouped exactly by digest.  Estimates that are too high cost a row in that shuffle and change no result.
The sketch has at least ``LOAD`` counters a prefix up to ``CELLS`` counters a row, 2 x ``CELLS`` / 8 bytes
broadcast at most; above that, more prefixes are shuffled.

Sums over subtrees come without walking the trie: the smallest member of a node owns it, what a conversation
owns is a chain of nodes up to its last turn, so a node's subtree is the rest of its owner's chain
and the whole chains of its other members.  Parents are joined by digest, the most frequent of them (at most
``HOT_PARENTS``) by broadcast.  The hash over the conversations that end at a node runs over pieces of sorted
ids that range partitions have joined beforehand, piece after piece in bounded memory.

Defined results: rows without a conversation id belong to no conversation; turns are ordered by ``turn`` (null
first), equal ones by the digest of role and text, so repeated rows are repeated turns; a null role or text is
empty; a conversation without turns (all taken away, no base) belongs to the root alone; an empty table gives no
rows, not even a root; further columns are not read.  Equal 128-bit digests count as equal prefixes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.index import ranged_checkpoint, running_sum
from ..session import scratch_path

FAMILY, HEADS = 20, 4
LOAD, CELLS = 4, 1 << 26
CHUNK = 1 << 16
HOT_PARENTS = 1000
PIECE = 4096
_LOW_BITS = (1 << 33) - 1


def _long_of(hexes: Column, start: int) -> Column:
    """Sixteen hex digits as a long."""
    high, low = (F.conv(F.substring(hexes, at, 8), 16, 10).cast("long") for at in (start, start + 8))
    return F.shiftleft(high, 32).bitwiseOR(low)


def turn_digests(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """conv_id, turn, digest (hex), n_words of every turn of a conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return (turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), digest.alias("digest"),
                         words.cast("long").alias("n_words")).filter("conv_id is not null"))


def _at_depth(depth: Column, d1: Column, d2: Column) -> list[Column]:
    """A turn's two hashes at a depth."""
    return [F.xxhash64(depth.cast("long"), d1, d2, F.lit(salt)) for salt in (1, 2)]


def _xor_all(pairs: Column, k: int) -> Column:
    return F.aggregate(pairs, F.lit(0).cast("long"), lambda a, p: a.bitwiseXOR(p[f"k{k}"]))


def rebuild(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text", family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """The prefixes of every conversation, its first ``crc32(id) % heads`` turns replaced by those of the first
    conversation of its family (``id - id % family``): conv_id, depth, digest (g1, g2), parent's digest (p1, p2), n_words
    of the last turn, whether the conversation ends there.  Depth 0 has one row for each conversation."""
    spark = turns.sparkSession
    digests = turn_digests(turns, conv_col, turn_col, role_col, text_col)
    ranged = ranged_checkpoint(digests, ["conv_id", "turn", "digest"])
    ranged = ranged.select("conv_id", "n_words", _long_of(F.col("digest"), 1).alias("d1"), _long_of(F.col("digest"), 17).alias("d2"),
                           F.shiftright("_mid", 33).alias("_pid"), F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)).alias("_at"))
    # a conversation may lie in several partitions: its rows before each, and all of them
    parts = Window.partitionBy("conv_id").orderBy("_pid")
    slices = (ranged.groupBy("_pid", "conv_id").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("first"))
              .withColumn("before", F.coalesce(F.sum("n").over(parts.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("total", F.sum("n").over(Window.partitionBy("conv_id"))))
    slices.write.parquet(path := scratch_path(spark, "trie-slices"))
    slices = spark.read.parquet(path)
    base = F.col("conv_id") - F.col("conv_id") % family
    place = F.col("_at") - F.col("first") + F.col("before")
    firsts = (ranged.filter(base == F.col("conv_id")).join(slices, ["_pid", "conv_id"]).filter(place < heads - 1)
              .groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(F.struct(place.alias("i"), "d1", "d2", "n_words"))).alias("lead")))
    # one row for each conversation: its lead turns, hashed at their depths
    take = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    empty = F.array().cast("array<struct<i:bigint,d1:bigint,d2:bigint,n_words:bigint>>")
    lead = F.slice(F.coalesce("lead", empty), F.lit(1), F.col("h"))
    hashed = F.transform("lead", lambda t: F.struct(*[c.alias(f"k{i}") for i, c in enumerate(_at_depth(t["i"] + 1, t["d1"], t["d2"]), 1)], t["n_words"].alias("n_words")))
    convs = (slices.filter("before = 0").select("conv_id", "total", base.alias("base"), take.alias("h")).join(firsts, "base", "left")
             .withColumn("lead", lead).withColumn("lead", hashed).withColumn("taken", F.size("lead").cast("long"))
             .withColumn("length", F.col("taken") + F.greatest(F.col("total") - F.col("h"), F.lit(0)))
             .select("conv_id", "h", "lead", "taken", "length", _xor_all(F.col("lead"), 1).alias("l1"), _xor_all(F.col("lead"), 2).alias("l2")))
    convs.write.parquet(path := scratch_path(spark, "trie-conversations"))
    convs = spark.read.parquet(path)
    # own turns behind the first h, in the partitions of the range cut
    own = (ranged.join(slices.join(convs.drop("lead"), "conv_id"), ["_pid", "conv_id"]).withColumn("pos", place).filter("pos >= h")
           .withColumn("depth", F.col("taken") + F.col("pos") - F.col("h") + 1))
    own = own.withColumns({f"k{i}": c for i, c in enumerate(_at_depth(F.col("depth"), F.col("d1"), F.col("d2")), 1)})
    within = Window.partitionBy("_pid", "conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    here = own.withColumns({f"x{i}": F.expr(f"bit_xor(k{i})").over(within) for i in (1, 2)})
    # conversations that go on from one partition to the next: at most two rows for each partition
    whole = own.filter("n < total").groupBy("conv_id", "_pid").agg(*[F.expr(f"bit_xor(k{i})").alias(f"k{i}") for i in (1, 2)])
    earlier = whole.select("conv_id", "_pid", *[F.coalesce(F.expr(f"bit_xor(k{i})").over(parts.rowsBetween(Window.unboundedPreceding, -1)),
                                                           F.lit(0)).alias(f"c{i}") for i in (1, 2)])
    here = here.join(F.broadcast(earlier), ["conv_id", "_pid"], "left")
    g = [F.col(f"x{i}").bitwiseXOR(F.coalesce(f"c{i}", F.lit(0))).bitwiseXOR(F.col(f"l{i}")) for i in (1, 2)]
    own_rows = here.select("conv_id", "depth", g[0].alias("g1"), g[1].alias("g2"), "k1", "k2", "n_words", "length")
    some = convs.select("conv_id", "length", "lead", F.explode(F.sequence(F.lit(0).cast("long"), "taken")).alias("depth"))
    upto = F.slice("lead", F.lit(1), F.col("depth").cast("int"))
    last = F.get("lead", F.col("depth").cast("int") - 1)
    lead_rows = some.select("conv_id", "depth", _xor_all(upto, 1).alias("g1"), _xor_all(upto, 2).alias("g2"),
                            F.coalesce(last["k1"], F.lit(0)).alias("k1"), F.coalesce(last["k2"], F.lit(0)).alias("k2"),
                            F.coalesce(last["n_words"], F.lit(0)).alias("n_words"), "length")
    out = own_rows.unionByName(lead_rows)
    return out.select("conv_id", "depth", "g1", "g2", F.col("g1").bitwiseXOR(F.col("k1")).alias("p1"), F.col("g2").bitwiseXOR(F.col("k2")).alias("p2"),
                      "n_words", (F.col("depth") == F.col("length")).alias("ends"))


# ---- the sketch

def _cells(batch: pa.RecordBatch, names: tuple[str, str], width: int) -> list[np.ndarray]:
    """Counter of each digest in the two rows of the sketch."""
    return [batch.column(c).to_numpy(zero_copy_only=False) & (width - 1) for c in names]


def sketch(prefixes: DataFrame, n: int, load: int = LOAD, most: int = CELLS) -> np.ndarray:
    """Bits [2, width / 8]: which counters have seen two prefixes or more."""
    width = CHUNK
    while width < min(load * n, most):
        width *= 2
    per_row = width // CHUNK

    def touch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, cells in enumerate(_cells(batch, ("g1", "g2"), width)):
                cell, times = np.unique(cells, return_counts=True)
                at = cell // CHUNK
                cuts = np.flatnonzero(np.diff(at, prepend=-1))
                low, often = (cell % CHUNK).astype("<u2"), times > 1
                ends = np.append(cuts[1:], len(cell))
                yield pa.RecordBatch.from_pydict({
                    "chunk": pa.array(at[cuts] + row * per_row, pa.int64()),
                    "once": [low[a:b][~often[a:b]].tobytes() for a, b in zip(cuts, ends, strict=True)],
                    "often": [low[a:b][often[a:b]].tobytes() for a, b in zip(cuts, ends, strict=True)]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, seen = None, np.zeros(CHUNK, np.uint8)  # rows come sorted by chunk

        def result() -> Iterator[pa.RecordBatch]:
            if chunk is not None and (seen > 1).any():
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int64()), "bits": [np.packbits(seen > 1).tobytes()]})

        for batch in batches:
            for c, once, often in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if c != chunk:
                    yield from result()
                    chunk = c
                    seen[:] = 0
                at = np.frombuffer(once, "<u2")
                seen[at] = np.minimum(seen[at] + 1, 2)
                seen[np.frombuffer(often, "<u2")] = 2
        yield from result()

    rows = (prefixes.select("g1", "g2").mapInArrow(touch, "chunk long, once binary, often binary")
            .repartition("chunk").sortWithinPartitions("chunk").mapInArrow(add, "chunk long, bits binary").toArrow())
    bits = np.zeros((2 * per_row, CHUNK // 8), np.uint8)
    for c, b in zip(rows["chunk"].to_pylist(), rows["bits"].to_pylist(), strict=True):
        bits[c] = np.frombuffer(b, np.uint8)
    return bits.reshape(2, -1)


def _screen(spark, bits: np.ndarray):
    """Arrow UDF of two digests: 0 for proven singletons, 1 for the second, 2 for the first, 3 for neither."""
    shared = spark.sparkContext.broadcast(bits)
    width = bits.shape[1] * 8

    def run(g1: pa.Array, g2: pa.Array, p1: pa.Array, p2: pa.Array) -> pa.Array:
        table = shared.value
        out = []
        for pair in ((g1, g2), (p1, p2)):
            both = True
            for row, x in enumerate(pair):
                at = x.to_numpy(zero_copy_only=False) & (width - 1)
                both &= (table[row][at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
            out.append(both)
        return pa.array(2 * out[0].astype(np.int8) + out[1], pa.int32())

    run.__annotations__ = dict.fromkeys(("g1", "g2", "p1", "p2", "return"), pa.Array)
    return F.arrow_udf(run, "int")


# ---- the trie

def _end_hashes(ends: DataFrame) -> DataFrame:
    """g1, g2, ends_sha256 of (g1, g2, conv_id): SHA-256 of each digest's ids, ascending, joined by commas."""
    pieces_kind = "g1 long, g2 long, first long, ids binary"

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # sorted by digest and id
            g1, g2, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            new = (np.diff(g1, prepend=g1[:1] - 1) != 0) | (np.diff(g2, prepend=g2[:1] - 1) != 0) if len(ids) else np.zeros(0, bool)
            starts = np.flatnonzero(new)
            cuts = np.concatenate([np.arange(a, b, PIECE) for a, b in zip(starts, np.append(starts[1:], len(ids)), strict=True)]) if len(ids) else starts
            text = [",".join(map(str, ids[a:b].tolist())).encode() for a, b in zip(cuts, np.append(cuts[1:], len(ids)), strict=True)]
            yield pa.RecordBatch.from_pydict({"g1": g1[cuts], "g2": g2[cuts], "first": ids[cuts], "ids": pa.array(text, pa.binary())})

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:  # sorted by digest and first id
            out: list[tuple] = []
            for a, b, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
                if (a, b) != key:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = (a, b), hashlib.sha256(ids)
                else:
                    state.update(b"," + ids)
            yield pa.RecordBatch.from_pydict({"g1": pa.array([r[0] for r in out], pa.int64()), "g2": pa.array([r[1] for r in out], pa.int64()),
                                              "ends_sha256": pa.array([r[2] for r in out], pa.string())})
        if key is not None:
            yield pa.RecordBatch.from_pydict({"g1": [key[0]], "g2": [key[1]], "ends_sha256": [state.hexdigest()]})

    return (ends.repartitionByRange("g1", "g2", "conv_id").sortWithinPartitions("g1", "g2", "conv_id").mapInArrow(join, pieces_kind)
            .repartition("g1", "g2").sortWithinPartitions("g1", "g2", "first").mapInArrow(digest, "g1 long, g2 long, ends_sha256 string"))


def trie(prefixes: DataFrame, load: int = LOAD, most: int = CELLS) -> DataFrame:
    """One row for each node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.  ``prefixes`` as ``rebuild`` returns them."""
    spark = prefixes.sparkSession
    prefixes.write.parquet(path := scratch_path(spark, "trie-prefixes"))
    prefixes = spark.read.parquet(path)
    n = prefixes.count()
    screen = _screen(spark, sketch(prefixes.filter("depth > 0"), n, load, most))
    # the root is shared, whatever the sketch says; it has no parent
    seen = prefixes.withColumn("s", screen("g1", "g2", "p1", "p2")).select(
        *prefixes.columns, ((F.col("depth") == 0) | (F.col("s") >= 2)).cast("int").alias("shared"),
        ((F.col("depth") == 1) | ((F.col("depth") > 1) & (F.col("s") % 2 == 1))).alias("parent_shared"))
    seen.write.partitionBy("shared").parquet(path := scratch_path(spark, "trie-screened"))
    seen = spark.read.schema(seen.schema).parquet(path)
    some, tails = seen.filter("shared = 1"), seen.filter("shared = 0")

    nodes = some.groupBy("g1", "g2").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.count(F.lit(1)).alias("n_convs"),
                                         F.max("n_words").alias("n_words"), F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    nodes.write.parquet(path := scratch_path(spark, "trie-nodes"))
    nodes = spark.read.parquet(path)
    # children: nodes grouped exactly, and tails that begin below a possibly shared prefix
    kids = nodes.filter("depth > 0").select("p1", "p2").unionByName(tails.filter("parent_shared").select("p1", "p2"))
    kids = kids.groupBy(F.col("p1").alias("g1"), F.col("p2").alias("g2")).agg(F.count(F.lit(1)).alias("n_children"))
    hashes = _end_hashes(some.filter("ends").select("g1", "g2", "conv_id"))
    nodes = nodes.join(kids, ["g1", "g2"], "left").join(hashes, ["g1", "g2"], "left").select(
        "g1", "g2", "conv_id", "depth", "n_convs", "n_words", "p1", "p2", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
    nodes.write.parquet(path := scratch_path(spark, "trie-counted"))
    nodes = spark.read.parquet(path)

    # what each conversation owns: leaves (one at most, its end) and tokens saved
    worth = (F.col("n_convs") - 1) * F.col("n_words")
    owned = (nodes.select("conv_id", (F.col("n_children") == 0).cast("long").alias("leaf"), worth.alias("saved"))
             .unionByName(tails.filter("ends").select("conv_id", F.lit(1).cast("long").alias("leaf"), F.lit(0).cast("long").alias("saved")))
             .groupBy("conv_id").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved")).filter("leaf > 0 or saved > 0"))
    below = (some.select("g1", "g2", "conv_id").join(owned, "conv_id").groupBy("g1", "g2")
             .agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("all_saved")))
    # the owner's chain above a node is not in its subtree
    chains = running_sum(nodes.filter("n_convs > 1").select("g1", "g2", "conv_id", "depth", worth.alias("worth")), ["depth"],
                         {"upto": F.col("worth")}, groups=["conv_id"])
    above = chains.select("g1", "g2", (F.col("upto") - F.col("worth")).alias("above"))
    zero = F.lit(0).cast("long")
    full = (nodes.join(below, ["g1", "g2"], "left").join(above, ["g1", "g2"], "left")
            .withColumn("saved_tokens", F.coalesce(F.col("all_saved"), zero) - F.coalesce(F.col("above"), zero))
            .withColumn("saved_tokens", F.when(F.col("n_convs") > 1, F.col("saved_tokens")).otherwise(zero))
            .withColumn("n_leaves", F.coalesce("n_leaves", F.lit(1).cast("long"))))
    tail_rows = tails.select("conv_id", "depth", "p1", "p2", "parent_shared", F.lit(1).cast("long").alias("n_convs"),
                             F.when(F.col("ends"), zero).otherwise(zero + 1).alias("n_children"), (zero + 1).alias("n_leaves"),
                             zero.alias("saved_tokens"),
                             F.sha2(F.when(F.col("ends"), F.col("conv_id").cast("string")).otherwise("").cast("binary"), 256).alias("ends_sha256"))
    rows = full.select("conv_id", "depth", "p1", "p2", (F.col("depth") > 0).alias("parent_shared"), "n_convs", "n_children", "n_leaves",
                       "saved_tokens", "ends_sha256").unionByName(tail_rows)
    return _with_parents(rows, nodes.select(F.col("g1").alias("p1"), F.col("g2").alias("p2"), F.col("conv_id").alias("parent"), "n_children"))


def _with_parents(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The smallest member of each row's parent.  A parent that is not among the nodes is a tail of the same conversation."""
    total = nodes.agg(F.sum("n_children")).first()[0] or 0
    hot = nodes.filter(F.col("n_children") > max(1, total // HOT_PARENTS)).select("p1", "p2", F.col("parent").alias("hot_parent"))
    found = rows.join(F.broadcast(hot), ["p1", "p2"], "left")
    out = ["conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    ask = F.col("hot_parent").isNull() & F.col("parent_shared")
    plain = found.filter(~ask).withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.coalesce("hot_parent", "conv_id")))
    asked = found.filter(ask).join(nodes.select("p1", "p2", "parent"), ["p1", "p2"], "left").withColumn(
        "parent_conv_id", F.coalesce("parent", "conv_id"))
    return plain.select(*out).unionByName(asked.select(*out))

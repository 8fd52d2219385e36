"""Distributed positions: a 0-based row index in a total order, optionally
restarted per group, and running sums in that order.

A plain ``row_number() over (order by k)`` plans ``Exchange SinglePartition``:
every row goes through one task.  Here the order is cut into ranges instead:

1. ``repartitionByRange`` + ``sortWithinPartitions`` on the order, and
   ``monotonically_increasing_id`` (partition id in the upper bits, position in
   the partition below) fixed by a reliable ``checkpoint`` so that both
   passes below see the same partition contents even after executor loss;
2. per-partition row counts (one row per partition) turned into start offsets
   by a window over that small frame, broadcast back (its size is the number
   of partitions, a known bound);
3. for groups, the first global position of each group is subtracted; that
   frame has one row per group and is joined without a hint, so AQE decides
   on broadcast by measured size.

The checkpoint is eager: these functions run the range cut when called and
return frames that read the checkpointed partitions.

Running sums (``running_sum``) use the same range cut, a window per
(partition, group) that only sees one partition's slice, and a small
per-(partition, group) totals frame for the carry between partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

_LOW_BITS = (1 << 33) - 1


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _names(cols: Sequence[str]) -> list[str]:
    return [c for c in cols]


def _join_groups(left: DataFrame, right: DataFrame, plain: Sequence[str], groups: Sequence[str],
                 how: str = "inner") -> DataFrame:
    """Join on ``plain`` columns (never null) and, null-safely, on ``groups``;
    the columns of ``left`` come first and the keys of ``right`` are dropped."""
    keys = [*plain, *groups]
    renamed = right.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)})
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & (left[k] == renamed[f"_k{i}"] if k in plain else left[k].eqNullSafe(renamed[f"_k{i}"]))
    return left.join(renamed, on, how).drop(*[f"_k{i}" for i in range(len(keys))])


def ranged_checkpoint(df: DataFrame, keys: Sequence[str | Column],
                      num_partitions: int | None = None, materialize: bool = False) -> DataFrame:
    """Range-partition and sort ``df`` by ``keys``, tag each row with
    ``_mid`` (monotonic id) and cut lineage with a reliable checkpoint.

    The range cut samples its input in a job of its own before the shuffle
    reads it again; ``materialize`` checkpoints an expensive input first so
    it is computed once."""
    checkpoint_dir(df.sparkSession)
    if materialize:
        df = df.checkpoint(eager=True)
    k = _cols(keys)
    # without an explicit count the range cut uses spark.sql.shuffle.partitions
    # and AQE may merge neighbouring ranges by size (order is kept); the
    # checkpoint then fixes whatever partitions ran
    cut = df.repartitionByRange(int(num_partitions), *k) if num_partitions else df.repartitionByRange(*k)
    ranged = cut.sortWithinPartitions(*k).withColumn("_mid", F.monotonically_increasing_id())
    return ranged.checkpoint(eager=True)


def with_row_index(df: DataFrame, order: Sequence[str | Column], name: str = "row_idx",
                   groups: Sequence[str] = (), num_partitions: int | None = None,
                   count_name: str | None = None) -> DataFrame:
    """Add ``name``: the 0-based position of each row in ``order`` (which must
    be a total order: append tie-breakers if the key is not unique), restarted
    at 0 for every combination of ``groups``.  With ``count_name``, also add
    the number of rows (in the group, or in all)."""
    groups = _names(groups)
    ranged = ranged_checkpoint(df, [*groups, *order], num_partitions)
    local = (ranged.withColumn("_pid", F.shiftright(F.col("_mid"), 33))
             .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit(_LOW_BITS))))
    counts = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: bounded by the partition count, so broadcast is safe
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"),
                            F.sum("_n").over(Window.partitionBy()).alias("_all"))
    out = (local.join(F.broadcast(offsets), "_pid")
           .withColumn(name, F.col("_pos") + F.col("_off")))
    if groups:
        starts = out.groupBy(*groups).agg(F.min(name).alias("_start"), F.count(F.lit(1)).alias("_gn"))
        # null groups are groups too; a hot group of the rows' side is split by
        # AQE's skew join, the other side has one row per group
        out = (_join_groups(out, starts, [], groups)
               .withColumn(name, F.col(name) - F.col("_start")))
        if count_name:
            out = out.withColumn(count_name, F.col("_gn"))
    elif count_name:
        out = out.withColumn(count_name, F.col("_all"))
    return out.drop("_mid", "_pid", "_pos", "_off", "_start", "_all", "_gn")


def running_sum(df: DataFrame, order: Sequence[str | Column], values: dict[str, Column],
                groups: Sequence[str] = (), num_partitions: int | None = None,
                totals: bool = False) -> DataFrame:
    """Add one inclusive running sum per entry of ``values`` (name -> expression)
    in ``order`` within ``groups``, without a single-partition window.  With
    ``totals``, also add ``{name}_total``: the sum over the whole group."""
    groups = _names(groups)
    src = df
    for name, expr in values.items():
        src = src.withColumn(f"_v_{name}", expr)
    ranged = ranged_checkpoint(src, [*groups, *order], num_partitions)
    ranged = ranged.withColumn("_pid", F.shiftright(F.col("_mid"), 33))
    # local running sums: a window over one partition's slice of one group
    wl = (Window.partitionBy("_pid", *groups).orderBy("_mid")
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged
    for name in values:
        local = local.withColumn(f"_l_{name}", F.sum(f"_v_{name}").over(wl))
    # carry between partitions: totals per (partition, group), summed over earlier partitions
    tot = ranged.groupBy("_pid", *groups).agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in values])
    wc = (Window.partitionBy(*groups).orderBy("_pid")
          .rowsBetween(Window.unboundedPreceding, -1))
    carry = tot.select("_pid", *groups,
                       *[F.coalesce(F.sum(f"_t_{n}").over(wc), F.lit(0)).alias(f"_c_{n}") for n in values])
    # only the first group of a partition can carry anything: at most one
    # non-zero row per partition, so the broadcast side is bounded by the
    # partition count
    nonzero = F.lit(False)
    for n in values:
        nonzero = nonzero | (F.col(f"_c_{n}") != 0)
    if totals:
        # group totals for every (partition, group) present: bounded by partitions + groups
        wt = Window.partitionBy(*groups)
        # with groups this has a row for every (partition, group): no hint, the planner decides by size
        whole = tot.select("_pid", *groups, *[F.sum(f"_t_{n}").over(wt).alias(f"{n}_total") for n in values])
        carry = _join_groups(carry, whole, ["_pid"], groups)
    else:
        carry = carry.filter(nonzero)
    out = _join_groups(local, carry if totals and groups else F.broadcast(carry), ["_pid"], groups, "left")
    for n in values:
        out = out.withColumn(n, F.col(f"_l_{n}") + F.coalesce(F.col(f"_c_{n}"), F.lit(0)))
    drop = ["_mid", "_pid"] + [f"_{p}_{n}" for n in values for p in ("v", "l", "c")]
    return out.drop(*drop)


def _offsets(frame: DataFrame, id_col: str, groups: Sequence[str], tag: str) -> DataFrame:
    """Per (partition, group): the number to add to a row's position in its
    partition to get its position in the group (rows of the group in
    earlier partitions, minus the group's first position here)."""
    pid = F.shiftright(F.col(id_col), 33)
    pos = F.col(id_col).bitwiseAND(F.lit(_LOW_BITS))
    small = frame.groupBy(pid.alias("_p"), *groups).agg(F.count(F.lit(1)).alias("_n"), F.min(pos).alias("_f"))
    w = Window.partitionBy(*groups).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    return small.select(F.col("_p").alias(f"_p_{tag}"), *groups,
                        (F.coalesce(F.sum("_n").over(w), F.lit(0)) - F.col("_f")).alias(f"_o_{tag}"))


def _add_position(frame: DataFrame, id_col: str, offsets: DataFrame, groups: Sequence[str], tag: str,
                  name: str) -> DataFrame:
    # no hint: with many groups the offsets are many rows, and the planner decides by their size
    j = _join_groups(frame.withColumn(f"_p_{tag}", F.shiftright(F.col(id_col), 33)), offsets, [f"_p_{tag}"], groups)
    return (j.withColumn(name, F.col(id_col).bitwiseAND(F.lit(_LOW_BITS)) + F.col(f"_o_{tag}"))
            .drop(f"_p_{tag}", f"_o_{tag}"))


def subset_positions(df: DataFrame, order: Sequence[str | Column], groups: Sequence[str], subset: Column,
                     num_partitions: int | None = None, materialize: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows where ``subset`` holds, each with ``pos_all`` (0-based position
    among all rows of its group in ``order``) and ``pos_sub`` (position among
    the subset rows of its group).  Returns ``(positions, ranged)`` where
    ``ranged`` is the checkpointed input, reusable for other aggregates.

    One range cut and checkpoint; everything after it is narrow: positions
    inside a partition come from monotonic ids, and the carry between
    partitions from frames with one row per (partition, group), broadcast
    back.  Use it when the number of groups is bounded (those frames hold at
    most partitions + groups rows)."""
    groups = _names(groups)
    ranged = ranged_checkpoint(df, [*groups, *order], num_partitions, materialize)
    sub = ranged.filter(subset).withColumn("_sid", F.monotonically_increasing_id())
    out = _add_position(sub, "_mid", _offsets(ranged, "_mid", groups, "a"), groups, "a", "pos_all")
    out = _add_position(out, "_sid", _offsets(sub, "_sid", groups, "s"), groups, "s", "pos_sub")
    return out.drop("_mid", "_sid"), ranged.drop("_mid")

"""Keeping groups small when one key holds a large share of all rows.

A window or a running total over ``key`` puts every row of the key into one task.  The helpers
here count rows per key first (one pre-aggregated pass over the key columns).  As long as no key is above the
limit, the plain plan is used.  Rows of keys above it are cut into ordered blocks by a range partitioning on
(key, order), which is balanced whatever the key distribution; what crosses a block edge is added back.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from roadcast.session import cut_lineage

MAX_GROUP_ROWS = 4_000_000
BUCKETS = 4_096  # keys are counted by hash first
FIND = "find"  # stands for "count the rows of the frame at hand"
Hot = DataFrame | None | str


def hot_keys(df: DataFrame, keys: Sequence[str], max_rows: int = MAX_GROUP_ROWS) -> DataFrame | None:
    """Keys with more than ``max_rows`` rows, their count ``_n`` and in how many ``_parts`` to cut them; None when there are none.

    Runs a job.  There can be at most (rows / max_rows) such keys.  The result may be handed to every step whose groups
    are no larger than those counted here, so that a derived frame is not computed only to be counted.

    Buckets of keys are counted first: a task holds as many counts as there are buckets, not one for each of its keys.  A bucket up to the limit has no key above it;
    only keys of the others, if any, are counted on their own.
    """
    bucket = F.pmod(F.hash(*keys), F.lit(BUCKETS))
    loads = df.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_rows)
    full = [row["_bucket"] for row in loads.collect()]
    if not full:
        return None
    hot = df.filter(bucket.isin(full)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_rows)
    hot = cut_lineage(hot.withColumn("_parts", F.ceil(F.col("_n") / max_rows).cast("int")))
    return None if hot.isEmpty() else hot


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal or both-NULL keys; keeps the key columns of the left side."""
    for key in keys:
        right = right.withColumnRenamed(key, f"_k_{key}")
    on = F.lit(True)
    for key in keys:
        on = on & F.col(key).eqNullSafe(F.col(f"_k_{key}"))
    return left.join(right, on, how).drop(*[f"_k_{key}" for key in keys])


def spread_join(
    df: DataFrame, side: DataFrame, on: Sequence[str], key: str, hot: DataFrame | None, how: str = "left"
) -> DataFrame:
    """``df.join(side, on, how)`` where rows of hot ``key`` values are dealt to several tasks.

    ``side`` is copied for those keys, once per part.  The hot keys are broadcast: there are at most
    (rows / max_rows) of them.  ``how`` is inner or left.
    """
    if hot is None:
        return df.join(side, list(on), how)
    parts = F.broadcast(hot.select(F.col(key).alias("_hk"), "_parts"))
    dealt = df.join(parts, F.col(key) == F.col("_hk"), "left")
    part = F.pmod(F.xxhash64(*df.columns), F.coalesce("_parts", F.lit(1))).cast("int")
    dealt = dealt.withColumn("_part", part).select(*df.columns, "_part")
    copies = side.join(parts, F.col(key) == F.col("_hk"), "left")
    copies = copies.withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
    return dealt.join(copies.select(*side.columns, "_part"), [*on, "_part"], how).drop("_part")


def _ordered_blocks(df: DataFrame, keys, order, n_rows: int, rows_per_block: int) -> DataFrame:
    """Rows in written blocks that follow (keys, order); ``_tie`` makes the order total."""
    parts = max(2, math.ceil(n_rows / rows_per_block))
    blocks = (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(parts, *keys, *order, "_tie")
        .withColumn("_block", F.spark_partition_id())
    )
    return cut_lineage(blocks)


def _with_halo(blocks: DataFrame, keys, order, before: int, after: int) -> DataFrame:
    """Add to each block copies (``_own`` false) of the rows its first and last rows look at."""
    reach = max(before, after)
    up = [F.col(c).asc() for c in (*order, "_tie")]
    down = [F.col(c).desc() for c in (*order, "_tie")]
    head = blocks.withColumn("_r", F.row_number().over(Window.partitionBy(*keys, "_block").orderBy(*up)))
    tail = blocks.withColumn("_r", F.row_number().over(Window.partitionBy(*keys, "_block").orderBy(*down)))
    edges = head.filter(F.col("_r") <= reach).unionByName(tail.filter(F.col("_r") <= reach))
    edges = edges.drop("_r").dropDuplicates([*keys, "_block", "_tie"])
    seq = Window.partitionBy(*keys).orderBy("_block", *up)
    seen_by = [F.lead("_block", j).over(seq) for j in range(1, before + 1)]
    seen_by += [F.lag("_block", j).over(seq) for j in range(1, after + 1)]
    halo = (
        edges.withColumn("_seen_by", F.array_distinct(F.array(*seen_by)))
        .withColumn("_to", F.explode("_seen_by"))
        .drop("_seen_by")
        .filter(F.col("_to").isNotNull() & (F.col("_to") != F.col("_block")))
        .withColumn("_block", F.col("_to"))
        .drop("_to")
        .withColumn("_own", F.lit(False))
    )
    return blocks.withColumn("_own", F.lit(True)).unionByName(halo)


def _split(df: DataFrame, hot: DataFrame, keys) -> tuple[DataFrame, DataFrame, int]:
    total = hot.agg(F.sum("_n")).first()[0]
    return join_keys(df, hot, keys, "left_anti"), join_keys(df, hot, keys, "left_semi"), total


def neighbour_window(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    add: Callable[[DataFrame, WindowSpec], DataFrame],
    before: int,
    after: int,
    max_rows: int = MAX_GROUP_ROWS,
    hot: Hot = FIND,
) -> DataFrame:
    """Apply ``add(df, window)`` with lag/lead columns that reach ``before`` rows back and ``after`` rows on."""
    hot = hot_keys(df, keys, max_rows) if hot is FIND else hot
    if hot is None:
        return add(df, Window.partitionBy(*keys).orderBy(*order))
    cold, rows, total = _split(df, hot, keys)
    blocks = _ordered_blocks(rows, keys, order, total, max_rows)
    padded = _with_halo(blocks, keys, order, before, after)
    big = add(padded, Window.partitionBy(*keys, "_block").orderBy(*order, "_tie"))
    big = big.filter("_own").drop("_own", "_block", "_tie")
    return add(cold, Window.partitionBy(*keys).orderBy(*order)).unionByName(big)


def run_numbers(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    starts: Callable[[WindowSpec], Column],
    out: str,
    max_rows: int = MAX_GROUP_ROWS,
    hot: Hot = FIND,
) -> DataFrame:
    """Number runs 1, 2, .. inside each key: a row opens a run where ``starts(window)`` holds.

    ``starts`` may look one row back.  For keys above the limit the number is the one within the block plus the
    runs opened in the blocks before it.
    """

    def add(frame: DataFrame, w: WindowSpec, flag_only: bool = False) -> DataFrame:
        flagged = frame.withColumn("_start", starts(w).cast("bigint"))
        if flag_only:
            return flagged
        total = F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return flagged.withColumn(out, total).drop("_start")

    hot = hot_keys(df, keys, max_rows) if hot is FIND else hot
    plain = Window.partitionBy(*keys).orderBy(*order)
    if hot is None:
        return add(df, plain)
    cold, rows, total = _split(df, hot, keys)
    blocks = _ordered_blocks(rows, keys, order, total, max_rows)
    in_block = Window.partitionBy(*keys, "_block").orderBy(*order, "_tie")
    flagged = add(_with_halo(blocks, keys, order, 1, 0), in_block, flag_only=True).filter("_own")
    opened = flagged.groupBy(*keys, "_block").agg(F.sum("_start").alias("_opened"))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    opened = opened.withColumn("_offset", F.coalesce(F.sum("_opened").over(earlier), F.lit(0))).drop("_opened")
    local = F.sum("_start").over(in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    big = join_keys(flagged.withColumn("_local", local), opened, [*keys, "_block"])
    big = big.select(*df.columns, (F.col("_local") + F.col("_offset")).alias(out))
    return add(cold, plain).unionByName(big)

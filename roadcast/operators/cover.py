"""Which intervals cover a point in time: the shared core of all incident features.

Time is cut into cells of 2^11 seconds.  An interval becomes its part of the first cell, its part of the last one, and aligned spans of 2^k cells
between them, at most two of each k; an interval inside one cell that touches neither edge is cut into aligned spans of 2^k seconds.  Equal
pieces are merged, with their aggregates, before anything is collected.  Pieces are kept in three tiers: those inside a cell, spans of 2^11 to 2^21 seconds by the
2^22 seconds they lie in, and longer ones by 2^33 seconds.  A list has at most 2,048 pieces that reach its cell's end, 2,048 that begin with it and
4,094 aligned spans, whatever number of intervals falls on one key and however long they are.

A row looks up its own cell, its own 2^22 and its own 2^33 seconds in three equi joins.  No row is multiplied and nothing has to be grouped back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadcast.session import cut_lineage
from roadcast.skew import spread_join

STEP = 11  # bits per tier
TIERS = 3
_FOLDS = {"sum": F.sum, "max": F.max}


def _right(value: Column, bits) -> Column:
    return F.call_function("shiftright", value, bits if isinstance(bits, Column) else F.lit(bits))


def _left(value: Column, bits) -> Column:
    return F.call_function("shiftleft", value, bits if isinstance(bits, Column) else F.lit(bits))


def _cut(intervals: DataFrame, kept: Sequence[str]) -> DataFrame:
    """(kept, tier, cell, s, e): the pieces of the intervals from ``_s`` to ``_e``, both included.

    An interval's pieces are numbered: -2 and -1 are its parts of the first and the last cell, 2 k and 2 k + 1 the aligned spans of 2^k units that [_low, _high) may
    have on level k, and those after the top level the widest spans.  On each level the units are halved k times; an odd first one cannot be half of a wider
    span, and an odd end leaves one before it.  Levels whose spans are wider than the interval get no number.  Numbers become rows first and are
    computed then, in columns: nested in one list, these expressions would be interpreted for each interval.
    """
    top = TIERS * STEP - 1 - STEP  # levels of cells that have a wider one above them
    s, e, first, last, low, high, n = (F.col(c) for c in ("_s", "_e", "_first", "_last", "_low", "_high", "_n"))
    rows = intervals.withColumns({"_first": _right(s, STEP), "_last": _right(e, STEP)})
    inside = first == last
    touches = (s == _left(first, STEP)) | (e == _left(first + 1, STEP) - 1)
    rows = rows.withColumns({"_inside": inside, "_whole": inside & touches})
    rows = rows.withColumns({"_low": F.when(F.col("_inside"), s).otherwise(first + 1), "_high": F.when(F.col("_whole"), s).when(F.col("_inside"), e + 1).otherwise(last)})
    most = F.when(F.col("_inside"), F.lit(STEP - 1)).otherwise(F.lit(top - 1))
    rows = rows.withColumn("_k", F.when(low < high, F.least(most, F.length(F.bin(high - low)) - 1)).otherwise(F.lit(-1)))
    widest, n_widest = -_right(-low, top), _right(high, top) - -_right(-low, top)
    more = F.when(~F.col("_inside") & (F.col("_k") == top - 1) & (n_widest > 0), n_widest).otherwise(F.lit(0).cast("bigint"))
    rows = rows.withColumn("_n", F.explode(F.sequence(F.lit(-2).cast("bigint"), 2 * F.col("_k") + 1 + more)))

    wide = ~F.col("_inside") & (n >= 2 * top)
    level = F.when(wide, F.lit(top)).otherwise(F.greatest(_right(n, 1), F.lit(0))).cast("int")
    rows = rows.withColumns({"_k": level, "_bits": level + F.when(F.col("_inside"), F.lit(0)).otherwise(F.lit(STEP))})
    rows = rows.withColumns({"_a": -_right(-low, F.col("_k")), "_z": _right(high, F.col("_k"))})
    odd = lambda v: v.bitwiseAND(F.lit(1).cast("bigint")) == 1
    begins, ends = (F.pmod(n, F.lit(2)) == 0) & odd(F.col("_a")), (F.pmod(n, F.lit(2)) == 1) & odd(F.col("_z"))
    at = F.when(n < 0, F.lit(None)).when(wide, widest + n - 2 * top).when(F.col("_a") < F.col("_z"), F.when(begins, F.col("_a")).when(ends, F.col("_z") - 1))
    rows = rows.withColumn("_at", at.cast("bigint"))
    start = F.when((n == -2) & (~F.col("_inside") | F.col("_whole")), s).when((n == -1) & ~F.col("_inside"), _left(last, STEP))
    end = F.when(n == -1, e).otherwise(F.when(F.col("_whole"), e).otherwise(_left(first + 1, STEP) - 1))
    tier = F.when((n < 0) | (F.col("_bits") < STEP), F.lit(0)).when(F.col("_bits") < 2 * STEP, F.lit(1)).otherwise(F.lit(TIERS - 1))
    rows = rows.select(
        *kept, tier.alias("tier"), F.when(n < 0, start).otherwise(_left(F.col("_at"), F.col("_bits"))).alias("s"), F.when(n < 0, end).otherwise(_left(F.col("_at") + 1, F.col("_bits")) - 1).alias("e")
    ).filter("s IS NOT NULL")
    return rows.select(*kept, "tier", _right(F.col("s"), ((F.col("tier") + 1) * STEP).cast("int")).alias("cell"), "s", "e")


def interval_pieces(
    intervals: DataFrame,
    keys: Sequence[str],
    values: Mapping[str, tuple[Column, str]],
    start: str = "start_ts",
    end: str = "end_ts",
) -> DataFrame:
    """(keys, tier, cell, s, e, values): pieces of the intervals, merged where they agree.

    ``values`` gives each output its row expression and how to merge it, "sum" or "max".  Intervals that end before they start, and those without an end
    or a start, cover nothing.
    """
    rows = intervals.filter(F.col(start) <= F.col(end)).select(
        *keys, F.col(start).cast("bigint").alias("_s"), F.col(end).cast("bigint").alias("_e"), *[v.alias(n) for n, (v, _) in values.items()]
    )
    return merge_pieces(_cut(rows, [*keys, *values]), keys, {n: fold for n, (_, fold) in values.items()})


def merge_pieces(pieces: DataFrame, keys: Sequence[str], folds: Mapping[str, str]) -> DataFrame:
    grouped = [*keys, "tier", "cell", "s", "e"]
    if not folds:
        return pieces.select(*grouped).distinct()
    return pieces.groupBy(*grouped).agg(*[_FOLDS[fold](n).alias(n) for n, fold in folds.items()])


def pieces_met(pieces: DataFrame, places: Sequence[str], near: DataFrame, moments: DataFrame, key: str, folds: Mapping[str, str], ts: str = "snapshot_ts") -> DataFrame:
    """Pieces of ``places`` for the keys they are ``near``, as far as they hold one of the ``moments`` (key, ts) of the key.

    A moment lies in one cell and in one aligned span of each width in use, so places and moments meet on those.  What meets is cut to the
    first and the last moment of the key in that cell or span: pieces that differ in nothing else become one.  Only that is
    shuffled, not every piece of a place for every key near it.
    """
    widths = [row[0] for row in pieces.filter("tier > 0").select(F.col("e") - F.col("s") + 1).distinct().collect()]
    at = lambda width: F.struct(F.lit(width).cast("bigint").alias("_width"), _left(_right(F.col("_t"), bits := (width or 1 << STEP).bit_length() - 1), bits).alias("_at"))
    known = moments.select(key, F.col(ts).cast("bigint").alias("_t")).dropna()
    wanted = known.select(key, "_t", F.inline(F.array(*[at(width) for width in (0, *sorted(widths))])))
    wanted = wanted.groupBy(key, "_width", "_at").agg(F.min("_t").alias("_low"), F.max("_t").alias("_high"))
    edge = F.col("tier") == 0
    held = pieces.withColumns({"_width": F.when(edge, F.lit(0)).otherwise(F.col("e") - F.col("s") + 1), "_at": F.when(edge, _left(F.col("cell"), STEP)).otherwise(F.col("s"))})
    on = [*places, "_width", "_at"]
    met = wanted.join(near.select(*places, key), key).join(held, on).filter((F.col("s") <= F.col("_high")) & (F.col("_low") <= F.col("e")))
    cut = {"s": F.greatest("s", "_low"), "e": F.least("e", "_high")}
    met = met.withColumns(cut).groupBy(*on, key, "tier", "cell", "s", "e").agg(*[_FOLDS[fold](n).alias(n) for n, fold in folds.items()])
    # one shuffle for the merge and for the lists made of it
    return merge_pieces(met.repartition(key, "tier", "cell"), [key], folds)


def cover_table(pieces: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row per (keys, tier, cell) with the bounded list ``_pieces``; written, since each tier is read by a join of its own."""
    return cut_lineage(pieces.groupBy(*keys, "tier", "cell").agg(F.collect_list(F.struct("s", "e", *names)).alias("_pieces")))


def look_up(
    df: DataFrame,
    cover: DataFrame,
    keys: Sequence[str],
    folds: Mapping[str, str],
    ts: str = "snapshot_ts",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Add the merged values of the intervals that cover ``ts``: sums are 0 and maxima NULL without one."""
    rows, used = df, {row["tier"] for row in cover.select("tier").distinct().collect()}  # tiers without a piece need no join
    nothing = F.array().cast(cover.schema["_pieces"].dataType)
    hits = []
    for tier in sorted(used):
        side = cover.filter(F.col("tier") == tier).select(*keys, F.col("cell").alias("_cell"), F.col("_pieces").alias(f"_in{tier}"))
        rows = rows.withColumn("_cell", _right(F.col(ts).cast("bigint"), (tier + 1) * STEP))
        rows = spread_join(rows, side, [*keys, "_cell"], keys[0], hot).drop("_cell")
        within = F.filter(f"_in{tier}", lambda p: (p["s"] <= F.col(ts)) & (F.col(ts) <= p["e"]))
        hits.append(F.coalesce(within, nothing))
    rows = rows.withColumn("_hits", F.concat(*hits) if hits else nothing)
    out = {"_covered": F.size("_hits") > 0}
    for name, fold in folds.items():
        field = F.col("_hits")[name]
        if fold == "max":
            out[name] = F.array_max(field)
        else:
            out[name] = F.aggregate(field, F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return rows.withColumns(out).drop("_hits", *[f"_in{tier}" for tier in range(TIERS)])

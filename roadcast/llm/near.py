"""Groups of similar units from bucket collisions: pivots instead of all pairs, verified links, components by stars."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadcast.llm.common import Steps

LEAST_PARTS, PAIRS_PER_PART = 64, 4096
FIRST_BUCKETS = 6
MARKS, FEW_MARKS = 64, 8  # words of 64 bits that tell which codes a unit has, and a unit with few codes
ROUNDS = (1, 1, 16, None)  # pivots of a bucket in each round; in the last one all that may still be in need of a comparison


class WordCodes(dict):
    """64-bit code per word, kept while there are not too many."""

    def __missing__(self, word: str) -> int:
        if len(self) > 150_000:
            self.clear()
        code = self[word] = xxhash.xxh64_intdigest(word.encode())
        return code


def word_codes(found: list[str], codes: WordCodes) -> np.ndarray:
    return np.fromiter(map(codes.__getitem__, found), np.uint64, len(found))


def content_key(found: list[str]) -> bytes:
    """128-bit identity of a word sequence."""
    return hashlib.blake2b(" ".join(found).encode(), digest_size=16).digest()


def shingle_codes(codes: np.ndarray, k: int = 5) -> np.ndarray:
    """Codes of the runs of ``k`` words, in text order; a shorter text is one run."""
    if not len(codes):
        return codes
    k = min(k, len(codes))
    n = len(codes) - k + 1
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = (out ^ codes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def seeds(n: int, name: str) -> np.ndarray:
    """``n`` odd multipliers that depend on ``name`` only."""
    return np.array([xxhash.xxh64_intdigest(f"{name}:{i}") | 1 for i in range(n)], np.uint64)


# --- components -----------------------------------------------------------------------------------------------------


def components(edges: DataFrame, steps: Steps) -> DataFrame:
    """(uid, comp) of every unit on an edge (a, b); comp is the least uid of its component.

    Large and small stars in turn: each unit passes the least neighbour it knows to its neighbours.  Per round there are only
    aggregates and equi joins, and no list of neighbours is built.  The driver sees a count and a checksum.
    """

    def write(df):
        return steps.write_and_sum(df, n=F.lit(1), sum=F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))

    now, state = write(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    while state["n"]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = steps.write(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        small, after = write(moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        steps.drop(now, large)
        now, same, state = small, after == state, after
        if same:
            break
    roots = now.select(F.col("b").alias("uid"), F.col("b").alias("comp")).distinct()
    return now.select(F.col("a").alias("uid"), F.col("b").alias("comp")).unionByName(roots)


# --- links ----------------------------------------------------------------------------------------------------------

Prepare = Callable[[list[str]], Iterable[object]]
Similar = Callable[[object, object], bool]
Codes = Callable[[object], np.ndarray]


def _verify(prepare: Callable[[], Prepare], similar: Similar) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows come sorted by pivot and part, the pivot's own row first; only one pivot is held."""

    def run(batches):
        make = prepare()
        pivot, ready = None, None
        for batch in batches:
            left, right = [], []
            for a, b, made in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), make(batch.column("text").to_pylist())):
                if b is None:
                    if a != pivot:
                        pivot, ready = a, made
                elif similar(ready, made):
                    left.append(a)
                    right.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["a", "b"])

    return run


def verified(pairs: DataFrame, n_pairs: int, texts: DataFrame, prepare: Callable[[], Prepare], similar: Similar, steps: Steps) -> DataFrame:
    """The (a, b) of ``pairs`` whose texts are similar.

    The members of a pivot are dealt to parts, more of them the more pairs there are, and its text goes once to each part that has any.
    So a pivot that half of the table collides with is no task of its own, and no pair carries two texts.
    """
    n_parts = max(LEAST_PARTS, n_pairs // PAIRS_PER_PART)
    dealt = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.lit(n_parts)).cast("int").alias("part"))
    members = dealt.join(texts.select(F.col("uid").alias("b"), "text"), "b").select("a", "b", "part", "text")
    pivots = dealt.select("a", "part").distinct().join(texts.select(F.col("uid").alias("a"), "text"), "a")
    pivots = pivots.select("a", F.lit(None).cast("binary").alias("b"), "part", "text")
    rows = members.unionByName(pivots).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return steps.write(rows.mapInArrow(_verify(prepare, similar), "a binary, b binary"))


def _marks(prepare: Callable[[], Prepare], codes: Codes, n_marks: int):
    """A bit per cell of 64 * ``n_marks``: whether the unit has an odd number of codes in it."""

    def run(batches):
        make, cells = prepare(), 64 * n_marks
        for batch in batches:
            found = []
            for made in make(batch.column("text").to_pylist()):
                odd = np.bincount((codes(made) >> np.uint64(20)).astype(np.int64) % cells, minlength=cells) & 1
                found.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("uid"), pa.array(found, pa.list_(pa.int64()))], names=["uid", "marks"])

    return run


def _codes_of(prepare: Callable[[], Prepare], codes: Codes):
    def run(batches):
        make = prepare()
        for batch in batches:
            found = [codes(made).view(np.int64) for made in make(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("uid"), pa.array(found, pa.list_(pa.int64()))], names=["uid", "codes"])

    return run


def rare_codes(texts: DataFrame, prepare: Callable[[], Prepare], codes: Codes, least_ratio: float, steps: Steps) -> DataFrame:
    """(uid, rare): of a unit with ``size`` codes the size - ceil(least_ratio * size) + 1 that stand in the fewest units, ties by code.

    Two units that have all but (1 - ``least_ratio``) of the larger size in common have one of these in common: in the order of all codes, the first one that both have is among them.
    """
    held = steps.write(texts.mapInArrow(_codes_of(prepare, codes), "uid binary, codes array<long>"))
    each = held.select("uid", F.explode("codes").alias("code"))
    often = each.groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    ranked = each.join(often, "code").groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("n", "code"))).alias("all"))
    wanted = F.size("all") - F.ceil(F.size("all") * F.lit(least_ratio) - F.lit(1e-9)).cast("int") + 1
    rare = steps.write(ranked.select("uid", F.explode(F.slice("all", F.lit(1), wanted)).alias("_c")).select("uid", F.col("_c.code").alias("rare")))
    steps.drop(held)
    return rare


def link_groups(
    units: DataFrame, fetch: Callable[[DataFrame], DataFrame], prepare: Callable[[], Prepare], similar: Similar, codes: Codes, least_ratio: float, steps: Steps, few_codes: bool = False
) -> DataFrame:
    """(uid, comp) of the units linked to another: components of all similar pairs that share a bucket.

    ``units``: (uid, size, n, buckets), repeated units allowed, ``n`` says how often a unit stands; units whose sizes are less than ``least_ratio`` apart cannot be similar and are not
    compared.  Buckets with one unit go first; until then rows are two numbers, a bucket and a code of the unit.  ``fetch``: uids to (uid, text).  In each round the first units of a bucket by falling ``n``, 1, then 16, are
    its pivots and are compared with all units of the bucket outside their component; then they leave it.  A bucket is done when the units left
    in it are in one component.  So pairs inside a group of copies are never listed, and every pair of a bucket has been compared or is joined
    by links already.  Nothing is capped.  One round over FIRST_BUCKETS of each unit goes ahead: most groups are joined by then, and their other
    buckets have nothing left to compare.

    In the last round the units outside a bucket's largest component are its pivots: of two units of different components one is.  A pair is listed in the
    first bucket that it shares only.  What is left by then are mostly units that share a part and are not similar.  ``codes`` gives the ``size`` codes of what ``prepare`` makes, of which similar
    units have all but (1 - ``least_ratio``) of the larger size in common.  A unit's bits say in which cells it has an odd number of them; where two units' bits differ, so do their
    codes, and pairs that differ in too many bits to be similar are not listed.  No similar pair is left out.  The join still holds each pivot against the units of its bucket; texts of 5,000 codes and more fill the
    cells, and their pairs are all listed.

    With ``few_codes`` units are not repeated, ``units`` is dropped when it has been read, no two codes of a unit are equal, and similar units have a Jaccard similarity of ``least_ratio`` or more.
    Then from the third round on units meet by a bucket and one of their :func:`rare_codes`, so that those of a large bucket that only share what makes them meet there are not held
    against each other, and the bits allow fewer differences.
    """
    code = F.xxhash64("uid").alias("_code")
    placed = units.select(code, F.posexplode("buckets").alias("nth", "bucket"))
    shared = placed.groupBy("bucket").agg(F.min("_code").alias("_low"), F.max("_code").alias("_high")).filter("_low <> _high").select("bucket")
    named, placed = units.select(code, "uid", "size", "n"), placed.join(shared, "bucket")
    if not few_codes:
        named, placed = named.distinct(), placed.distinct()
    found = placed.join(named, "_code").select("nth", "bucket", "uid", "size", "n")
    early = F.col("nth") < FIRST_BUCKETS
    active, sums = steps.write_and_sum(found.withColumn("comp", F.col("uid")), n=F.lit(1))
    texts = steps.write(fetch(active.select("uid").distinct()))
    if few_codes:
        steps.drop(units)
    groups = texts.select("uid", F.col("uid").alias("comp")).filter("false")
    tested = groups.select(F.col("uid").alias("_x"), F.col("comp").alias("_y"))
    larger, smaller = F.greatest("size", "_size"), F.least("size", "_size")
    meet = (F.col("comp") != F.col("_comp")) & (smaller >= larger * F.lit(least_ratio - 1e-9))
    differ = F.aggregate(F.zip_with("marks", "_marks", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda a, n: a + n)
    most = F.lit((1 - least_ratio) / (1 + least_ratio)) * (larger + smaller) if few_codes else 2 * F.floor(F.lit(1 - least_ratio) * larger + F.lit(1e-9)) - (larger - smaller)
    close = differ <= (most + F.lit(1e-9) if few_codes else most)
    marks = rare = None
    for turn, n_pivots in enumerate(ROUNDS):
        if not sums["n"]:
            break
        now, wanted, carried = (active.filter(early) if turn == 0 else active), meet, []
        on = ["bucket"]
        if turn > 1 and few_codes:
            rare = rare or rare_codes(texts.join(active.select("uid").distinct(), "uid"), prepare, codes, least_ratio, steps)
            on = ["bucket", "rare"]
        if turn > 1:
            if marks is None:
                marks = steps.write(texts.join(active.select("uid").distinct(), "uid").mapInArrow(_marks(prepare, codes, FEW_MARKS if few_codes else MARKS), "uid binary, marks array<long>"))
            now, wanted, carried = now.join(marks, "uid"), wanted & close, [F.col("marks").alias("_marks")]
        if n_pivots:
            # the filter on the row number is also applied before the shuffle, so a bucket sends few rows from each task
            first = now.withColumn("_r", F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("n"), "uid"))).filter(F.col("_r") <= n_pivots)
        else:
            largest = active.groupBy("bucket", "comp").agg(F.countDistinct("uid").alias("_n")).groupBy("bucket").agg(F.max(F.struct("_n", "comp"))["comp"].alias("_largest"))
            now = now.join(largest, "bucket").withColumn("asks", F.col("comp") != F.col("_largest")).drop("_largest")
            wanted = wanted & (~F.col("asks") | (F.col("uid") > F.col("a")))
            if not few_codes:
                now = now.join(active.groupBy("uid").agg(F.collect_set("bucket").alias("all")), "uid")
                carried, wanted = [*carried, F.col("all").alias("_all")], wanted & (F.array_min(F.array_intersect("all", "_all")) == F.col("bucket"))
            first = now.filter("asks")
        pivots = steps.write(first.select("bucket", F.col("uid").alias("a"), F.col("comp").alias("_comp"), F.col("size").alias("_size"), *carried))
        asked = pivots
        if len(on) > 1:
            now, asked = now.join(rare, "uid"), pivots.join(rare.withColumnRenamed("uid", "a"), "a")
        pairs = now.join(asked, on).filter(wanted).select("a", F.least("a", "uid").alias("_x"), F.greatest("a", "uid").alias("_y"))
        # the pivot is the lesser of the two if that is one in any bucket; flags and numbers are aggregated without sorting
        pairs = pairs.groupBy("_x", "_y").agg(F.max(F.col("a") == F.col("_x")).alias("_lesser")).join(tested, ["_x", "_y"], "left_anti")
        a, b = (F.when(F.col("_lesser"), F.col(one)).otherwise(F.col(other)).alias(name) for name, one, other in (("a", "_x", "_y"), ("b", "_y", "_x")))
        pairs, many = steps.write_and_sum(pairs.select("_x", "_y", a, b), n=F.lit(1))
        if many["n"]:
            found = verified(pairs.select("a", "b"), many["n"], texts, prepare, similar, steps)
            tested = tested.unionByName(pairs.select("_x", "_y"))
            known = groups.select(F.col("uid").alias("a"), F.col("comp").alias("b"))
            known_before, groups = groups, steps.write(components(known.unionByName(found), steps))
            steps.drop(known_before, found)
        if not n_pivots:
            break
        is_pivot = pivots.select("bucket", F.col("a").alias("uid"))
        left = active.join(is_pivot, ["bucket", "uid"], "left_anti").select("nth", "bucket", "uid", "size", "n")
        left = left.join(groups, "uid", "left").select("nth", "bucket", "uid", "size", "n", F.coalesce("comp", "uid").alias("comp"))
        comp = F.xxhash64("comp")
        split = left.groupBy("bucket").agg(F.min(comp).alias("_low"), F.max(comp).alias("_high")).filter("_low <> _high").select("bucket")
        before = active
        active, sums = steps.write_and_sum(left.join(split, "bucket").select("nth", "bucket", "uid", "size", "n", "comp"), n=F.lit(1))
        steps.drop(before, pivots)
    return groups

"""Order MinHash near-duplicates: sketches of least occurrence-labelled runs of words in text order, checked by alignment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadcast.llm.common import Steps, words
from roadcast.llm.exact_dedup import NO_ID
from roadcast.llm.near import WordCodes, content_key, link_groups, seeds, shingle_codes, word_codes

_C = np.uint64(0xD6E8FEB86659FD93)


def labelled(codes: np.ndarray) -> np.ndarray:
    """Codes made different for the 2nd, 3rd, .. occurrence of a value."""
    order = np.argsort(codes, kind="stable")
    ranked = codes[order]
    starts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    if len(starts) == len(codes):
        return codes
    occurrence = np.empty(len(codes), np.uint64)
    occurrence[order] = np.arange(len(codes)) - np.repeat(starts, np.diff(np.r_[starts, len(codes)]))
    mixed = (codes ^ (occurrence * _C)) * _C
    return np.where(occurrence == 0, codes, mixed ^ (mixed >> np.uint64(31)))


def order_sketches(runs: np.ndarray, multipliers: np.ndarray, ell: int) -> np.ndarray:
    """One code per multiplier: the ``ell`` runs with the least hash, taken in text order."""
    marked = labelled(runs)
    take = min(ell, len(marked))
    out = np.empty(len(multipliers), np.uint64)
    block = max(1, (1 << 20) // len(marked))
    for at in range(0, len(multipliers), block):
        hashed = marked[None, :] * multipliers[at : at + block, None]
        if take < len(marked):
            where = np.sort(np.argpartition(hashed, take - 1, axis=1)[:, :take], axis=1)
        else:
            where = np.broadcast_to(np.arange(take), hashed.shape)
        chosen = marked[where]
        code = multipliers[at : at + block].copy()
        for n in range(take):
            code = (code ^ chosen[:, n]) * _C
            code ^= code >> np.uint64(32)
        out[at : at + block] = code
    return out


def banded_distance(a: np.ndarray, b: np.ndarray, limit: int) -> int:
    """Edit distance of two word sequences, or ``limit`` + 1 if it is larger.

    The alignment matrix is walked column by column in a band of ``limit`` cells on both sides of the diagonal; the band's column of
    up and down steps is one bit vector each.
    """
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > limit:
        return limit + 1
    n = len(b)
    differ = np.flatnonzero(a[:n] != b)
    head = int(differ[0]) if len(differ) else n
    a, b = a[head:], b[head:]
    n = len(b)
    differ = np.flatnonzero(a[len(a) - n :] != b) if n else ()
    tail = n - 1 - int(differ[-1]) if len(differ) else n
    a, b = a[: len(a) - tail], b[: n - tail]
    if not len(b):
        return len(a)
    limit_now = min(limit, len(a))
    width = 2 * limit_now + 2
    full = (1 << width) - 1
    at: dict[int, int] = {}
    for i, code in enumerate(a.tolist()):
        at[code] = at.get(code, 0) | 1 << i
    up, down = full ^ ((1 << (width - limit_now - 1)) - 1), 0
    distance, start = limit_now, limit_now + 1 - width
    diagonal, horizontal = 1 << (width - 1), 1 << (width - 2)
    worst = limit_now + len(b) - (len(a) - limit_now)
    for j, code in enumerate(b.tolist()):
        same = at.get(code, 0)
        same = (same << -start if start < 0 else same >> start) & full
        zero = ((((same & up) + up) ^ up) | same | down) & full
        plus = down | (full & ~(zero | up))
        minus = zero & up
        if j < len(a) - limit_now:
            distance += not zero & diagonal
        else:
            distance += bool(plus & horizontal) - bool(minus & horizontal)
            horizontal >>= 1
        if distance > worst:
            return limit + 1
        up = minus | (full & ~((zero >> 1) | plus))
        down = (zero >> 1) & plus
        start += 1
    return distance if distance <= limit else limit + 1


def _prepare():
    codes = WordCodes()

    def make(text):
        found = word_codes(words(text), codes)
        return found, np.sort(labelled(found))

    return lambda texts: map(make, texts)


def similar_by_alignment(threshold: float):
    """Words kept by the best alignment, as a share of the longer text; a bound from the words in common comes first."""

    def similar(one, two):
        (a, bag_a), (b, bag_b) = one, two
        longer = max(len(a), len(b))
        limit = int((1 - threshold) * longer + 1e-9)
        if abs(len(a) - len(b)) > limit:
            return False
        if longer - len(np.intersect1d(bag_a, bag_b, assume_unique=True)) > limit:
            return False
        return banded_distance(a, b, limit) <= limit

    return similar


SKETCHES = "row long, doc_id long, uid binary, size int, buckets array<long>"
_SKETCHES = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("uid", pa.binary()), ("size", pa.int32()), ("buckets", pa.list_(pa.int64()))])


def _sketch(n_sketches: int, ell: int, k: int):
    def run(batches) -> Iterator[pa.RecordBatch]:
        made, multipliers, codes, seen = TaskContext.get().partitionId() << 40, seeds(n_sketches, "order"), WordCodes(), set()
        for batch in batches:
            cols: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = words(text.as_py())
                uid = content_key(found)
                buckets = None
                if found and uid not in seen:
                    if len(seen) > 200_000:
                        seen.clear()
                    seen.add(uid)
                    buckets = order_sketches(shingle_codes(word_codes(found, codes), k), multipliers, ell).view(np.int64).tolist()
                for col, value in zip(cols, (made, doc_id, uid, len(found), buckets)):
                    col.append(value)
                made += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _SKETCHES)], schema=_SKETCHES)

    return run


def _texts_of(batches):
    """Texts by their word sequence, for rows whose text is the one looked for (ids can repeat)."""
    for batch in batches:
        keep = [n for n, (uid, text) in enumerate(zip(batch.column("uid").to_pylist(), batch.column("text"))) if content_key(words(text.as_py())) == uid]
        yield batch.take(pa.array(keep, pa.int32())).select(["uid", "text"])


def near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_sketches: int = 48, ell: int = 7, k: int = 5, threshold: float = 0.8
) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, kept.

    A sketch takes the ``ell`` runs of ``k`` words with the least hash, each labelled with its occurrence, in text order, so two texts share one
    when these runs agree and follow in the same order.  Documents that share any of ``n_sketches`` are compared: similar means that an
    alignment keeps ``threshold`` of the longer text's words.  Classes are the components of these links, the row with the least id stays.

    Texts with equal words are one unit and are never compared with each other.  Null and empty texts, and those without letters or
    digits, are copies of each other.  Repeated rows count as copies, exactly one row of a class stays.  A null id ranks first and
    comes back as null.  Empty tables give no rows; other columns are not read.
    """
    steps = Steps(docs.sparkSession)
    source = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = steps.write(source.mapInArrow(_sketch(n_sketches, ell, k), SKETCHES))
    units = rows.filter("buckets IS NOT NULL").select("uid", "size", F.lit(1).alias("n"), "buckets")

    def fetch(uids: DataFrame) -> DataFrame:
        first = rows.join(uids, "uid", "left_semi").groupBy("uid").agg(F.min("doc_id").alias("doc_id"))
        return source.join(first, "doc_id").select("uid", "text").mapInArrow(_texts_of, "uid binary, text string").dropDuplicates(["uid"])

    groups = link_groups(units, fetch, _prepare, similar_by_alignment(threshold), lambda ready: ready[1], threshold, steps)
    return classes(rows, groups, "doc_id")


def classes(rows: DataFrame, groups: DataFrame, id_col: str) -> DataFrame:
    """One row per row of ``rows`` (row, id, uid): class id, size, and whether it is the one that stays."""
    units = rows.groupBy("uid").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(id_col, "row")).alias("_first"))
    units = units.join(groups, "uid", "left").withColumn("comp", F.coalesce("comp", "uid"))
    whole = units.groupBy("comp").agg(F.sum("_n").alias("class_size"), F.min("_first").alias("_stays"))
    found = rows.select("row", id_col, "uid").join(units.join(whole, "comp").select("uid", "class_size", "_stays"), "uid")
    known = lambda c: F.when(c != NO_ID, c)
    return found.select(
        known(F.col(id_col)).alias("doc_id"), known(F.col(f"_stays.{id_col}")).alias("class_id"), "class_size", (F.col("row") == F.col("_stays.row")).alias("kept")
    )

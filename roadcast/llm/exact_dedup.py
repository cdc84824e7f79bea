"""Grace hash deduplication: records are partitioned by a hash of their text until each bucket fits a hash table."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadcast.llm.common import Steps

NO_ID = -(1 << 63)


class TextTable:
    """Open addressing with linear probing; entries are equal only if their complete content is."""

    def __init__(self) -> None:
        self.slots = [-1] * 1024
        self.texts: list[bytes] = []
        self.hashes: list[int] = []
        self.n_bytes = 0

    def find(self, code: int, text: bytes) -> tuple[int, int]:
        """Entry of ``text`` or -1, and the slot where the search ended."""
        mask = len(self.slots) - 1
        at = code & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == code and self.texts[entry] == text:
                return entry, at
            at = (at + 1) & mask
        return -1, at

    def add(self, code: int, text: bytes, at: int) -> int:
        entry = len(self.texts)
        self.slots[at] = entry
        self.texts.append(text)
        self.hashes.append(code)
        self.n_bytes += len(text)
        if 2 * len(self.texts) > len(self.slots):
            self.slots = [-1] * (2 * len(self.slots))
            mask = len(self.slots) - 1
            for known, other in enumerate(self.hashes):
                at = other & mask
                while self.slots[at] >= 0:
                    at = (at + 1) & mask
                self.slots[at] = known
        return entry


SPILL = "doc_id long, key long, top boolean, sha binary, n long, n_bytes long, text binary"
_SPILL = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("top", pa.bool_()), ("sha", pa.binary()), ("n", pa.int64()), ("n_bytes", pa.int64()), ("text", pa.large_binary())])


def _combine(window_bytes: int, window_rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Join equal texts of neighbouring rows before any shuffle.

    One row per document comes out.  The row marked ``top`` (largest id, the first of equals) carries the text and
    count of its window's copies, the others only the key they share with it.
    """

    def run(batches):
        part = TaskContext.get().partitionId()
        made = 0
        table, rows, tops, counts = TextTable(), [], [], []

        def flush():
            nonlocal made, table, rows, tops, counts
            first = (part << 40) + made
            ids = [r[0] for r in rows]
            entries = [r[1] for r in rows]
            is_top = [tops[e] == n for n, e in enumerate(entries)]
            sha = [r[2] for r in rows]
            out = [
                ids, [first + e for e in entries], is_top, sha,
                [counts[e] if t else None for e, t in zip(entries, is_top)],
                [len(table.texts[e]) if t else None for e, t in zip(entries, is_top)],
                [table.texts[e] if t else None for e, t in zip(entries, is_top)],
            ]
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _SPILL)], schema=_SPILL)
            made += len(table.texts)
            table, rows, tops, counts = TextTable(), [], [], []
            return batch

        for batch in batches:
            texts = batch.column(1).cast(pa.binary() if batch.schema.types[1] != pa.large_string() else pa.large_binary())
            for doc_id, text in zip(batch.column(0).to_pylist(), texts):
                content = text.as_py()
                digest = hashlib.sha256(content).digest()
                code = int.from_bytes(digest[:8], "little")
                entry, at = table.find(code, content)
                if entry < 0:
                    entry = table.add(code, content, at)
                    tops.append(len(rows))
                    counts.append(0)
                elif doc_id > rows[tops[entry]][0]:
                    tops[entry] = len(rows)
                counts[entry] += 1
                rows.append((doc_id, entry, digest))
                if table.n_bytes >= window_bytes or len(rows) >= window_rows:
                    yield flush()
        if rows:
            yield flush()

    return run


CLASSES = "key long, keep_key long, keep_id long, size long, doc_id long, n long, sha binary, n_bytes long, text binary"
_CLASSES = pa.schema([("key", pa.int64()), ("keep_key", pa.int64()), ("keep_id", pa.int64()), ("size", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("sha", pa.binary()), ("n_bytes", pa.int64()), ("text", pa.large_binary())])


def _build(table_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One bucket: texts enter the table until it is full; rows of texts that are not in it then go to the next round."""

    def run(batches):
        table, best, sizes, members = TextTable(), [], [], []
        for batch in batches:
            keys, ids, counts = (batch.column(c).to_pylist() for c in ("key", "doc_id", "n"))
            over = []
            for row, (digest, text) in enumerate(zip(batch.column("sha").to_pylist(), batch.column("text"))):
                content = text.as_py()
                code = int.from_bytes(digest[8:16], "little")
                entry, at = table.find(code, content)
                if entry < 0:
                    if table.texts and table.n_bytes + len(content) > table_bytes:
                        over.append(row)
                        continue
                    entry = table.add(code, content, at)
                    best.append((ids[row], -keys[row]))
                    sizes.append(0)
                best[entry] = max(best[entry], (ids[row], -keys[row]))
                sizes[entry] += counts[row]
                members.append((keys[row], entry))
            if over:
                rest = batch.take(pa.array(over))
                none = pa.nulls(len(over), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [rest.column("key"), none, none, none, rest.column("doc_id"), rest.column("n"), rest.column("sha"), rest.column("n_bytes"), rest.column("text").cast(pa.large_binary())], schema=_CLASSES
                )
        for start in range(0, len(members), 50_000):
            some = members[start : start + 50_000]
            none = pa.nulls(len(some), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k for k, _ in some], pa.int64()), pa.array([-best[e][1] for _, e in some], pa.int64()), pa.array([best[e][0] for _, e in some], pa.int64()),
                    pa.array([sizes[e] for _, e in some], pa.int64()), none, none, pa.nulls(len(some), pa.binary()), none, pa.nulls(len(some), pa.large_binary()),
                ], schema=_CLASSES,
            )

    return run


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window_bytes: int = 16 << 20, window_rows: int = 50_000, bucket_bytes: int = 16 << 20, table_bytes: int = 48 << 20
) -> DataFrame:
    """Group rows whose texts are identical; one row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    1. Each task joins the copies inside windows of ``window_bytes`` distinct content, so that a text that fills a third
       of the table reaches its bucket once per window.  The records are written to spill files in the shared folder.
    2. A round deals the records to buckets by a hash of the text.  Each bucket goes through an open-addressing table
       that compares whole texts.  A table holds ``table_bytes``; rows of texts that no longer fit go to spill files and
       through the next round, under another hash, until none are left.  Copies stream by, only distinct texts stay.
    3. The rows take their class from the key that they share with their window's record.

    Null texts count as empty.  The row with the largest id of a group stays; of repeated rows with that id, one.  A null id
    ranks below all others and comes back as null.  Empty tables give no rows; other columns are not read.
    """
    steps = Steps(docs.sparkSession)
    source = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spill, sums = steps.write_and_sum(source.mapInArrow(_combine(window_bytes, window_rows), SPILL), bytes=F.col("n_bytes"))
    records, total, level, done = spill.filter("top").select("key", "doc_id", "n", "sha", "n_bytes", "text"), sums["bytes"], 0, None
    while True:
        dealt = records.repartition(max(1, math.ceil(total / bucket_bytes)), F.xxhash64("sha", F.lit(level)))
        out, sums = steps.write_and_sum(dealt.mapInArrow(_build(table_bytes), CLASSES), bytes=F.col("n_bytes"), rows=F.when(F.col("keep_key").isNull(), 1))
        part = out.filter("keep_key IS NOT NULL").select("key", "keep_key", "keep_id", "size")
        done = part if done is None else done.unionByName(part)
        if not sums["rows"]:
            break
        records, total, level = out.filter("keep_key IS NULL").select("key", "doc_id", "n", "sha", "n_bytes", "text"), sums["bytes"], level + 1
    rows = spill.select("doc_id", "key", "top", "sha").join(done, "key")
    known = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return rows.select(
        known("doc_id").alias("doc_id"), known("keep_id").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("top") & (F.col("key") == F.col("keep_key"))).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )

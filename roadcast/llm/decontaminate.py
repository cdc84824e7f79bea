"""Benchmark decontamination: BM25 over an inverted index of test items, block-max WAND per training passage, overlap checks."""

from __future__ import annotations

import math
import re
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadcast.llm.common import words
from roadcast.llm.exact_dedup import NO_ID

K1, B = 1.2, 0.75
BLOCK = 8
LEAST_SHARE = 0.6
CHUNK_BYTES = 16 << 20
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of all sentences but the last, and of the last; an item of one sentence is all question."""
    parts = [p for p in (words(s) for s in _SENTENCE.split(text)) if p]
    if len(parts) < 2:
        return (parts[0] if parts else []), []
    return [w for p in parts[:-1] for w in p], parts[-1]


def runs_of(found: list[str], k: int) -> set[tuple[str, ...]]:
    k = min(k, len(found))
    return {tuple(found[n : n + k]) for n in range(len(found) - k + 1)} if k else set()


@dataclass
class Index:
    """Postings of one chunk of items.  Impacts are BM25 terms divided by the item's score for itself.

    Lists are arrays of the standard library: numpy reads them as they are, and ``bisect`` finds a place in a short one far sooner than numpy does.
    """

    items: list[tuple[int, str]]
    terms: dict[str, int] = field(default_factory=dict)
    postings: list[tuple[array, array]] = field(default_factory=list)  # items ascending, impacts
    blocks: list[tuple[array, array]] = field(default_factory=list)  # blocks ascending, most impact in each
    best: list[float] = field(default_factory=list)
    rare: np.ndarray | None = None  # terms that a passage above the threshold must have some of
    rest: np.ndarray | None = None  # per block, what all other terms can add
    window: int = 0


def build_index(items: list[tuple[int, str]], df: dict[str, int], n_items: int, mean_words: float, window: int, threshold: float) -> Index:
    """``df``, ``n_items``, ``mean_words`` and ``window`` (words of the longest item) are of all items, also those of other chunks."""
    split = sorted(((words(t), i, t) for i, t in items), key=lambda x: (len(x[0]), x[1], x[2]))
    split = [s for s in split if s[0]]
    index = Index([(i, t) for _, i, t in split], window=window)
    gathered: list[list[tuple[int, float]]] = []
    others = np.zeros(len(split))
    kept_rare: set[int] = set()
    for n, (found, _, _) in enumerate(split):
        impact = {}
        for term, tf in Counter(found).items():
            idf = math.log(1 + (n_items - df[term] + 0.5) / (df[term] + 0.5))
            impact[term] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(found) / mean_words))
        own = sum(impact.values())
        spare = 0.0
        for term, value in sorted(impact.items(), key=lambda x: (x[1], x[0])):
            at = index.terms.setdefault(term, len(gathered))
            if at == len(gathered):
                gathered.append([])
            gathered[at].append((n, value / own))
            spare += value / own
            if spare >= 0.4 * threshold:
                kept_rare.add(at)
    rare = np.zeros(len(gathered), bool)
    rare[list(kept_rare)] = True
    for at, pairs in enumerate(gathered):
        ids, values = np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
        index.postings.append((array("q", ids.tolist()), array("d", values.tolist())))
        where, first = np.unique(ids // BLOCK, return_index=True)
        index.blocks.append((array("q", where.tolist()), array("d", np.maximum.reduceat(values, first).tolist())))
        index.best.append(float(values.max()))
        if not rare[at]:
            np.add.at(others, ids, values)
    index.rare = rare
    n_blocks = -(-len(split) // BLOCK)
    index.rest = np.array([others[b * BLOCK : (b + 1) * BLOCK].max() for b in range(n_blocks)])
    return index


def block_max_wand(index: Index, terms: list[int], threshold: float) -> list[tuple[int, float]]:
    """All (item, score) with score of ``threshold`` or more for a passage with these distinct terms.

    Cursors move over the postings in item order.  The pivot is the first item that the terms before it could lift to the threshold; the
    most impacts of the blocks around it may show that no item up to the next block's start can reach it, and then all jump there.
    """
    # a cursor: its item, the item's place, items, impacts, blocks, most impacts of the blocks, most impact of all
    cursors = [[index.postings[t][0][0], 0, *index.postings[t], *index.blocks[t], index.best[t]] for t in terms]
    by_item, enough, found = itemgetter(0), threshold - 1e-9, []
    while cursors:
        cursors.sort(key=by_item)
        bound, at = 0.0, -1
        for n, c in enumerate(cursors):
            bound += c[6]
            if bound >= enough:
                at = n
                break
        if at < 0:
            break
        pivot = cursors[at][0]
        while at + 1 < len(cursors) and cursors[at + 1][0] == pivot:
            at += 1
        ahead = cursors[: at + 1]
        block, in_block = pivot // BLOCK, 0.0
        for c in ahead:
            where = c[4]
            n = bisect_left(where, block)
            if n < len(where) and where[n] == block:
                in_block += c[5][n]
        if in_block < enough:
            target = (block + 1) * BLOCK
            if at + 1 < len(cursors):
                target = min(target, cursors[at + 1][0])
            target = max(target, pivot + 1)
        elif ahead[0][0] == pivot:
            score = sum(c[3][c[1]] for c in ahead)
            if score >= enough:
                found.append((pivot, score))
            target = pivot + 1
        else:
            target = pivot
        ended = False
        for c in ahead:
            if c[0] < target:
                n = c[1] = bisect_left(c[2], target, c[1])
                if n < len(c[2]):
                    c[0] = c[2][n]
                else:
                    ended = True
        if ended:
            cursors = [c for c in cursors if c[1] < len(c[2])]
    return found


def _could_match(index: Index, codes: np.ndarray, threshold: float, expand) -> np.ndarray:
    """Windows whose rare terms, by the most impact of each block, could reach the threshold in some block."""
    at = np.flatnonzero(codes >= 0)
    at = at[index.rare[codes[at]]]
    segment = at // index.window
    n_windows = int(len(codes) - 1) // index.window + 1
    n_terms = len(index.rare)
    # window w covers segments w and w + 1
    key = np.unique(np.concatenate([segment, np.maximum(segment - 1, 0)]) * n_terms + np.concatenate([codes[at], codes[at]]))
    starts, counts, where, most = expand
    window, term = key // n_terms, key % n_terms
    n = counts[term]
    flat = np.repeat(starts[term] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(int(n.sum()))
    n_blocks = len(index.rest)
    place, inverse = np.unique(np.repeat(window, n) * n_blocks + where[flat], return_inverse=True)
    total = np.bincount(inverse, most[flat], len(place)) + index.rest[place % n_blocks]
    hit = np.unique(place[total >= threshold - 1e-9] // n_blocks)
    return hit[hit < n_windows]


RESULT = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
_RESULT = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())])


def _query(shared, threshold: float, overlap: float, k: int):
    def run(batches) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        parts = [(runs_of(q, k), runs_of(a, k), min(k, len(q)), min(k, len(a))) for q, a in (question_and_answer(t) for _, t in index.items)]
        counts = np.array([len(w) for w, _ in index.blocks])
        expand = (np.cumsum(np.r_[0, counts[:-1]]), counts, np.concatenate([w for w, _ in index.blocks]), np.concatenate([m for _, m in index.blocks]))
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = words(text.as_py())
                codes = np.fromiter(map(index.terms.get, found, repeat(-1)), np.int64, len(found))
                if not (codes >= 0).any():
                    continue
                best: dict[int, tuple] = {}
                for w in _could_match(index, codes, threshold, expand).tolist():
                    passage = slice(w * index.window, (w + 2) * index.window)
                    terms = np.unique(codes[passage])
                    hits = block_max_wand(index, terms[terms >= 0].tolist(), threshold)
                    if not hits:
                        continue
                    runs = {n: runs_of(found[passage], n) for n in range(1, k + 1)}
                    for item, score in hits:
                        question, answer, kq, ka = parts[item]
                        in_q = len(question & runs[kq]) / len(question)
                        in_a = len(answer & runs[ka]) / len(answer) if answer else 1.0
                        if in_q >= overlap and in_a >= overlap:
                            item_id = index.items[item][0]
                            best[item_id] = max(best.get(item_id, (0.0,)), (score, in_q, in_a))
                rows += [(doc_id, item_id, *values) for item_id, values in best.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], f.type) for n, f in enumerate(_RESULT)], schema=_RESULT)

    return run


def _terms(batches):
    for batch in batches:
        found = [words(t.as_py()) for t in batch.column(0)]
        yield pa.RecordBatch.from_arrays([pa.array([len(f) for f in found], pa.int64()), pa.array([sorted(set(f)) for f in found], pa.list_(pa.string()))], names=["n", "terms"])


def find_leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    threshold: float = LEAST_SHARE, overlap: float = 0.8, k: int = 5, chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Pairs of a document and a test item that it contains: doc_id, item_id, score, question_overlap, answer_overlap.

    A document is read in passages of twice the longest item's words, each beginning one such length after the last, so every stretch as long as an item lies in one
    passage.  Each passage is a query: block-max WAND finds all items whose BM25 score reaches ``threshold`` of the item's score for
    itself.  Before that, a bound over whole blocks of items, summed for many passages at once, passes over those that cannot reach it; it
    drops no pair.  A pair stays if the passage has ``overlap`` of the ``k``-word runs of the item's question (all sentences but the
    last) and of its answer (the last sentence); shorter parts are one run.  Of several passages the best one counts.

    The index travels by broadcast in chunks of ``chunk_bytes`` item text, with one pass over the documents per chunk; statistics and the length of passages are of all
    items, so the result does not depend on the chunks.  The last sentence of an item counts as its answer: a passage with the question and a reworded answer is no leak.  Null or empty texts and items match nothing.  Rows that repeat a document's or an item's id count as one; null
    ids come back as null; empty tables give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    ids = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(NO_ID))
    known = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    source = docs.select(ids(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    tests = items.select(ids(item_col).alias("item_id"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text")).distinct()
    split = tests.select("text").mapInArrow(_terms, "n long, terms array<string>").filter("n > 0")
    n_items, n_words, window = split.agg(F.count("n"), F.sum("n"), F.max("n")).first()
    found = spark.createDataFrame([], RESULT)
    if not n_items:
        return found.select(known("doc_id"), known("item_id"), "score", "question_overlap", "answer_overlap")
    seen = split.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n_chunks = max(1, math.ceil(tests.agg(F.sum(F.octet_length("text"))).first()[0] / chunk_bytes))
    chunked = tests.withColumn("chunk", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_chunks)))
    for chunk in range(n_chunks):
        part = chunked.filter(F.col("chunk") == chunk).select("item_id", "text")
        own = part.select("text").mapInArrow(_terms, "n long, terms array<string>").select(F.explode("terms").alias("term")).distinct()
        df = {r[0]: r[1] for r in seen.join(own, "term").toLocalIterator()}
        index = build_index([tuple(r) for r in part.toLocalIterator()], df, n_items, n_words / n_items, window, threshold)
        if index.items:
            found = found.unionByName(source.mapInArrow(_query(spark.sparkContext.broadcast(index), threshold, overlap, k), RESULT))
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("score", "question_overlap", "answer_overlap")).alias("_b"))
    return best.select(known("doc_id"), known("item_id"), "_b.score", "_b.question_overlap", "_b.answer_overlap")


def drop_leaks(docs: DataFrame, leaks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the documents that contain a test item; all columns stay, whatever their names.

    Rows that repeat an id go or stay together, also those with a null id.  An empty table on either side leaves ``docs`` as it is.
    """
    bad = leaks.select(F.col("doc_id").alias("_b")).distinct()
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_a"))
    return row.join(bad, F.col(f"_a.`{id_col}`").eqNullSafe(F.col("_b")), "left_anti").select("_a.*")

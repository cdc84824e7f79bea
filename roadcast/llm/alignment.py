"""Which tokens of two tokenizers cover the same bytes: groups per text, links and their counts over all texts."""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadcast.llm.common import Steps

BROADCAST_PAIRS = 1 << 20  # id pairs with their counts are broadcast up to this many (24 MB); beyond, they are joined
HOT_SHARE = 1000  # a pair with more than one in so many of all rows is dealt to several tasks
COPIES = 64
_KNOWN = 500_000  # pieces of text remembered, with what both tokenizers make of them
_BATCH_CHARS = 1 << 20
_LEARN_CHARS = 1 << 17
_SHIFT = 32

# A piece is white space and what follows it.  No token of either tokenizer crosses its edge (see Aligner.cuts).
PIECES = re.compile(r"[ \n]*[^ \n]+|[ \n]+").findall
ODD_SPACE = re.compile(r"[^\S \n]").search
_BEFORE_SPACE = re.compile(r"[^▁\n ][▁\n ]")


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


def _stops(begin: np.ndarray, end: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Byte positions where tokens end.

    ``begin``, ``end``: bytes of the spans the tokenizer reports, coarse cuts: tokens inside one character share its span or have an empty one.
    A token whose span ends before the next one begins ends there; the others are placed by the bytes they decode to, counted from the cut before them.
    """
    cut = (end > begin) & (np.r_[begin[1:], end[-1:]] >= end)
    total = np.cumsum(sizes)
    shift = np.where(cut, end - total, 0)
    last = np.maximum.accumulate(np.where(cut, np.arange(len(end)), -1))
    before = np.r_[-1, last[:-1]]
    return np.where(cut, end, total + np.where(before >= 0, shift[before], 0))


@dataclass
class Aligned:
    """Tokens of both sides of one text: ids and end bytes, and where both end."""

    a: np.ndarray
    b: np.ndarray
    a_stops: np.ndarray
    b_stops: np.ndarray
    common: np.ndarray


class Aligner:
    """A byte-level tokenizer of the tokenizers library (A) and a sentencepiece model (B)."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core is all there is
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = _byte_letters()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (1 + max(vocabulary.values()))
        for token, n in vocabulary.items():
            self.a_bytes[n] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(n) for n in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(n) else p.replace("▁", " ").encode() for n, p in enumerate(pieces)]
        self.a_sizes = np.array([len(t) for t in self.a_bytes])
        self.b_sizes = np.array([len(t) for t in self.b_bytes])
        # byte-level tokenizers split words from the white space before them; B does so if none of its pieces has white space after anything else
        kind = json.loads(self.a.to_str())
        byte_level = not kind["normalizer"] and (kind["pre_tokenizer"] or {}).get("type") == "ByteLevel" and kind["pre_tokenizer"].get("use_regex")
        self.cuts = bool(byte_level) and not any(_BEFORE_SPACE.search(p) for p in pieces)
        tails = (",", "|"), (",", ";")
        self.a_text, self.b_text = ([[f"{n}{tail}" for n in range(len(t))] for tail in two] for t, two in zip((self.a_bytes, self.b_bytes), tails))

    def align(self, text: str) -> Aligned | None:
        """``text`` begins with the space that B adds.  None if the bytes of either side's tokens are not those of the text."""
        raw = text.encode()
        code_points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        at = np.r_[0, np.cumsum(1 + (code_points > 0x7F) + (code_points > 0x7FF) + (code_points > 0xFFFF))]
        encoded = self.a.encode(text, add_special_tokens=False)
        a = np.array(encoded.ids, np.int64)
        proto = np.array([(p.id, p.begin, p.end) for p in self.b.encode(text[1:], return_type="proto").pieces], np.int64).reshape(-1, 3)
        b = proto[:, 0]
        if not len(a) or not len(b):
            return None
        if b"".join(map(self.a_bytes.__getitem__, a.tolist())) != raw or b"".join(map(self.b_bytes.__getitem__, b.tolist())) != raw:
            return None
        spans = at[np.array(encoded.offsets, np.int64)]
        a_stops = _stops(spans[:, 0], spans[:, 1], self.a_sizes[a])
        b_stops = _stops(proto[:, 1] + 1, proto[:, 2] + 1, self.b_sizes[b])  # spans count bytes of the text without its space
        return Aligned(a, b, a_stops, b_stops, np.intersect1d(a_stops, b_stops, assume_unique=True))

    def listing(self, found: Aligned) -> list[str]:
        """Ids in order as text with what follows each: a comma, a bar after the A ids of a group, a semicolon after its B ids; and the groups' B tokens' places."""
        a_group, b_group = np.searchsorted(found.common, found.a_stops), np.searchsorted(found.common, found.b_stops)
        group = np.r_[a_group, b_group]
        order = np.argsort(2 * group + np.r_[np.zeros(len(a_group), int), np.ones(len(b_group), int)], kind="stable")
        a_last, b_last = np.r_[a_group[1:] != a_group[:-1], True], np.r_[b_group[1:] != b_group[:-1], True]
        tables = [*self.a_text, *self.b_text]
        which = np.r_[a_last.astype(int), 2 + b_last][order].tolist()
        return [tables[w][n] for w, n in zip(which, np.r_[found.a, found.b][order].tolist())]


class Pieces:
    """What both tokenizers make of each piece of text, computed for many new pieces at once and remembered."""

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.text: list[str | None] = []  # the groups, None where the piece cannot be aligned
        self.n_a, self.n_b, self.n_links, self.first = array("q"), array("q"), array("q"), array("q")
        self.links = array("q")

    def _add(self, new: list[str], texts: list[str | None], n_a: np.ndarray, n_b: np.ndarray, n_links: np.ndarray, links: np.ndarray) -> None:
        self.number.update(zip(new, range(len(self.text), len(self.text) + len(new))))
        self.text += texts
        first = len(self.links) + np.cumsum(n_links) - n_links
        for column, values in zip((self.n_a, self.n_b, self.n_links, self.first, self.links), (n_a, n_b, n_links, first, links)):
            column.frombytes(values.astype(np.int64).tobytes())

    def learn(self, new: list[str]) -> None:
        """Pieces with other characters than white space are put one after another into one text; they fall apart there as in their own texts."""
        inner = [p for p in new if p.strip(" \n")]
        while inner:
            size = n = 0
            while n < len(inner) and size < _LEARN_CHARS:
                size += len(inner[n])
                n += 1
            self._learn(inner[:n])
            inner = inner[n:]
        for piece in new:
            if not piece.strip(" \n"):
                self._learn([piece])

    def _learn(self, new: list[str]) -> None:
        head = " a"  # what the space that B adds belongs to
        found = self.aligner.align(head + "".join(new))
        if found is None:
            if len(new) == 1:
                self._add(new, [None], *[np.zeros(1)] * 3, np.zeros(0))
            for half in (new[: len(new) // 2], new[len(new) // 2 :]) if len(new) > 1 else ():
                self._learn(half)
            return
        self._split(new, found, len(head))

    def _split(self, new: list[str], found: Aligned, skip: int) -> None:
        edges = skip + np.r_[0, np.cumsum([len(p.encode()) for p in new])]
        if not np.isin(edges[1:], found.common).all():
            raise ValueError("a token reaches over white space")
        written = self.aligner.listing(found)
        a_to, b_to, to = (np.searchsorted(stops, edges, "right") for stops in (found.a_stops, found.b_stops, found.common))
        a_last = found.a[np.searchsorted(found.a_stops, found.common)]
        links = a_last << _SHIFT | found.b[np.searchsorted(found.b_stops, found.common)]
        at = (a_to + b_to).tolist()
        texts = ["".join(written[i:j])[:-1] for i, j in zip(at, at[1:])]
        self._add(new, texts, np.diff(a_to), np.diff(b_to), np.diff(to), links[to[0] :])


def _sections(text: str) -> Iterator[str]:
    """A long text in parts that end before white space."""
    at = 0
    while len(text) - at > _BATCH_CHARS:
        stop = at + _BATCH_CHARS
        cut = max(text.rfind(" ", at + 1, stop), text.rfind("\n", at + 1, stop))
        while cut > at and text[cut - 1] in " \n":
            cut -= 1
        if cut <= at:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


ROWS = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"
_ROWS = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")], ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))]
)
_NOTHING = (0, 0, 0, 0, "", [], [])


class _Document:
    def __init__(self) -> None:
        self.digest, self.first, self.n_a, self.n_b, self.links = hashlib.sha256(), True, 0, 0, []

    def add(self, text: str, n_a: int, n_b: int, links: np.ndarray) -> None:
        self.digest.update(text.encode() if self.first else b";" + text.encode())
        self.first, self.n_a, self.n_b = False, self.n_a + n_a, self.n_b + n_b
        values, times = np.unique(links, return_counts=True)
        self.links.append((values, times))

    def row(self) -> tuple:
        values, times = (np.concatenate(part) for part in zip(*self.links))
        if len(self.links) > 1:
            values, which = np.unique(values, return_inverse=True)
            times = np.bincount(which, weights=times).astype(np.int64)
        n = int(times.sum())
        return self.n_a, self.n_b, n, n, self.digest.hexdigest(), values.tolist(), times.tolist()


def _in_one(text: str, aligner: Aligner) -> tuple:
    """A text that is not cut into pieces."""
    found = aligner.align(text)
    if found is None:
        return _NOTHING
    links = found.a[np.searchsorted(found.a_stops, found.common)] << _SHIFT | found.b[np.searchsorted(found.b_stops, found.common)]
    out = _Document()
    out.add("".join(aligner.listing(found))[:-1], len(found.a), len(found.b), links)
    return out.row()


def _row(parts: list[list[str]], pieces: Pieces) -> tuple:
    out = _Document()
    first, many, links = (np.frombuffer(c, np.int64) for c in (pieces.first, pieces.n_links, pieces.links))
    n_a, n_b = np.frombuffer(pieces.n_a, np.int64), np.frombuffer(pieces.n_b, np.int64)
    for part in parts:
        numbers = list(map(pieces.number.__getitem__, part))
        texts = list(map(pieces.text.__getitem__, numbers))
        if None in texts:
            return _NOTHING
        at = np.array(numbers)
        n = many[at]
        where = np.repeat(first[at] - np.cumsum(n) + n, n) + np.arange(n.sum())
        out.add(";".join(texts), int(n_a[at].sum()), int(n_b[at].sum()), links[where])
    return out.row()


@lru_cache(1)
def _pieces(a_path: str, b_path: str) -> Pieces:
    """One memory per worker: tasks that follow each other in a worker go on with it."""
    return Pieces(Aligner(a_path, b_path))


def _align(a_path: str, b_path: str):
    def run(batches) -> Iterator[pa.RecordBatch]:
        pieces, made = _pieces(a_path, b_path), TaskContext.get().partitionId() << 40
        aligner = pieces.aligner

        def rows(texts):
            """Few enough texts at once that their pieces fit; a longer text alone, section by section."""
            cut = [list(map(PIECES, _sections(" " + t))) if t and aligner.cuts and not ODD_SPACE(t) else None for t in texts]
            if len(pieces.text) > _KNOWN:
                pieces.clear()
            new: set[str] = set()
            for parts in cut:
                for part in parts or ():
                    new.update(set(part).difference(pieces.number))
            pieces.learn(list(new))
            return [_row(parts, pieces) if parts else _in_one(" " + t, aligner) if t else _NOTHING for t, parts in zip(texts, cut)]

        for batch in batches:
            out, held, size = [], [], 0
            for text in batch.column(1):
                held.append(text.as_py())
                size += len(held[-1] or "")
                if size > _BATCH_CHARS:
                    out += rows(held)
                    held, size = [], 0
            out += rows(held)
            numbers = np.arange(made, made + batch.num_rows)
            made += batch.num_rows
            columns = [pa.array(c, f.type) for c, f in zip(zip(*out) if out else [()] * 7, list(_ROWS)[2:])]
            yield pa.RecordBatch.from_arrays([pa.array(numbers), batch.column(0), *columns], schema=_ROWS)

    return run


def pair_counts(links: DataFrame, steps: Steps) -> tuple[DataFrame, int, int]:
    """(pair, n, best): how many links hold each pair of ids, and whether no pair with its B id has more; their number and that of all links."""
    counts, sums = steps.write_and_sum(links.groupBy("pair").agg(F.sum("times").alias("n")), pairs=F.lit(1), total=F.col("n"))
    b_id = F.col("pair").bitwiseAND(F.lit((1 << _SHIFT) - 1))
    most = counts.groupBy(b_id.alias("b")).agg(F.max("n").alias("most"))
    return steps.write(counts.join(most, b_id == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))), sums["pairs"], sums["total"]


def _with_counts(links: DataFrame, counts: DataFrame, n_pairs: int, total: int, limit: int) -> DataFrame:
    if n_pairs <= limit:
        return links.join(F.broadcast(counts), "pair")
    # at most HOT_SHARE pairs are hot
    hot = F.broadcast(counts.filter(F.col("n") > total / HOT_SHARE).select(F.col("pair").alias("_hot")))
    copies = counts.join(hot, F.col("pair") == F.col("_hot"), "left").select(
        "pair", "n", "best", F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("_hot").isNull(), 0).otherwise(COPIES - 1).cast("long"))).alias("_copy")
    )
    dealt = links.join(hot, F.col("pair") == F.col("_hot"), "left").withColumn("_copy", F.when(F.col("_hot").isNull(), 0).otherwise(F.pmod(F.xxhash64("row"), F.lit(COPIES))))
    return dealt.drop("_hot").join(copies, ["pair", "_copy"]).drop("_copy")


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Both tokenizers read a space and the whole text.  Bytes where tokens of both end cut the tokens into groups; a link joins the two that end there.  The
    libraries' spans are coarse cuts, and tokens inside a character are placed by the bytes they decode to (:func:`_stops`).  Texts are cut before white space, where both
    tokenizers cut them too, and each worker asks the libraries once for each piece it remembers; a text with other white space than
    blanks and line ends goes to them whole.  A pair of ids counts how many links hold it in all documents.

    Null and empty texts, and those whose tokens do not give their bytes back, have no tokens: zeros and an empty digest.  Strings of special tokens
    are plain text.  Repeated rows count each.  A null id comes back as null.  An empty table gives no rows; other columns are not read.
    """
    steps = Steps(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = steps.write(source.mapInArrow(_align(a_path, b_path), ROWS))
    links = rows.select("row", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), "times")))
    counts, n_pairs, total = pair_counts(links.select("pair", "times"), steps)
    weighed = _with_counts(links, counts, n_pairs, total, broadcast_pairs).groupBy("row")
    weighed = weighed.agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    return rows.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(weighed, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256"
    )

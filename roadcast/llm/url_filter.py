"""URL rules in a sorted array of 64-bit digests: memory-mapped, probed by binary search, confirmed by the stored strings."""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadcast.session import shared_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEGMENT_BYTES = 64 << 20


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` with A-Z lower-cased, and the path up to ``?``, ``#`` or the end; empty without ``://``."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


@dataclass(frozen=True)
class UrlIndex:
    """Names of the files with the rules, and the (labels of the host, characters of the path) that rules have."""

    files: tuple[str, ...]
    shapes: tuple[tuple[int, int], ...]


def build_index(rules: DataFrame) -> UrlIndex:
    """Files of the rules (host, path, verdict): count, digests in ascending order, ends of the strings, strings.

    Rules are spread by digest over segments of about SEGMENT_BYTES, and one segment at a time passes through the
    driver, so any number of rules can be used.  The files reach each executor, also those that start later, by addFile.
    Of rules with equal host and path the one that blocks counts.
    """
    spark = rules.sparkSession
    host = F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER)
    rules = rules.select(host.alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    text = F.concat("host", "path")
    total = rules.agg(F.sum(F.octet_length(text) + 24)).first()[0] or 0
    n_segments = max(1, -(-total // SEGMENT_BYTES))
    shape = rules.select(F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("chars")).distinct()
    shapes = tuple(sorted((r[0], r[1]) for r in shape.collect()))
    keyed = rules.select(text.alias("text"), F.length("host").alias("cut"), "verdict", F.pmod(F.xxhash64(text), F.lit(n_segments)).alias("segment"))
    files = []
    hadoop = spark._jvm.org.apache.hadoop.fs
    for segment in range(n_segments):
        rows = [(xxhash.xxh64_intdigest(r[0].encode()), r[0].encode() + (b"\x01" if r[2] == "block" else b"\x00")) for r in keyed.filter(F.col("segment") == segment).collect()]
        rows.sort()
        ends = np.cumsum([len(s) for _, s in rows], dtype="<u8")
        blob = struct.pack("<Q", len(rows)) + np.array([d for d, _ in rows], "<u8").tobytes() + ends.astype("<u8").tobytes() + b"".join(s for _, s in rows)
        name = f"rules-{uuid.uuid4().hex}"
        where = hadoop.Path(f"{shared_folder(spark)}/{name}")
        out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where)
        for at in range(0, len(blob), 1 << 20):
            out.write(bytearray(blob[at : at + (1 << 20)]))
        out.close()
        spark.sparkContext.addFile(str(where.toString()))
        files.append(name)
    return UrlIndex(tuple(files), shapes)


class Segment:
    def __init__(self, path: str):
        data = np.memmap(path, np.uint8, "r")
        n = int(data[:8].view("<u8")[0])
        self.digests = data[8 : 8 + 8 * n].view("<u8")
        self.ends = data[8 + 8 * n : 8 + 16 * n].view("<u8")
        self.strings = data[8 + 16 * n :]

    def probe(self, digests: np.ndarray, keys: list[bytes]) -> dict[int, bool]:
        """Which keys are rules, and whether they block: binary search for all at once, then the stored strings decide."""
        found: dict[int, bool] = {}
        if not len(self.digests):
            return found
        at = np.searchsorted(self.digests, digests)
        inside = np.minimum(at, len(self.digests) - 1)
        for n in np.flatnonzero(self.digests[inside] == digests):
            entry = int(at[n])
            while entry < len(self.digests) and self.digests[entry] == digests[n]:
                start = int(self.ends[entry - 1]) if entry else 0
                stored = self.strings[start : int(self.ends[entry])].tobytes()
                if stored[:-1] == keys[n]:
                    found[int(n)] = stored[-1:] == b"\x01"
                    break
                entry += 1
        return found


def candidates(host: str, path: str, shapes) -> Iterator[str]:
    """Host suffix and path prefix of each shape that a rule could have."""
    labels = host.split(".")
    for n, chars in shapes:
        if n <= len(labels) and chars <= len(path):
            yield ".".join(labels[len(labels) - n :]) + path[:chars]


OUT = "host string, path string, rule string, verdict string"


def judge_urls(pages: DataFrame, index: UrlIndex, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: id, host, path, rule, verdict.

    A rule fits its host and all subdomains if the path starts with the rule's; of the rules that fit the longest
    wins; none gives ``default``.  Null urls and urls without ``://`` have an empty host and path.  Repeated rows each get their
    result; an empty table gives none; other columns are not read.
    """
    host, path = host_and_path(F.col(url_col))
    parts = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    kind = parts.schema[0].dataType.simpleString()
    name = parts.columns[0]

    def run(batches):
        segments = [Segment(SparkFiles.get(f)) for f in index.files]
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            owners, keys = [], []
            for row, (h, p) in enumerate(zip(hosts, paths)):
                for key in candidates(h, p, index.shapes):
                    owners.append(row)
                    keys.append(key)
            raw = [k.encode() for k in keys]
            digests = np.fromiter(map(xxhash.xxh64_intdigest, raw), np.uint64, len(raw))
            best: list[tuple[int, str, bool] | None] = [None] * len(hosts)
            for segment in segments:
                for n, blocks in segment.probe(digests, raw).items():
                    row = owners[n]
                    if best[row] is None or len(keys[n]) > best[row][0]:
                        best[row] = (len(keys[n]), keys[n], blocks)
            rule = [b and b[1] for b in best]
            verdict = [("block" if b[2] else "allow") if b else default for b in best]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names=[name, "host", "path", "rule", "verdict"])

    return parts.mapInArrow(run, f"`{name}` {kind}, {OUT}")

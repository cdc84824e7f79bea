"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked through BK-trees of bounded shards."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadcast.llm.common import Steps
from roadcast.llm.near import components

SHARD = 1024  # nodes of a tree, and queries sent to it at once
_VISITS = 1 << 20  # pairs of query and node at hand in a search
_SLICE = 1 << 16  # shingles hashed at once


def fingerprint(text: bytes, k: int = 4, seed: int = 42) -> int:
    """64 bits; bit i is set when bit i is set in over half of the hashes of the ``k``-word shingles, repeats included.

    A-Z are lower-cased and words are runs of bytes other than ASCII white space.  Fewer than ``k`` words are one shingle; no words give 0.
    """
    found = text.lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    stops = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.r_[0, stops[:-1] + 1]
    n = max(1, len(found) - k + 1)
    starts, stops = starts[:n].tolist(), stops[min(k, len(found)) - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _SLICE):
        codes = np.array([digest(joined[a:b], seed) for a, b in zip(starts[at : at + _SLICE], stops[at : at + _SLICE])], "<u8")
        ones += np.unpackbits(codes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


_MARKED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("code", pa.int64())])


def _mark(k: int):
    def run(batches) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 40
        for batch in batches:
            codes = np.array([fingerprint(t.as_py(), k) for t in batch.column(1)], np.uint64).view(np.int64)
            rows = np.arange(made, made + batch.num_rows)
            made += batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(rows), batch.column(0), pa.array(codes)], schema=_MARKED)

    return run


# --- which fingerprints can be close ----------------------------------------------------------------------------------


def masks(radius: int, n_codes: int, bucket: int = 4 * SHARD) -> list[int]:
    """Bit masks such that any two codes within ``radius`` agree on all bits of one of them at least.

    64 bits are cut into p blocks; ``radius`` differing bits touch ``radius`` blocks at most, so p - ``radius`` blocks agree.  p is the least one
    for which ``n_codes`` evenly spread codes put at most ``bucket`` into one value of a mask; any p finds all links.
    """
    if radius == 0:
        return []
    for p in range(radius + 1, 2 * radius + 3):
        kept = p - radius
        if n_codes / 2.0 ** (64 * kept // p) <= bucket:
            break
    edges = [64 * i // p for i in range(p + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(blocks, kept)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


# --- trees ------------------------------------------------------------------------------------------------------------


def _bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


def grow(codes: np.ndarray, tree: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parent, edge) of every code; rows of one ``tree`` follow each other, its first row is the root (parent -1) and codes differ.

    All trees grow together, one level a step: codes at a node go to its child whose edge is their Hamming distance to the node, and the first one becomes
    that child where there is none.  The result is that of inserting the codes one by one.
    """
    n = len(codes)
    parent, edge = np.full(n, -1), np.zeros(n, np.int64)
    first = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]]) if n else np.zeros(0, int)
    at = np.repeat(first, np.diff(np.r_[first, n]))
    left = np.setdiff1d(np.arange(n), first, assume_unique=True)
    while len(left):
        key = at[left] * 65 + _bits(codes[left], codes[at[left]])
        order = np.argsort(key, kind="stable")
        opens = np.r_[True, key[order][1:] != key[order][:-1]]
        heads = left[order[opens]]
        child = np.empty(len(left), np.int64)
        child[order] = np.repeat(heads, np.diff(np.r_[np.flatnonzero(opens), len(left)]))
        parent[heads], edge[heads] = at[heads], key[order[opens]] % 65
        at[left] = child
        left = left[child != left]
    return parent, edge


def search(codes: np.ndarray, parent: np.ndarray, edge: np.ndarray, asked: np.ndarray, roots: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) numbers of all hits; query i starts at node ``roots[i]`` and follows edges within ``radius`` of its distance to a node."""
    nodes = np.flatnonzero(parent >= 0)
    keys = parent[nodes] * 65 + edge[nodes]
    order = np.argsort(keys, kind="stable")
    keys, nodes = keys[order], nodes[order]
    query, node = np.arange(len(asked)), roots
    hits: list[tuple[np.ndarray, np.ndarray]] = []
    while len(query):
        apart = _bits(asked[query], codes[node])
        close = apart <= radius
        hits.append((query[close], node[close]))
        low = np.searchsorted(keys, node * 65 + np.maximum(apart - radius, 1))
        n = np.searchsorted(keys, node * 65 + np.minimum(apart + radius, 64), "right") - low
        n = np.maximum(n, 0)
        query = np.repeat(query, n)
        node = nodes[np.repeat(low - np.cumsum(n) + n, n) + np.arange(len(query))]
    return np.concatenate([q for q, _ in hits] or [query]), np.concatenate([v for _, v in hits] or [node])


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows in tables that end where a group ends; rows come sorted by ``keys``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        last = np.ones(table.num_rows, bool)
        for key in keys:
            column = table[key].to_numpy()
            last &= column == column[-1]
        cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for key in keys:
        column = table[key].to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return new


_TREE_KEYS = ["mask", "key", "shard"]
TREES = "mask int, key long, shard int, parts int, no int, parent int, edge int, code long, comp long"


def _grow_shards(batches):
    for table in _groups(batches, _TREE_KEYS):
        new = _starts(table, _TREE_KEYS)
        first = np.flatnonzero(new)
        base = np.repeat(first, np.diff(np.r_[first, len(new)]))
        parent, edge = grow(table["code"].to_numpy().view(np.uint64), np.cumsum(new))
        local = [np.arange(len(new)) - base, np.where(parent < 0, -1, parent - base), edge]
        columns = [table[c] for c in (*_TREE_KEYS, "parts")] + [pa.array(c.astype(np.int32)) for c in local] + [table["code"], table["comp"]]
        yield from pa.table(columns, names=[f.split()[0] for f in TREES.split(", ")]).combine_chunks().to_batches()


_JOB_KEYS = ["mask", "key", "shard", "part"]


def _search_shards(radius: int):
    """Nodes (no >= 0) and queries (no = -1) of a shard and a part come together, nodes first."""

    def run(batches):
        for table in _groups(batches, _JOB_KEYS):
            job = np.cumsum(_starts(table, _JOB_KEYS)) - 1
            no, code, comp = (table[c].to_numpy() for c in ("no", "code", "comp"))
            is_node = no >= 0
            nodes, asked = np.flatnonzero(is_node), np.flatnonzero(~is_node)
            n_nodes = np.bincount(job[nodes], minlength=job[-1] + 1)
            root = np.cumsum(n_nodes) - n_nodes
            parent = table["parent"].to_numpy()[nodes].astype(np.int64)
            parent = np.where(parent < 0, -1, parent + root[job[nodes]])
            edge = table["edge"].to_numpy()[nodes].astype(np.int64)
            node_code, node_comp = code[nodes].view(np.uint64), comp[nodes]
            asked = asked[n_nodes[job[asked]] > 0]
            slices = np.cumsum(n_nodes[job[asked]]) // _VISITS
            for cut in np.split(asked, np.flatnonzero(np.diff(slices)) + 1):
                query, node = search(node_code, parent, edge, code[cut].view(np.uint64), root[job[cut]], radius)
                pairs = np.column_stack([comp[cut][query], node_comp[node]])
                pairs = np.unique(np.sort(pairs[pairs[:, 0] != pairs[:, 1]], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    return run


# --- components of close fingerprints ---------------------------------------------------------------------------------


def _apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _pivot_links(members: DataFrame, heads: DataFrame, radius: int) -> DataFrame:
    """Links of each bucket's members to its pivot."""
    met = members.join(heads.select("mask", "key", "pivot"), ["mask", "key"])
    return met.filter((F.col("code") != F.col("pivot")) & (_apart("code", "pivot") <= radius)).select(F.col("code").alias("a"), F.col("pivot").alias("b")).distinct()


def close_groups(units: DataFrame, n_codes: int, radius: int, steps: Steps, shard: int = SHARD) -> DataFrame:
    """(uid, comp) of the codes of ``units`` (code, n) that have another one within ``radius`` bits; comp is the least code of the component.

    Codes meet in buckets of the values of :func:`masks`.  First the most frequent code of each bucket is compared with its members, which joins most
    of a large group of near copies.  Buckets whose members are all in one component are done.  In each other bucket the members outside its
    largest component ask the bucket's BK-trees; any pair of different components has such a member.  Trees have ``shard`` nodes and
    queries go in parts of ``shard``: a tree is sent to every part of its bucket's queries, so no task holds a bucket.  Of the hits only pairs of components
    leave a task.  All members of a bucket are nodes, nothing is capped.
    """
    chosen = masks(radius, n_codes)
    if not chosen:
        return units.sparkSession.createDataFrame([], "uid long, comp long")
    cuts = F.array(*[F.struct(F.lit(i).alias("mask"), F.col("code").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(chosen)])
    members = units.select("code", "n", F.inline(cuts))
    heads = members.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("size"), F.max(F.struct("n", "code"))["code"].alias("pivot")).filter("size > 1")
    heads = steps.write(heads)
    links = steps.write(_pivot_links(members, heads, radius))
    groups = steps.write(components(links, steps))
    labels = units.select("code").join(groups.withColumnRenamed("uid", "code"), "code", "left").select("code", F.coalesce("comp", "code").alias("comp"))
    labelled = steps.write(labels.select("code", "comp", F.inline(cuts)).join(heads.select("mask", "key", "size"), ["mask", "key"]))
    per_comp = labelled.groupBy("mask", "key", "comp").agg(F.count(F.lit(1)).alias("n"))
    buckets = per_comp.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("comps"), F.sum("n").alias("size"), F.max(F.struct("n", "comp")).alias("top")).filter("comps > 1")
    pieces = lambda n: F.ceil(n / F.lit(shard)).cast("int")
    buckets = buckets.select("mask", "key", F.col("top.comp").alias("top"), pieces(F.col("size")).alias("shards"), pieces(F.col("size") - F.col("top.n")).alias("parts"))
    open_rows = steps.write(labelled.select("mask", "key", "code", "comp").join(buckets, ["mask", "key"]))
    code = F.xxhash64("code")
    nodes = open_rows.select("mask", "key", F.pmod(code, "shards").cast("int").alias("shard"), "parts", "code", "comp")
    nodes = nodes.repartition(*_TREE_KEYS).sortWithinPartitions(*_TREE_KEYS, "code")
    trees = steps.write(nodes.mapInArrow(_grow_shards, TREES))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    sent = trees.select("mask", "key", "shard", each("parts").alias("part"), "no", "parent", "edge", "code", "comp")
    asked = open_rows.filter(F.col("comp") != F.col("top")).select("mask", "key", "code", "comp", "shards", F.pmod(code, "parts").cast("int").alias("part"))
    asked = asked.select("mask", "key", each("shards").alias("shard"), "part", *[F.lit(-1).alias(c) for c in ("no", "parent", "edge")], "code", "comp")
    jobs = sent.unionByName(asked).repartition(*_JOB_KEYS).sortWithinPartitions(*_JOB_KEYS, F.col("no") < 0, "no", "code")
    found = steps.write(jobs.mapInArrow(_search_shards(radius), "a long, b long"))
    steps.drop(labelled, open_rows, trees)
    known = groups.select(F.col("uid").alias("a"), F.col("comp").alias("b"))
    return components(known.unionByName(found), steps)


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, radius: int = 4, shard: int = SHARD) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id, component_size.

    Fingerprints (:func:`fingerprint`) link at ``radius`` or fewer differing bits; component_id is the smallest id reachable over links.  Null and empty texts
    and those without words have fingerprint zero and link like any other.  Equal fingerprints are one unit.  Repeated rows have a row
    each.  A null id comes back as null and is a component's id only where the component has no other.  Texts are read whole, other columns are not read.
    An empty table gives no rows.
    """
    steps = Steps(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    rows = steps.write(source.mapInArrow(_mark(k), "row long, doc_id long, code long"))
    units, sums = steps.write_and_sum(rows.groupBy("code").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), n_codes=F.lit(1))
    groups = close_groups(units, sums["n_codes"], radius, steps, shard)
    joined = units.join(groups.withColumnRenamed("uid", "code"), "code", "left").select("code", "least", "n", F.coalesce("comp", "code").alias("comp"))
    joined = steps.write(joined)
    whole = joined.groupBy("comp").agg(F.min("least").alias("component_id"), F.sum("n").alias("component_size"))
    named = joined.select("code", "comp").join(whole, "comp").select("code", "component_id", "component_size")
    return rows.join(named, "code").select("doc_id", F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"), "component_id", "component_size")

"""Merkle manifest of a table: a tree per group under one root, proofs by pointer jumping, and their check."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadcast.llm.common import Steps, positions

ARITY = 8
BROADCAST_BYTES = 256 << 10  # ancestors are broadcast up to this many bytes, counted while they are written
MOST_COPIES = 64
TOP = -1  # number of the tree over the groups' roots
_TOP_FLAG = 128


def field(column: Column) -> Column:
    """``-`` for null, else the value's number of UTF-8 bytes, a colon and the value."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 of the fields, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]), 256))


def _height(n: int, arity: int) -> int:
    levels = 0
    while n > 1:
        n, levels = -(-n // arity), levels + 1
    return levels


@dataclass
class Manifest:
    """``leaves``: payload, digest and place of each row.  ``inner``: every other node below the root with the segment to its parent."""

    leaves: DataFrame
    inner: DataFrame
    root: str | None
    depth: int
    inner_bytes: int
    arity: int
    steps: Steps


def _byte(value: Column) -> Column:
    return F.unhex(F.lpad(F.hex(value.cast("long")), 2, "0"))


def _children(runs: DataFrame, top: bool, arity: int) -> DataFrame:
    """A row for each member of each run: its place, its parent and the segment that leads there.

    A segment is a byte with the member's place in the run (plus 128 in the tree over the groups), a byte with the size of the run, and
    the digests of the other members from left to right.
    """
    child = runs.select("*", F.posexplode("members").alias("_i", "_m"))
    before = F.substring("run", F.lit(1), F.col("_i") * 32)
    after = F.substring("run", F.col("_i") * 32 + 33, F.octet_length("run"))
    segment = F.concat(_byte(F.col("_i") + (_TOP_FLAG if top else 0)), _byte(F.size("members")), before, after)
    up_is_root = F.col("n") == 1
    to_top = F.lit(False) if top else up_is_root
    return child.select(
        "tree", (F.col("level") - 1).alias("level"), (F.col("pos") * arity + F.col("_i")).alias("pos"), F.col("_m.payload").alias("payload"), F.col("_m.digest").alias("digest"),
        F.when(to_top, F.lit(TOP)).otherwise(F.col("tree")).cast("long").alias("up_tree"), F.when(to_top, F.lit(0)).otherwise(F.col("level")).cast("int").alias("up_level"),
        F.when(to_top, F.col("tree")).otherwise(F.col("pos")).alias("up_pos"), segment.alias("segment"),
    )


def _climb(nodes: DataFrame, height: int, arity: int, steps: Steps) -> list[DataFrame]:
    """Runs of ``arity`` neighbours, level by level, until every tree has one node.

    ``nodes``: tree, pos, n (nodes of the tree on this level), digest, payload.  A run has ``arity`` rows at most, so no list grows with the table.
    """
    levels = []
    for level in range(1, height + 1):
        runs = nodes.filter("n > 1").groupBy("tree", F.floor(F.col("pos") / arity).alias("up"))
        runs = runs.agg(F.max(F.ceil(F.col("n") / arity)).alias("n"), F.sort_array(F.collect_list(F.struct("pos", "digest", "payload"))).alias("members"))
        joined = F.array_join(F.transform("members", lambda m: F.hex(m["digest"])), "")
        runs = runs.select("tree", F.lit(level).alias("level"), F.col("up").alias("pos"), "n", "members", F.unhex(joined).alias("run"))
        runs = steps.write(runs.withColumn("digest", F.unhex(F.sha2(F.lower(F.hex("run")).cast("binary"), 256))))
        levels.append(runs)
        nodes = runs.select("tree", "pos", "n", "digest", F.lit(None).cast("struct<doc_id:bigint,altered:binary>").alias("payload"))
    return levels


def build_manifest(rows: DataFrame, arity: int = ARITY) -> Manifest:
    """Tree over ``rows`` (group, doc_id, digest, altered): one tree per group, leaves by doc_id, and a tree over the groups' roots.

    A null group is a group and comes first, groups follow each other by their UTF-8 bytes.  Null ids come first in their group; rows of one
    id by digest, so that repeated rows give the same root in any order.  ``altered`` is a second digest that :func:`proofs` folds instead of the first one,
    null for none.  The last run of a level may be short, also one node.  An empty table has no root.

    Groups of any size are numbered through range partitions; a level is one aggregate whose groups have ``arity`` rows.
    """
    steps = Steps(rows.sparkSession)
    kept = steps.write(rows.select("group", "doc_id", "digest", "altered"))
    placed = steps.write(positions(kept, ["group", "doc_id", "digest"], steps, "_at"))
    groups = placed.groupBy("group").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("n"))
    groups = steps.write(positions(groups, ["group"], steps, "tree"))
    facts = groups.agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("groups")).first()
    named = groups.select(F.col("group").alias("_g"), "_first", "n", "tree")
    payload = F.struct("doc_id", "altered").alias("payload")
    leaves = placed.join(named, F.col("group").eqNullSafe(F.col("_g"))).select("tree", (F.col("_at") - F.col("_first")).alias("pos"), "n", "digest", payload)
    leaves = steps.write(leaves)
    levels = _climb(leaves, _height(facts["most"] or 0, arity), arity, steps)
    lone = leaves.filter("n = 1").select("tree", "digest")
    tops = lone
    for runs in levels:
        tops = tops.unionByName(runs.filter("n = 1").select("tree", "digest"))
    nothing = F.lit(None).cast("struct<doc_id:bigint,altered:binary>").alias("payload")
    top_nodes = tops.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(facts["groups"]).alias("n"), "digest", nothing)
    top_height = _height(facts["groups"], arity)
    top_levels = _climb(top_nodes, top_height, arity, steps)
    last = top_levels[-1] if top_levels else top_nodes
    root = last.filter("n = 1").select(F.lower(F.hex("digest"))).first() if facts["groups"] else None
    # leaves of groups of one row are already nodes of the upper tree: their segment is empty
    whole = leaves.filter("n = 1").select(
        "payload", "digest", F.lit(TOP).cast("long").alias("up_tree"), F.lit(0).alias("up_level"), F.col("tree").alias("up_pos"), F.lit(b"").alias("segment")
    )
    low = _children(levels[0], False, arity).drop("tree", "level", "pos").unionByName(whole) if levels else whole
    parts = [_children(runs, False, arity) for runs in levels[1:]] + [_children(runs, True, arity) for runs in top_levels]
    inner = None
    for part in parts:
        part = part.drop("payload", "digest")
        inner = part if inner is None else inner.unionByName(part)
    if inner is None:
        inner = _children(steps.write(_no_runs(rows)), True, arity).drop("payload", "digest")
    inner, sums = steps.write_and_sum(inner, size=F.octet_length("segment") + 64)
    return Manifest(low, inner, root[0] if root else None, len(levels) + top_height, sums["size"], arity, steps)


def _no_runs(rows: DataFrame) -> DataFrame:
    kinds = "tree long, level int, pos long, n long, members array<struct<pos:long,digest:binary,payload:struct<doc_id:bigint,altered:binary>>>, run binary, digest binary"
    return rows.sparkSession.createDataFrame([], kinds)


def _far(reach: int) -> Column:
    """Nodes that are ``reach`` levels above a leaf, and those of the upper tree."""
    return (F.col("tree") == TOP) | (F.col("level") >= reach)


def _jump(nodes: DataFrame, far: DataFrame, root: tuple[int, int], copies: int, small: bool) -> DataFrame:
    """Move each pointer of ``nodes`` on by the pointer of the node it leads to, and append that node's segment.

    Pointers that have reached the root get a key that nothing matches, a different one each, so they gather nowhere.  ``far`` is copied
    ``copies`` times, and the nodes below one ancestor are dealt to the copies.
    """
    keys = ["up_tree", "up_level", "up_pos"]
    done = (F.col("up_tree") == TOP) & (F.col("up_level") == root[0]) & (F.col("up_pos") == root[1])
    spread = F.xxhash64(F.col("segment"))
    near = nodes.withColumns({"_t": F.when(done, F.lit(TOP - 1)).otherwise(F.col("up_tree")), "_p": F.when(done, spread).otherwise(F.col("up_pos")), "_c": F.pmod(spread, F.lit(copies))})
    side = far.select(
        F.col("tree").alias("_t"), F.col("level").alias("_l"), F.col("pos").alias("_p"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))).alias("_c"),
        *[F.col(k).alias(f"_{k}") for k in keys], F.col("segment").alias("_segment"),
    )
    side = F.broadcast(side) if small else side
    joined = near.withColumn("_l", F.col("up_level")).join(side, ["_t", "_l", "_p", "_c"], "left")
    moved = {k: F.coalesce(f"_{k}", k) for k in keys} | {"segment": F.concat("segment", F.coalesce("_segment", F.lit(b"")))}
    return joined.withColumns(moved).select(*nodes.columns)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fold(digest: bytes, path: bytes) -> tuple[str, str]:
    """(root of the group, root) that a leaf's digest and its path give, in hex."""
    now, at, group_root = digest.hex(), 0, None
    while at < len(path):
        place, n = path[at], path[at + 1]
        if place >= _TOP_FLAG and group_root is None:
            group_root = now
        place %= _TOP_FLAG
        others = path[at + 2 : at + 2 + 32 * (n - 1)].hex()
        now = _sha(others[: 64 * place] + now + others[64 * place :])
        at += 2 + 32 * (n - 1)
    return group_root or now, now


def siblings(path: bytes) -> str:
    """The digests on a path in hex, level by level, left to right."""
    out, at = [], 0
    while at < len(path):
        n = path[at + 1]
        out.append(path[at + 2 : at + 2 + 32 * (n - 1)].hex())
        at += 2 + 32 * (n - 1)
    return "".join(out)


_PROOFS = pa.schema([("doc_id", pa.int64()), *[(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")], ("verified", pa.bool_()), ("path", pa.binary())])
PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, path binary"


def _fold_rows(root: str):
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in _PROOFS]
            for doc_id, digest, altered, path in zip(*[c.to_pylist() for c in batch.columns]):
                subroot, top = fold(digest, path)
                if top != root:
                    raise ValueError(f"the path of document {doc_id} does not lead to the root of its manifest")
                folded = fold(altered, path)[1] if altered is not None else top
                for col, value in zip(cols, (doc_id, digest.hex(), subroot, root, _sha(siblings(path)), folded, folded == root, path)):
                    col.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _PROOFS)], schema=_PROOFS)

    return run


def proofs(manifest: Manifest) -> DataFrame:
    """One row per leaf: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, and the path itself.

    Every node holds the segment of sibling digests towards an ancestor, at first its parent.  A round joins the nodes with themselves: each
    takes over its ancestor's ancestor and appends that segment, so the distance doubles, and after log2(depth) rounds all leaves hold their
    whole path.  In round r (from 0) only nodes 2^r levels up are looked up, so that side shrinks by a power of the arity each round.

    ``folded_root`` is what the altered digest (the leaf's own where there is none) gives with the path; ``verified`` whether it is the root.  A path
    that does not lead its own leaf to the root raises.  Null ids come back as null, repeated rows have a proof each, an empty table has none.
    """
    steps, depth, arity = manifest.steps, manifest.depth, manifest.arity
    if manifest.root is None:
        return manifest.leaves.sparkSession.createDataFrame([], PROOFS)
    top = manifest.inner.filter(F.col("tree") == TOP).agg(F.max("up_level")).first()[0] or 0
    leaves, inner, size = manifest.leaves, manifest.inner, manifest.inner_bytes
    for n in range(math.ceil(math.log2(depth + 1))):
        reach, small = 1 << n, size <= BROADCAST_BYTES
        far = inner.filter(_far(reach))
        copies = 1 if small else min(arity ** (reach - 1), MOST_COPIES)
        leaves = _jump(leaves, far, (top, 0), copies, small)
        if 2 * reach <= depth:
            bytes_after = F.when(_far(2 * reach), F.octet_length("segment") + 64).otherwise(0)
            inner, sums = steps.write_and_sum(_jump(inner, far, (top, 0), copies, small), size=bytes_after)
            size = sums["size"]
    rows = leaves.select("payload.doc_id", "digest", "payload.altered", "segment")
    return rows.mapInArrow(_fold_rows(manifest.root), PROOFS)

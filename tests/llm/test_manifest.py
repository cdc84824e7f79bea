import hashlib
from collections import Counter, defaultdict

import plain
import pytest
from pyspark.sql import functions as F

from roadcast.llm import manifest
from roadcast.llm.manifest import build_manifest, fold, leaf_digest, proofs


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def climb(level, arity, paths):
    """Root of a list of (digest, members); appends the digests met on the way to the path of each member."""
    while len(level) > 1:
        up = []
        for at in range(0, len(level), arity):
            run = level[at : at + arity]
            for n, (_, members) in enumerate(run):
                for member in members:
                    paths[member].append("".join(d for k, (d, _) in enumerate(run) if k != n))
            up.append((sha("".join(d for d, _ in run)), [m for _, members in run for m in members]))
        level = up
    return level[0]


def want(rows, arity):
    groups = defaultdict(list)
    for n, (group, doc_id, digest) in enumerate(rows):
        groups[group].append((doc_id is not None, doc_id or 0, digest, n))
    paths, tops, subroots = defaultdict(list), [], {}
    for group in sorted(groups, key=lambda g: (g is not None, (g or "").encode())):
        digest, members = climb([(d, [n]) for _, _, d, n in sorted(groups[group])], arity, paths)
        subroots |= dict.fromkeys(members, digest)
        tops.append((digest, members))
    root = climb(tops, arity, paths)[0]
    return Counter((rows[n][1], rows[n][2], subroots[n], root, sha("".join(paths[n]))) for n in range(len(rows)))


def table(spark, rows):
    kinds = "group string, doc_id long, digest binary, altered binary, pos string, tree string, segment string"
    return spark.createDataFrame([(g, i, bytes.fromhex(d), None, "pos", "tree", "segment") for g, i, d in rows], kinds)


SIZES = [("hot", 150), ("a", 9), ("ä", 8), ("b", 1), (None, 17)]


@pytest.mark.parametrize("arity, sizes, broadcast", [(8, SIZES, 1 << 20), (8, SIZES, 0), (2, SIZES, 0), (2, [("one", 33)], 0), (3, [("x", 1)], 0), (2, [(f"g{n}", 1) for n in range(19)], 0)])
def test_proofs_against_plain_tree(spark, monkeypatch, arity, sizes, broadcast):
    monkeypatch.setattr(manifest, "BROADCAST_BYTES", broadcast)
    rows = [(g, 1000 - n, sha(f"{g}{n}")) for g, many in sizes for n in range(many)]
    rows += [(rows[0][0], None, sha("null")), (rows[0][0], 5000, sha("same")), (rows[0][0], 5000, sha("same"))] if len(rows) > 1 else []
    got = proofs(build_manifest(table(spark, rows).repartition(5), arity)).collect()
    assert Counter((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256) for r in got) == want(rows, arity)
    assert all(r.verified and r.folded_root == r.root for r in got)
    other = got[0].path
    assert fold(bytes.fromhex(sha("tampered")), other)[1] != got[0].root or not other


def test_empty_table(spark):
    assert proofs(build_manifest(table(spark, []))).collect() == []


def test_altered_rows_fail(spark):
    docs = plain.documents(spark, plain.ODD + [(20 + n, f"Text {n}") for n in range(30)])
    shown = [F.col("doc_id"), F.col("text")]
    altered = F.when(F.col("doc_id") % 2 == 0, leaf_digest([F.col("doc_id"), F.lower("text")]))
    rows = docs.select(F.lit(None).cast("string").alias("group"), "doc_id", leaf_digest(shown).alias("digest"), altered.alias("altered"))
    for r in proofs(build_manifest(rows)).collect():
        assert r.verified == (r.doc_id is None or r.doc_id % 2 == 1 or r.doc_id < 20)
    null = next(r for r in proofs(build_manifest(rows)).collect() if r.doc_id == 1)
    assert null.leaf == sha("1:1-")
    assert proofs(build_manifest(rows)).first().root == proofs(build_manifest(rows.repartition(7))).first().root


def test_a_path_that_leads_elsewhere_raises(spark):
    tree = build_manifest(table(spark, [("a", n, sha(str(n))) for n in range(20)]))
    tree.root = sha("other")
    with pytest.raises(Exception, match="does not lead to the root"):
        proofs(tree).collect()

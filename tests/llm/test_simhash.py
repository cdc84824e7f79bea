import random
import re
from collections import Counter

import numpy as np
import plain
import pytest
import xxhash

from roadcast.llm.simhash import close_groups, fingerprint, grow, masks, search, simhash_groups
from roadcast.llm.common import Steps


def slow_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall("[^\x20\x09-\x0d]+", lowered)
    runs = [" ".join(found[n : n + 4]) for n in range(max(1, len(found) - 3))] if found else []
    codes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(c >> bit & 1 for c in codes) > len(codes))


TEXTS = ["", None, " \t\x0b ", "One", "a b c d", "a b c d e", "É ÀB x y z w", "w " * 50, plain.text("s", 300), "a b c\nd  e"]


def test_fingerprint_against_plain_bits():
    for text in TEXTS:
        assert fingerprint((text or "").encode()) == slow_fingerprint(text), text


@pytest.mark.parametrize("radius, n_codes", [(1, 10), (4, 10), (4, 10**9), (4, 10**13), (3, 10**11)])
def test_masks_miss_no_pair(radius, n_codes):
    found, rng = masks(radius, n_codes), random.Random(5)
    for _ in range(2000):
        flips = sum(1 << bit for bit in rng.sample(range(64), radius))
        assert any(not flips & m for m in found)


def test_tree_finds_what_a_scan_finds():
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 2**63, 6, np.uint64)
    flips = (np.uint64(1) << rng.integers(0, 64, (400, 3)).astype(np.uint64)).sum(axis=1, dtype=np.uint64)
    codes = np.unique(centre[rng.integers(0, 6, 400)] ^ flips)
    tree = np.sort(rng.integers(0, 3, len(codes)))
    parent, edge = grow(codes, tree)
    for n in np.flatnonzero(parent >= 0):
        assert edge[n] == np.bitwise_count(codes[n] ^ codes[parent[n]]) and tree[n] == tree[parent[n]]
    children = parent[parent >= 0] * 65 + edge[parent >= 0]
    assert len(set(children.tolist())) == len(children)
    roots = np.flatnonzero(parent < 0)
    for radius in (0, 2, 4, 9):
        query, node = search(codes, parent, edge, codes, roots[tree], radius)
        apart = np.bitwise_count(codes[:, None] ^ codes[None, :])
        want = (apart <= radius) & (tree[:, None] == tree[None, :])
        assert set(zip(query.tolist(), node.tolist())) == set(zip(*map(np.ndarray.tolist, np.nonzero(want))))


def near_codes(seed):
    """Balls of codes, chains of small steps that go far, and codes of their own."""
    rng, out = random.Random(seed), set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        out |= {centre ^ sum(1 << bit for bit in rng.sample(range(64), rng.randrange(7))) for _ in range(40)}
        for _ in range(12):
            centre ^= sum(1 << bit for bit in rng.sample(range(64), rng.choice([3, 4, 5])))
            out.add(centre)
    return sorted(out | {rng.getrandbits(64) for _ in range(60)} | {0, 15, 31})


@pytest.mark.parametrize("seed, radius, shard", [(1, 4, 1024), (2, 4, 7), (3, 2, 16), (4, 5, 5)])
def test_groups_against_all_pairs(spark, seed, radius, shard):
    codes = near_codes(seed)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    units = spark.createDataFrame([(c, 1 + n % 3) for n, c in enumerate(signed)], "code long, n long")
    got = {r.uid: r.comp for r in close_groups(units, len(codes), radius, Steps(spark), shard).collect()}
    root = plain.classes(len(codes), lambda a, b: (codes[a] ^ codes[b]).bit_count() <= radius)
    least = {}
    for n, r in enumerate(root):
        least[r] = min(least.get(r, 1 << 64), signed[n])
    assert {c: got.get(c, c) for c in signed} == {c: least[r] for c, r in zip(signed, root)}


def test_documents_against_all_pairs(spark):
    base = plain.text("base", 200)
    pairs = plain.ODD + [(40 + n, t) for n, t in enumerate(TEXTS)] + [(100 + n, plain.edited(base, n, n % 4)) for n in range(40)] + [(300 + n, plain.text(n, 30)) for n in range(30)]
    got = simhash_groups(plain.documents(spark, pairs).repartition(3)).collect()
    marks = [slow_fingerprint(t) for _, t in pairs]
    root = plain.classes(len(pairs), lambda a, b: (marks[a] ^ marks[b]).bit_count() <= 4)
    least = {}
    for (i, _), r in zip(pairs, root):
        least[r] = min((x for x in (i, least.get(r)) if x is not None), default=None)
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == Counter((i, f"{m:016x}", least[r]) for (i, _), m, r in zip(pairs, marks, root))
    assert Counter(r.component_size for r in got) == Counter(Counter(root)[r] for r in root)


def test_empty_table(spark):
    assert simhash_groups(plain.documents(spark, [])).collect() == []

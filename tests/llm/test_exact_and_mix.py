import hashlib
from collections import Counter, defaultdict

import plain
import pytest

from roadcast.llm.exact_dedup import TextTable, exact_dedup
from roadcast.llm.mixing import emit_mix, mix


def test_table_tells_equal_codes_apart():
    table = TextTable()
    for text in (b"one", b"two"):
        entry, at = table.find(5, text)
        assert entry == -1
        table.add(5, text, at)
    assert table.find(5, b"two")[0] == 1 and table.find(5, b"three")[0] == -1


@pytest.mark.parametrize("limits", [{}, {"window_bytes": 300, "window_rows": 7, "bucket_bytes": 10_000, "table_bytes": 600}])
def test_exact_against_grouping(spark, limits):
    pairs = plain.ODD + [(100 + n, plain.text(n % 9, 20)) for n in range(80)] + [(500 + n, "hot") for n in range(60)]
    got = exact_dedup(plain.documents(spark, pairs).repartition(4), **limits).collect()
    groups = defaultdict(list)
    for i, t in pairs:
        groups[t or ""].append(i)
    want = Counter()
    for t, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        want.update((i, best, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    stay = [r for r in got if r.kept]
    assert len(stay) == len(groups) and all(r.doc_id == r.keep_id for r in stay)


def test_exact_empty_table(spark):
    assert exact_dedup(plain.documents(spark, [])).collect() == []


def targets(sizes, weights=(5, 2, 1), repeat=3):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[n % len(weights)] for n, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = [s for s in names if s not in full]
        left = total - sum(repeat * sizes[s] for s in full)
        share = sum(weight[s] for s in rest)
        out = {s: repeat * sizes[s] if s in full else weight[s] * left / share for s in names}
        over = {s for s in rest if out[s] > repeat * sizes[s]}
        if not over:
            return out
        full |= over


def test_mix_against_plain_shares(spark):
    docs = plain.documents(spark, [])
    pairs, sizes = [], Counter()
    for source, n, of in (("web", 600, 40), ("a", 20, 30), ("b", 40, 25), (None, 15, 10)):
        part = [(len(pairs) + k, plain.text((source, k).__repr__(), of)) for k in range(n)]
        pairs += part
        sizes[source] += n * of
        docs = docs.unionByName(plain.documents(spark, part, source))
    docs = docs.unionByName(plain.documents(spark, [(None, None), (9000, ""), (9001, "x y z"), (9001, "x y z")], "a"))
    sizes["a"] += 4
    got = mix(docs, carry=["source"]).collect()
    want = targets(sizes)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r._c0] and abs(r.target - want[r._c0]) < 1e-6 * max(1, want[r._c0])
        assert r.taken == r.copies * r.size <= 3 * r.size
        taken[r._c0] += r.taken
    assert len(got) == docs.count()
    for source, target in want.items():
        assert abs(taken[source] - target) < 0.15 * target + 120
    assert sorted(map(repr, mix(docs.repartition(7), carry=["source"]).collect())) == sorted(map(repr, got))
    out = emit_mix(docs)
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in got)


def test_mix_empty_and_wordless(spark):
    assert mix(plain.documents(spark, [])).collect() == []
    assert [r.taken for r in mix(plain.documents(spark, [(1, None), (2, " ")])).collect()] == [0, 0]

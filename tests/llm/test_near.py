from collections import Counter

import numpy as np
import plain

from roadcast.llm import near
from roadcast.llm.near import WordCodes, word_codes
from roadcast.llm.near_dedup import banded_distance, near_dedup
from roadcast.llm.substring_dedup import cut_repeats, cuts, find_repeats, passages


def test_banded_distance_against_the_whole_matrix():
    rng = np.random.default_rng(3)
    for n in range(300):
        a = rng.integers(0, 4, rng.integers(0, 30)).astype(np.uint64)
        b = a.copy() if n % 2 else rng.integers(0, 4, rng.integers(0, 30)).astype(np.uint64)
        for _ in range(rng.integers(0, 6)):
            if len(b):
                at = rng.integers(0, len(b))
                b = np.delete(b, at) if rng.random() < 0.5 else np.insert(b, at, np.uint64(9))
        limit, true = int(rng.integers(0, 12)), plain.distance(a.tolist(), b.tolist())
        assert banded_distance(a, b, limit) == min(true, limit + 1)


def near_copies():
    pairs = []
    for group, (copies, size) in enumerate([(1, 90), (2, 150), (4, 200), (40, 120), (3, 30)]):
        original = plain.text(f"near{group}", size)
        pairs += [(1000 * group + n, plain.edited(original, (group, n).__repr__(), n % 3 if size > 60 else 0)) for n in range(copies)]
    other = plain.text("order", 120).split()
    return pairs + [(7000, " ".join(other)), (7001, " ".join(other[60:] + other[:60])), (7002, " ".join(other).upper() + "!")]


def test_near_dedup_against_alignment_of_all_pairs(spark):
    pairs = near_copies()
    found = [plain.words(t) for _, t in pairs]
    root = plain.classes(len(pairs), lambda a, b: plain.distance(found[a], found[b]) <= 0.2 * max(len(found[a]), len(found[b])))
    want = {pairs[n][0]: pairs[r][0] for n, r in enumerate(root)}
    got = near_dedup(plain.documents(spark, pairs).repartition(6)).collect()
    assert {r.doc_id: r.class_id for r in got} == want
    sizes = Counter(want.values())
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in got)
    assert want[7001] == 7001 and want[7002] == 7000  # the same words in another order are no copy


def test_texts_that_share_a_part_are_not_listed_pair_by_pair(spark, monkeypatch):
    """60 texts with the same 75 % of their words, of which some in three groups of copies: links as over all pairs, and far fewer pairs are aligned."""
    part = plain.text("part", 150)
    pairs = [(n, f"{part} {plain.text(f'own{n}', 50)}") for n in range(60)]
    pairs += [(100 + n, plain.edited(pairs[n % 3][1], n, 1 + n % 5)) for n in range(30)]
    pairs += [(200, plain.edited(pairs[7][1], 3, 30))]
    found = [plain.words(t) for _, t in pairs]
    root = plain.classes(len(pairs), lambda a, b: plain.distance(found[a], found[b]) <= 0.2 * max(len(found[a]), len(found[b])))
    aligned, verified = [], near.verified
    monkeypatch.setattr(near, "verified", lambda pairs, n, *rest: aligned.append(n) or verified(pairs, n, *rest))
    got = {r.doc_id: r.class_id for r in near_dedup(plain.documents(spark, pairs), ell=2).collect()}
    assert got == {pairs[n][0]: pairs[r][0] for n, r in enumerate(root)}
    assert len(set(got.values())) > 50 and sum(aligned) < 900  # of 1,770 pairs without a link


def test_near_dedup_oddities(spark):
    got = near_dedup(plain.documents(spark, plain.ODD)).collect()
    assert len(got) == len(plain.ODD)
    by_class = Counter((r.class_id, r.class_size) for r in got)
    # no words: both nulls, empty and blank; "a" three times, first under a null id; the long text; the other letters
    assert by_class == {(None, 4): 4, (None, 3): 3, (5, 2): 2, (7, 1): 1}
    assert sum(r.kept for r in got) == 4
    assert near_dedup(plain.documents(spark, [])).collect() == []


def hidden_passages():
    """A passage of 60 words inside longer lines, one with a word replaced, one over a line end; and texts of their own."""
    passage = plain.text("passage", 60)
    pairs = [(n, f"{plain.text(f'a{n}', 40 + n)} {passage} {plain.text(f'b{n}', 55)}") for n in range(40)]
    words_of = passage.split()
    pairs += [(60, f"{plain.text('c', 30)}\n{' '.join(words_of[:25])}\n{' '.join(words_of[25:])} {plain.text('d', 30)}")]
    pairs += [(61, f"{plain.text('e', 45)} {plain.edited(passage, 5, 1)}"), (62, passage)]
    own = [(100 + n, plain.text(f"own{n}", 150)) for n in range(30)]
    short = [(200 + n, f"{plain.text(f's{n}', 60)}\n{plain.text('notice', 18)}\n{plain.text(f't{n}', 60)}") for n in range(12)]
    return passage, pairs, own, short


def test_passages_inside_longer_lines(spark):
    passage, pairs, own, short = hidden_passages()
    docs = plain.documents(spark, pairs + own + short)
    repeats = find_repeats(docs.repartition(5))
    got = repeats.collect()
    texts = dict(pairs)
    # all that hold the passage, and no text of its own or with a short notice only
    assert set(texts) - {61} <= {r.doc_id for r in got} <= set(texts)  # a word replaced in the middle may leave too little on either side
    for r in got:
        found = texts[r.doc_id][r.start : r.stop].split()
        assert len(found) == r.n_words >= 25
        shared = [w for w in found if w in passage.split()]
        assert len(shared) >= len(found) - 12
        assert r.class_doc_id == 0 and r.kept == (r.doc_id == 0)
    cut = {r.doc_id: r for r in cut_repeats(docs, repeats).collect()}
    spans = {r.doc_id: (r.start, r.stop) for r in got if not r.kept}
    for i, t in pairs + own + short:
        a, b = spans.get(i, (0, 0))
        assert cut[i].text == t[:a] + t[b:] and cut[i]._away == "away"


def similar_places(pairs):
    """Passages of all texts by the same cuts, their components over all pairs, and the words in classes of several texts."""
    places = []
    for i, t in pairs:
        found = plain.words(t)
        if found:
            codes = word_codes(found, WordCodes())
            for a, b in zip(*passages(cuts(codes))):
                places.append((i, int(a), int(b), plain.runs(found[a:b])))
    root = plain.classes(len(places), lambda x, y: len(places[x][3] & places[y][3]) >= 0.8 * len(places[x][3] | places[y][3]))
    members = {}
    for n, r in enumerate(root):
        members.setdefault(r, set()).add(places[n][0])
    return {(i, w) for (i, a, b, _), r in zip(places, root) if len(members[r]) > 1 for w in range(a, b)}


def test_repeats_against_all_pairs_of_passages(spark):
    _, pairs, own, _ = hidden_passages()
    base = plain.text("base", 160)
    pairs = pairs[:6] + pairs[40:] + own[:6] + [(300 + n, plain.edited(base, n, n)) for n in range(5)]
    want = similar_places(pairs)
    texts, got = dict(pairs), set()
    for r in find_repeats(plain.documents(spark, pairs), least_words=1, missed=1e-6).collect():
        before = len(plain.words(texts[r.doc_id][: r.start]))
        got |= {(r.doc_id, w) for w in range(before, before + r.n_words)}
    assert got == want


def test_cuts_follow_the_words():
    inner = plain.text("inner", 80).split()
    places = []
    for n in range(20):
        head = plain.text(f"h{n}", 10 + n).split()
        edges = cuts(word_codes(head + inner + plain.text(f"t{n}", 20).split(), WordCodes())) - len(head)
        places.append({int(e) for e in edges if 8 <= e <= 72})
    assert all(p == places[0] for p in places) and len(places[0]) >= 4
    for found in (["a"] * 500, ["a"], ["a", "b"], plain.text("x", 4000).split()):
        edges = cuts(word_codes(found, WordCodes()))
        assert edges[0] == 0 and edges[-1] == len(found) and np.diff(edges).max() <= 64
        first, end = passages(edges)
        assert first[0] == 0 and end[-1] == len(found) and (first[1:] <= end[:-1]).all()


def test_repeats_oddities(spark):
    docs = plain.documents(spark, plain.ODD)
    repeats = find_repeats(docs)
    assert {(r.doc_id, r.kept) for r in repeats.collect()} == {(5, True), (6, False)}
    out = cut_repeats(docs, repeats)
    assert out.columns == docs.columns and out.count() == len(plain.ODD)
    assert {r.doc_id: r.text for r in out.collect()}[6].strip() == ""
    assert find_repeats(plain.documents(spark, [])).collect() == []
    letters = plain.documents(spark, [(n, f"İ{n} İstanbul " * 3 + plain.text("tr", 60)) for n in range(2)])
    found = find_repeats(letters).collect()
    texts = {r.doc_id: r.text for r in letters.collect()}
    assert len(found) == 2 and all(texts[r.doc_id][r.start : r.stop].split()[-1] == plain.text("tr", 60).split()[-1] for r in found)

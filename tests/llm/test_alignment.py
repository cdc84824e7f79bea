import hashlib
from collections import Counter
from itertools import accumulate

import plain
import public_tokenizers
import pytest

from roadcast.llm import alignment
from roadcast.llm.alignment import Aligner, align_tokenizers

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "héllo 你好 🙂ab", "  a  b  ", "a\r\nb \t c", "\n\nfoo\n bar\n", "a▁b", "<s>x</s> <|endoftext|> <0x41>", "x", " ", "\n", " \n ", "éé ́x", "﷽ ﬁ", "a\x00b",
    "word " * 10, "it's I'll don't", "a  b c", "12345 67.89,", "\U0001f468‍\U0001f469‍\U0001f467 ñ", "the the the",
]


@pytest.fixture(scope="module")
def tokenizers():
    return Aligner(A, B)


def slow(two, text):
    """Whole text through both libraries, ends from decoded bytes only."""
    if not text:
        return None
    a, b = two.a.encode(" " + text, add_special_tokens=False).ids, two.b.encode(text)
    sides = [two.a_bytes[n] for n in a], [two.b_bytes[n] for n in b]
    if any(b"".join(side) != (" " + text).encode() for side in sides):
        return None
    ends = [list(accumulate(map(len, side))) for side in sides]
    both = sorted(set(ends[0]) & set(ends[1]))
    groups, links, i, j = [], [], 0, 0
    for stop in both:
        m, n = ends[0].index(stop, i) + 1, ends[1].index(stop, j) + 1
        groups.append(",".join(map(str, a[i:m])) + "|" + ",".join(map(str, b[j:n])))
        links.append((a[m - 1], b[n - 1]))
        i, j = m, n
    return len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()


def want(two, pairs):
    found = [(i, slow(two, t)) for i, t in pairs]
    counts = Counter(link for _, f in found if f for link in f[3])
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    out = Counter()
    for i, f in found:
        a, b, groups, links, sha = f or (0, 0, 0, [], "")
        out[i, a, b, groups, len(links), sum(counts[k] == most[k[1]] for k in links), sum(counts[k] for k in links), sha] += 1
    return out


@pytest.mark.parametrize("broadcast_pairs", [1 << 20, 0])
def test_against_whole_texts(spark, tokenizers, broadcast_pairs):
    words = ["Wörter", "the", "über,", "naïve", "a", "rock'n'roll", "¿qué?", "x1y2", "\n", "東京", "of", "🙂🙂"]
    mixed = [(200 + n, " ".join(words[(n * k + k // 3) % len(words)] for k in range(60))) for n in range(25)]
    pairs = plain.ODD + [(40 + n, t) for n, t in enumerate(TEXTS)] + mixed
    got = align_tokenizers(plain.documents(spark, pairs).repartition(2), A, B, broadcast_pairs=broadcast_pairs).collect()
    assert Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got) == want(tokenizers, pairs)


def test_settings_reach_the_code_that_runs(tokenizers, monkeypatch):
    """The same rows come from one section or many, and from pieces learnt again and again."""
    for name, value in (("_BATCH_CHARS", 50), ("_LEARN_CHARS", 20), ("_KNOWN", 30)):
        monkeypatch.setattr(alignment, name, value)
    text = " ".join(f"w{n} ünd" for n in range(200))
    assert "".join(alignment._sections(" " + text)) == " " + text and len(list(alignment._sections(" " + text))) > 10
    pieces = alignment.Pieces(tokenizers)
    parts = [alignment.PIECES(s) for s in alignment._sections(" " + text)]
    pieces.learn(list(dict.fromkeys(p for part in parts for p in part)))
    a, b, groups, links, sha = slow(tokenizers, text)
    assert alignment._row(parts, pieces)[:5] == (a, b, groups, len(links), sha)


def test_spans_cut_and_bytes_refine(tokenizers):
    found = tokenizers.align(" 你好 x")
    assert found.a_stops.tolist() == list(accumulate(len(tokenizers.a_bytes[n]) for n in found.a))
    assert found.b_stops.tolist() == list(accumulate(len(tokenizers.b_bytes[n]) for n in found.b))
    assert any(s not in found.b_stops for s in found.a_stops)


def test_empty_table(spark):
    assert align_tokenizers(plain.documents(spark, []), A, B).collect() == []

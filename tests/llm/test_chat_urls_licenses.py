import hashlib
import struct

import numpy as np
import plain
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from roadcast.llm import chat, licenses
from roadcast.llm.common import Steps
from roadcast.llm.queries import URL_RULES
from roadcast.llm.url_filter import Segment, build_index, judge_urls

TEXT = st.text() | st.lists(st.sampled_from([*chat.CONTROL, "\\", "<", "|", "turn|>", "<|text|>\n", "<|end|>\n", "a", "\n"])).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "<|end|>\n"]), TEXT), min_size=1))
def test_turns_come_back(turns):
    formatted, mask = chat.format_turns(turns)
    assert chat.parse_turns(formatted) == turns
    assert [chat.unescape(formatted[a:b]) for a, b in mask] == [t for r, t in turns if r == "assistant"]
    assert not any(c in chat.escape(t) for _, t in turns for c in chat.CONTROL)


def test_linear_conversations_against_plain_order(spark):
    rows = [(1, 1, "assistant", "two</s>"), (1, 0, "user", "one"), (2, 0, "user", None), (2, None, None, "first"), (None, 0, "user", "x"), (3, 0, "assistant", plain.LONG)]
    rows += [(4, 0, "user", "same"), (4, 0, "user", "same"), (4, 1, "assistant", "")]
    table = spark.createDataFrame([(*r, "leaf") for r in rows], "conv_id long, turn long, role string, text string, leaf string")
    steps = Steps(spark)
    got = {r.conv_id: r for r in chat.read_back(steps.write(chat.format_conversations(chat.linear_trees(table, steps), steps))).collect()}
    assert got.keys() == {1, 2, 3, 4, None}
    for conv, r in got.items():
        turns = sorted(((t[1] is not None, t[1] or 0, t[2] or "", t[3] or "") for t in rows if t[0] == conv))
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        assert r.n_turns == len(turns) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{t[2]}\n{t[3]}\n" for t in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.format_conversations(chat.linear_trees(table.limit(0), steps), steps).collect() == []


def test_branches_of_a_tree(spark):
    kinds = "tree long, node long, parent long, role string, text string, score double"
    nodes = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "good", 3.0), (1, 3, 1, "assistant", "bad", None), (1, 4, 2, "user", "more", 1.0), (1, 5, 4, "assistant", "end", 2.0), (2, 9, 77, "user", "no such parent", 1.0)]
    nodes += [(3, 100 + n, 99 + n if n else None, "user", str(n), 0.0) for n in range(13)]
    tree = spark.createDataFrame(nodes, kinds)
    got = {(r.tree, r.rank): r for r in chat.format_conversations(tree, Steps(spark)).collect()}
    said = {k: [t for _, t in chat.parse_turns(r.formatted)] for k, r in got.items()}
    assert said == {(1, 1): ["q", "good", "more", "end"], (1, 2): ["q", "bad"], (2, 1): ["no such parent"], (3, 1): [str(n) for n in range(13)]}
    assert {(r.tree, r.rank) for r in chat.format_conversations(tree, Steps(spark), branches=1).collect()} == {(1, 1), (2, 1), (3, 1)}
    with pytest.raises(ValueError):
        chat.reply_paths(spark.createDataFrame([(1, 1, 2, "user", "", 0.0), (1, 2, 1, "user", "", 0.0)], kinds), Steps(spark))


def plain_verdict(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h + p), h + p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, "allow"))


def test_urls_against_every_rule(spark):
    urls = [None, "", "no scheme", "http://", "https://Example.COM/en/a?x=/en/", "http://www.example.com/en/", "http://a.www.example.com/en/b#c", "x://notexample.com/en/", "http://a.b.net/es/1", "http://net/fr/",
            "http://net/es", "ftp://example.com", "http://example.com?/en/", "http://com/", "http://İ.net/es/", "http://a://b.net/es/", "http://" + "a." * 500 + "net/es/" + "x" * 20_000]
    rows = [(n, u, "clash", "clash") for n, u in enumerate(urls)] + [(None, urls[4], "clash", "clash"), (4, urls[4], "clash", "clash")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    index = build_index(spark.createDataFrame(URL_RULES, "host string, path string, verdict string"))
    got = judge_urls(pages, index).collect()
    assert sorted(map(repr, [tuple(r) for r in got])) == sorted(repr((r[0], *plain_verdict(r[1]))) for r in rows)
    assert judge_urls(pages.limit(0), index).collect() == []
    nothing = build_index(spark.createDataFrame([], "host string, path string, verdict string"))
    assert {r.verdict for r in judge_urls(pages, nothing).collect()} == {"allow"}


def test_equal_digests_are_told_apart_by_the_strings(tmp_path):
    strings = [b"one/\x01", b"two/\x00"]
    digest = xxhash.xxh64_intdigest(b"two/")
    ends = np.cumsum([len(s) for s in strings]).astype("<u8")
    (tmp_path / "s").write_bytes(struct.pack("<Q", 2) + np.full(2, digest, "<u8").tobytes() + ends.tobytes() + b"".join(strings))
    segment = Segment(str(tmp_path / "s"))
    assert segment.probe(np.full(3, digest, np.uint64), [b"one/", b"two/", b"three/"]) == {0: True, 1: False}


def test_licences(spark):
    mit = next(t for n, t in licenses.KNOWN if n == "MIT" and len(t) > 300)
    changed = mit.upper().replace("COPYRIGHT (C) YEAR HOLDER", "Copyright 2019-2024 Some One <a@b>\n(c) Another").replace("SUBLICENSE", "sub-licence".replace("-", ""))
    docs = plain.documents(spark, [*plain.ODD, (20, mit), (21, changed), (22, mit + " and more"), (23, "Some work.\n\nreleased under the MIT licence!\nLicensed under the Apache License version 2.0")])
    got = {}
    for r in licenses.scan_licenses(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(plain.ODD) + 4
    assert got[20][0].license == got[21][0].license == "MIT" and got[20][0].text_digest == got[21][0].text_digest
    assert got[22][0].license is None
    assert (got[23][0].license, got[23][0].n_notices, got[23][0].notices) == (None, 2, "Apache-2.0,MIT")
    assert all(r.license is None and r.n_notices == 0 and r.notices == "" for i in (1, 2, 3, 4, 5, 6, 7) for r in got[i])
    assert got[1][0].text_digest == got[2][0].text_digest == got[3][0].text_digest
    assert licenses.scan_licenses(plain.documents(spark, [])).collect() == []

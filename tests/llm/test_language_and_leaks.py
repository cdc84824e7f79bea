import math
import random
import sys
import zlib
from collections import Counter

import numpy as np
import plain
from pyspark.sql import functions as F

from roadcast.llm.decontaminate import block_max_wand, build_index, drop_leaks, find_leaks, question_and_answer
from roadcast.llm.language import CELLS, fit_model, predict, present_runs, reject, scores_of, train

# Everyday words of two languages.
ENGLISH = "the of and to in is that it was for on are with as his they at be this have from or one had by word but not what all".split()
GERMAN = "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach".split()


def labelled(spark, n=240):
    import random

    docs = plain.documents(spark, [])
    for lang, vocabulary in (("en", ENGLISH), ("de", GERMAN)):
        rng = random.Random(lang)
        pairs = [(k * 2 + (lang == "de"), " ".join(rng.choice(vocabulary) for _ in range(40))) for k in range(n // 2)]
        docs = docs.unionByName(plain.documents(spark, pairs, lang=lang))
    return docs


def test_languages_of_held_out_documents(spark):
    docs = labelled(spark)
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = predict(docs, train(docs)).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1} and held
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_labels_are_no_input_of_a_prediction(spark):
    docs = labelled(spark)
    held = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3) == 1
    wrong = docs.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang")))
    key = lambda rows: {r.doc_id: (r.lang_pred, r.score) for r in rows}
    assert key(predict(wrong, train(wrong)).collect()) == key(predict(docs, train(docs)).collect())


def test_language_oddities(spark):
    model = train(labelled(spark))
    odd = plain.documents(spark, [*plain.ODD, (8, "123 !?")])
    got = predict(odd, model).collect()
    assert len(got) == len(plain.ODD) + 1
    und = Counter(r.doc_id for r in got if r.lang_pred == "und")
    assert und == {None: 1, 1: 1, 2: 1, 3: 1, 8: 1}
    kept = reject(odd, model, 0.3)
    assert kept.columns == odd.columns and kept.count() == len(plain.ODD) + 1 - 5
    assert predict(plain.documents(spark, []), model).collect() == []
    assert train(plain.documents(spark, [])) is None
    assert {r.lang_pred for r in predict(odd, None).collect()} == {"und"}


SCRIPTS = {"en": (97, 26), "ru": (0x430, 32), "el": (0x3B1, 24), "ja": (0x3041, 80), "zh": (0x4E00, 6000), "ko": (0xAC00, 6000)}


def test_scripts_with_thousands_of_letters(spark):
    import random

    docs, truth = plain.documents(spark, []), {}
    for n, (lang, (first, many)) in enumerate(SCRIPTS.items()):
        rng = random.Random(lang)
        made = [(n + len(SCRIPTS) * k, " ".join("".join(chr(first + rng.randrange(many)) for _ in range(5)) for _ in range(60))) for k in range(60)]
        truth |= {i: lang for i, _ in made}
        docs = docs.unionByName(plain.documents(spark, made, lang=lang))
    held = [r for r in predict(docs, train(docs)).collect() if r.held_out]
    assert {truth[r.doc_id] for r in held} == set(SCRIPTS) and all(r.lang_pred == truth[r.doc_id] for r in held)


def test_scores_against_a_plain_kernel():
    """The kernel matrix written out, its inverse root, and ridge regression on it; 100 texts, the same landmarks."""
    import random

    seen, rng = np.zeros(CELLS, bool), random.Random(4)
    texts = [(lang, " ".join(rng.choice(words) for _ in range(12))) for _ in range(50) for lang, words in (("de", GERMAN), ("en", ENGLISH))]
    samples = sorted(((lang, present_runs(t, seen)) for lang, t in texts), key=lambda s: s[0])
    model = fit_model(samples, landmarks=20)
    sets = [set(r.tolist()) for _, r in samples]
    kernel = lambda a, b: len(a & b) / math.sqrt(len(a) * len(b))
    marks = [sets[n] for lang in ("de", "en") for n in [k for k, s in enumerate(samples) if s[0] == lang][:10]]
    inner = np.array([[kernel(a, b) for b in marks] for a in marks])
    outer = np.array([[kernel(a, b) for b in marks] for a in sets])
    values, vectors = np.linalg.eigh(inner)
    features = outer @ vectors @ np.diag(values**-0.5)
    goal = np.array([[lang == "de", lang == "en"] for lang, _ in samples], float)
    weight = np.full(len(samples), 1 / 50)
    solved = np.linalg.solve((features * weight[:, None]).T @ features + 1e-2 * np.eye(20) * weight.sum() / 100, (features * weight[:, None]).T @ goal)
    assert np.allclose(scores_of([r for _, r in samples], model.weights), features @ solved, atol=2e-3)


def plain_leaks(pairs, items, threshold=0.6, overlap=0.8, k=5):
    """Every passage against every item."""
    tests = [(i, t, plain.words(t)) for i, t in items if plain.words(t)]
    n, mean = len(tests), sum(len(w) for _, _, w in tests) / len(tests)
    df = Counter(w for _, _, found in tests for w in set(found))
    window, out = max(len(w) for _, _, w in tests), {}
    for doc_id, t in pairs:
        found = plain.words(t)
        for at in range(0, max(1, len(found)), window):
            passage = found[at : at + 2 * window]
            for item_id, item, own in tests:
                impact = {}
                for term, tf in Counter(own).items():
                    idf = math.log(1 + (n - df[term] + 0.5) / (df[term] + 0.5))
                    impact[term] = idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(own) / mean))
                score = sum(v for term, v in impact.items() if term in passage) / sum(impact.values())
                question, answer = question_and_answer(item)
                parts = []
                for part in (question, answer):
                    wanted = plain.runs(part, k)
                    parts.append(len(wanted & plain.runs(passage, min(k, len(part)))) / len(wanted) if wanted else 1.0)
                if score >= threshold and min(parts) >= overlap:
                    out[doc_id, item_id] = max(out.get((doc_id, item_id), 0), score)
    return out


def leaky(spark):
    items = [(n, f"{plain.text(f'q{n}', 12 + n)}? {plain.text(f'a{n}', 1 + n % 9)}.") for n in range(30)]
    pairs = []
    for n in range(40):
        body = plain.text(f"body{n}", 150).split()
        if n % 3 == 0:  # the whole item, at any place
            body[n * 3 : n * 3] = items[n % 30][1].split()
        elif n % 3 == 1:  # the question without its answer
            body[n : n] = items[n % 30][1].split("?")[0].split()
        pairs.append((n, " ".join(body)))
    return pairs, items


def test_leaks_against_every_passage_and_item(spark):
    pairs, items = leaky(spark)
    docs, tests = plain.documents(spark, pairs), plain.documents(spark, items).withColumnRenamed("doc_id", "item_id")
    want = plain_leaks(pairs, items)
    leaks = find_leaks(docs.repartition(4), tests)
    got = {(r.doc_id, r.item_id): r.score for r in leaks.collect()}
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-9 for p in want)
    assert {n for n in range(40) if n % 3 == 0} <= {d for d, _ in got}
    left = drop_leaks(docs, leaks)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted({n for n in range(40)} - {d for d, _ in got})


def test_leaks_do_not_depend_on_chunks(spark):
    pairs, items = leaky(spark)
    items.append((77, plain.text("book", 90)))
    pairs += [(900, plain.text("x", 70) + " " + items[3][1] + " " + plain.text("y", 70)), (901, plain.text("z", 200) + " " + items[-1][1])]
    docs, tests = plain.documents(spark, pairs), plain.documents(spark, items).withColumnRenamed("doc_id", "item_id")
    key = lambda df: sorted((r.doc_id, r.item_id, round(r.score, 9)) for r in df.collect())
    whole, want = key(find_leaks(docs, tests)), plain_leaks(pairs, items)
    assert key(find_leaks(docs, tests, chunk_bytes=400)) == whole
    assert {(d, i) for d, i, _ in whole} == set(want) and (901, 77) in want and (900, 3) in want


def test_leak_oddities(spark):
    _, items = leaky(spark)
    tests = plain.documents(spark, [*items, (None, None), (90, ""), (91, "w1 w2 w3 w4 w5 w6 w7"), (91, "w1 w2 w3 w4 w5 w6 w7")]).withColumnRenamed("doc_id", "item_id")
    docs = plain.documents(spark, [*plain.ODD, (None, items[3][1]), (None, items[3][1]), (9, "W1, w2 w3 w4; w5 w6 w7!")])
    got = find_leaks(docs, tests)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(None, 3), (9, 91)} and got.count() == 2
    assert drop_leaks(docs, got).filter("doc_id = 9").count() == 0
    assert find_leaks(plain.documents(spark, []), tests).collect() == []
    assert find_leaks(docs, tests.limit(0)).collect() == []


def test_index_search_against_sums_over_all_items():
    """All items at the threshold, their scores, and no numpy call for a place in a list of a few postings."""
    items = [(n, plain.text(f"i{n}", 10 + n % 40)) for n in range(60)]
    found = [plain.words(t) for _, t in items]
    index = build_index(items, Counter(w for f in found for w in set(f)), len(items), 30.0, 60, 0.4)
    rng, calls = random.Random(2), Counter()
    for _ in range(60):
        asked = {w for w in rng.choice(found) if rng.random() < 0.7} | set(rng.sample(list(index.terms), 40))
        scores = Counter()
        for w in asked:
            for item, impact in zip(*index.postings[index.terms[w]]):
                scores[item] += impact
        sys.setprofile(lambda frame, event, called: calls.update([called.__name__]) if event == "c_call" else None)
        got = dict(block_max_wand(index, sorted(index.terms[w] for w in asked), 0.4))
        sys.setprofile(None)
        assert got.keys() == {i for i, v in scores.items() if v >= 0.4} and got
        assert all(abs(got[i] - scores[i]) < 1e-9 for i in got)
    assert calls["searchsorted"] == 0 < calls["bisect_left"]

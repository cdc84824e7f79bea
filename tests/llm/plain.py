"""Plain versions of what several operators do, and documents with every oddity."""

import random
import re

VOCABULARY = [f"w{n}" for n in range(4000)]
KINDS = "doc_id long, text string, source string, lang string, uid string, size string, kept string, score string, shard string, _tie string, _a string, _b string, _leak_id string, _away string, _near_row string"


def text(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def edited(original, seed, n):
    """``n`` words replaced."""
    rng, found = random.Random(seed), original.split()
    for at in rng.sample(range(len(found)), n):
        found[at] = f"x{rng.randrange(10**6)}"
    return " ".join(found)


def words(t):
    return re.findall(r"\w+", (t or "").lower())


def runs(found, k=5):
    k = min(k, len(found))
    return {tuple(found[n : n + k]) for n in range(len(found) - k + 1)} if k else set()


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def classes(n, linked):
    """Least member of each one's component, by trying all pairs."""
    root = list(range(n))
    for a in range(n):
        for b in range(a):
            if root[a] != root[b] and linked(a, b):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    return root


# Null ids and texts, empty and blank texts, a very long text twice, a repeated row, letters beyond ASCII.
LONG = text("long", 40_000)
ODD = [(None, None), (1, None), (2, ""), (3, "  \n "), (4, "a"), (4, "a"), (5, LONG), (6, LONG), (7, "Ünïcode 漢字 \U0001f600"), (None, "a")]


def documents(spark, pairs, source="s", lang=None):
    """Documents with more columns, named like those that operators make."""
    rows = [(i, t, source, lang, "uid", "size", "kept", "score", "shard", "tie", *("a", "b", "leak", "away", "near")) for i, t in pairs]
    return spark.createDataFrame(rows, KINDS)

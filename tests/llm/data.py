"""Inputs that every operator must take, and plain versions to compare with."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

SF = "/root/testdata/sf0.001"

LONG = "One more sentence about nothing at all, number %d. "

ROWS = [
    (1, None, "en"),
    (2, "", "en"),
    (3, " \n\t ", None),
    (4, "The cat sat on the mat and looked at the dog. It was warm.", "en"),
    (4, "The cat sat on the mat and looked at the dog. It was warm.", "en"),
    (5, "THE CAT sat on the mat and looked at the dog. It was warm.", "en"),
    (6, "a b", "de"),
    (7, "a b", "de"),
    (None, "A lone text without any id, mit license and 10.1.2.3 within it.", "fr"),
    (None, None, None),
    (8, "".join(LONG % k for k in range(6000)), "en"),
    (9, "x" * 200_000, None),
    (10, "ünïcödé \U0001f642 ​ ▁▁ word‑ \x00 end", "de"),
]

#: Column names that operators use inside.
CLASHING = ["row", "id", "key", "value", "cls", "label", "ids", "matches", "words", "spots", "repeated", "size"]


def hostile(spark):
    schema = "doc_id long, text string, lang string, " + ", ".join(f"`{c}` string" for c in CLASHING) + ", `odd name.` int"
    return spark.createDataFrame([r + tuple(CLASHING) + (1,) for r in ROWS], schema).repartition(3)


def empty(spark):
    return spark.createDataFrame([], hostile(spark).schema)


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text, n=5):
    words = (text or "").encode().translate(_LOWER).split()
    if len(words) < n:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + n]) for k in range(len(words) - n + 1))


def near_components(rows):
    """``{doc_id: least doc_id reachable}`` by comparing all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    met = Counter()
    for group in holders.values():
        for k, a in enumerate(group):
            for b in group[:k]:
                met[(a, b)] += 1
    for (a, b), n in met.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}, {i: len(s) for i, s in sets.items()}


_END = re.compile(r"[.!?]+\s+|\n\s*", re.ASCII)


def cut_repeats(rows, sentences=3, least=20, enough=45):
    """``{doc_id: text}`` by every run that is long enough, of whatever length."""
    parts, runs = {}, {}
    for i, text in rows:
        ends = [m.end() for m in _END.finditer(text)]
        p = parts[i] = [text[a:b] for a, b in zip([0, *ends], [*ends, len(text)], strict=True) if a < b]
        words = [x.encode().translate(_LOWER).split() for x in p]
        runs[i] = []
        for a in range(len(p)):
            n, run = 0, hashlib.sha256()
            for b in range(a + 1, len(p) + 1):
                n += len(words[b - 1])
                run.update(b" ".join(words[b - 1]) + b"|")
                if n >= enough or (n >= least and b - a >= sentences):
                    runs[i].append((a, b, run.digest()))
    first = {}
    for i in sorted(runs):
        for a, _, run in runs[i]:
            first.setdefault(run, (i, a))
    gone = {i: {k for a, b, run in found if first[run] != (i, a) for k in range(a, b)} for i, found in runs.items()}
    return {i: "".join(x for k, x in enumerate(p) if k not in gone[i]) for i, p in parts.items()}

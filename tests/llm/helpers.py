"""Small tables and brute-force answers for the text operators."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows(df, key):
    return {r[key]: r for r in df.collect()}


def documents(spark, texts, schema="doc_id long, text string, lang string, source string, n_chars long"):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts], schema)


class Sets:
    """Groups of ids; the smallest is the name."""

    def __init__(self, ids):
        self.parent = {i: i for i in ids}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1)))


def near_duplicates(texts):
    """doc_id to (set size, component), by comparing every two documents that share a shingle."""
    own = {i: shingles(t) for i, t in texts}
    holders, sets = defaultdict(list), Sets(own)
    for i in sorted(own):
        shared = Counter(j for s in own[i] for j in holders[s])
        for j, k in shared.items():
            if 100 * k >= 80 * (len(own[i]) + len(own[j]) - k):
                sets.join(i, j)
        for s in own[i]:
            holders[s].append(i)
    return {i: (len(own[i]), sets.find(i)) for i in own}

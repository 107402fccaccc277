"""Fixtures and brute-force models for the training-data operators."""

import itertools
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = {i: i + 32 for i in range(65, 91)}
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, lang="en", source="s", ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, lang, source, len(t or "")) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCS)


def shingles(text, n):
    w = WORD.findall((text or "").translate(ASCII_LOWER))
    return {tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


def linked_components(rows, n, percent):
    """[(shingles, smallest linked id)] for rows (id, text) by comparing all pairs."""
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), i), i)
    return [(len(s), least[find(k)]) for k, s in enumerate(sets)]

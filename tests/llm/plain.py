"""Plain Python versions of what the operators compute."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingles(text):
    w = WORD.findall(lower(text))
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(zip(w, w[1:], w[2:], w[3:], w[4:]))


def clusters(sets):
    """Index of the first member of each set's component."""
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    for i, s in enumerate(sets):
        common = Counter(j for g in s for j in holders[g] if j > i)
        for j, n in common.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(sets))]


def contamination(text, items, window=13):
    """Word count, covered words and item ids."""
    words = TOKEN.findall(lower(text))
    hit, found = set(), set()
    places = defaultdict(list)
    for i, w in enumerate(words):
        places[w].append(i)
    for item, content in items:
        own = TOKEN.findall(lower(content))
        n = min(window, len(own))
        for i in range(len(own) - n + 1 if own else 0):
            phrase = own[i : i + n]
            for at in places[phrase[0]]:
                if words[at : at + n] == phrase:
                    hit.update(range(at, at + n))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)

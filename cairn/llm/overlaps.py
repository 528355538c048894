"""Links within a group of sets by counting the overlaps of all pairs at once.

Only a set outside the group's largest component can have a new link, and only
with a set whose size and number of shared tokens leave room for one. Between
these sets, tokens that many hold are counted by products of 0/1 matrices, a
strip of tokens at a time, the others by their pairs of holders.
"""

from __future__ import annotations

import numpy as np

# Tokens that one set in DENSE holds are multiplied, STRIP of them at once; the pairs of others are counted PAIRS at once.
DENSE, STRIP, PAIRS = 16, 512, 1 << 20


def overlaps(asked: np.ndarray, sets: int, owner: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Tokens that each asked set shares with each of all sets; the entries name a set and a token once."""
    place = np.full(sets, -1)
    place[asked] = np.arange(len(asked))
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    held = np.bincount(token)
    kind = np.float32 if np.bincount(owner, minlength=1).max() < 1 << 24 else np.float64
    out = np.zeros((len(asked), sets), kind)
    dense = held * DENSE >= sets
    rank = np.cumsum(dense) - 1
    own, column = owner[dense[token]], rank[token[dense[token]]]
    for low in range(0, int(dense.sum()), STRIP):
        start, end = np.searchsorted(column, (low, low + STRIP))
        strip = np.zeros((sets, STRIP), kind)
        strip[own[start:end], column[start:end] - low] = 1
        out += strip[asked] @ strip.T
    first = np.cumsum(held) - held
    entries = np.flatnonzero(~dense[token] & (place[owner] >= 0))
    many = held[token[entries]]
    ends = np.cumsum(many)
    flat = out.reshape(-1)
    start = 0
    while start < len(entries):
        done = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
        n = many[start:end]
        inside = np.arange(ends[end - 1] - done) - np.repeat(ends[start:end] - n - done, n)
        other = owner[np.repeat(first[token[entries[start:end]]], n) + inside]
        np.add.at(flat, np.repeat(place[owner[entries[start:end]]], n) * sets + other, kind(1))
        start = end
    return out


def connected(names: list, sizes: np.ndarray, component: np.ndarray, sets: list[np.ndarray]) -> list[tuple]:
    """Links that connect sets not yet of one component, as pairs of names.

    ``sets`` are the tokens of each set that others may have too; ``sizes``
    count all. Components are numbers.
    """
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, token, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = held[token] > 1
    owner, token = owner[shared], token[shared]
    many = np.bincount(owner, minlength=len(sets))
    component = component.copy()
    asked = np.flatnonzero(component != np.bincount(component).argmax())
    room = np.zeros(len(sets), bool)
    hopeful = []
    for i in asked:
        may = (9 * np.minimum(many[i], many) >= 4 * (sizes[i] + sizes)) & (component != component[i])
        if may.any():
            hopeful.append(i)
            room |= may
    if not hopeful:
        return []
    room[hopeful] = True
    kept = np.flatnonzero(room)
    place = np.cumsum(room) - 1
    inside = room[owner]
    _, token = np.unique(token[inside], return_inverse=True)
    counts = overlaps(place[hopeful], len(kept), place[owner[inside]], token)
    links = []
    for i, row in zip(hopeful, counts, strict=True):
        near = kept[9 * row.astype(np.int64) >= 4 * (sizes[i] + sizes[kept])]
        while len(near := near[component[near] != component[i]]):
            links.append((names[i], names[near[0]]))
            component[component == component[near[0]]] = component[i]
    return links

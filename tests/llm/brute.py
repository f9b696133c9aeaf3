"""Plain versions of what the operators compute, for small data."""

import re

WORD = re.compile("[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingle_set(text):
    w = WORD.findall(lower(text))
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < 5 else [tuple(w[i: i + 5]) for i in range(len(w) - 4)])


def linked(a, b):
    return bool(a) and bool(b) and 100 * len(a & b) >= 75 * len(a | b)


def groups(sets):
    """Smallest key reachable by links, for {key: set}."""
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    holders = {}
    for k, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(k)
    tried = set()
    for ks in holders.values():
        for i, a in enumerate(ks):
            for b in ks[:i]:
                if (a, b) not in tried:
                    tried.add((a, b))
                    if linked(sets[a], sets[b]):
                        x, y = root(a), root(b)
                        parent[max(x, y)] = min(x, y)
    return {k: root(k) for k in sets}

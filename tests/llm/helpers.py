"""Plain Python versions that the operators are held against."""

import hashlib
import re

WORD = re.compile("[^\x20\x09-\x0d]+")


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingle_set(text, size=5):
    words = WORD.findall(fold(text))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def duplicate_classes(rows, percent=75):
    """{doc_id: (set size, smallest id reachable)} by trying all pairs that share a shingle."""
    sets = {i: shingle_set(t) for i, t in rows}
    having, parent = {}, {i: i for i in sets}
    for i, s in sets.items():
        for x in s:
            having.setdefault(x, []).append(i)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    tried = set()
    for ids in having.values():
        for k, i in enumerate(ids):
            for j in ids[:k]:
                if (i, j) not in tried:
                    tried.add((i, j))
                    both = len(sets[i] & sets[j])
                    if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                        a, b = sorted((root(i), root(j)))
                        parent[b] = a
    return {i: (len(s), root(i)) for i, s in sets.items()}


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()

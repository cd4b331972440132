"""Plain Python versions of operators, for tests."""

from __future__ import annotations

import re
from collections import Counter, defaultdict


def windows_of(text):
    return [w for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))]


def brute_hits(docs, items, width=10):
    wins = defaultdict(set)
    for i, t in items:
        w = windows_of(t)
        k = min(width, len(w))
        for a in range(len(w) - k + 1 if k else 0):
            wins[tuple(w[a : a + k])].add(i)
    out = []
    for d, t in docs:
        w, hit, got = windows_of(t), set(), set()
        for k in {len(x) for x in wins}:
            for a in range(len(w) - k + 1):
                if tuple(w[a : a + k]) in wins:
                    hit |= set(range(a, a + k))
                    got |= {str(x) for x in wins[tuple(w[a : a + k])] if x is not None}
        out.append((d, len(w), len(hit), sorted(got)))
    return out


def brute_links(rows):
    words = [windows_of(t) for _, t in rows]
    sets = [frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset() for w in words]
    up, links = list(range(len(rows))), Counter()

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                up[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, least.get(find(i)) if sets[i] else d, links[i]) for i, (d, _) in enumerate(rows)]


def brute_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {i + k for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for k in range(8)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(repeated)

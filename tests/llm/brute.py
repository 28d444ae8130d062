"""Plain versions of what the operators compute, for small inputs."""

from __future__ import annotations

import re
from collections import Counter


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) >= 5:
        return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}
    return {tuple(words)} if words else set()


def components(nodes, edges):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near(texts, percent):
    """{id: (set size, component)}; texts: {id: text}."""
    sets = {i: shingles(t) for i, t in texts.items()}
    ids = sorted(sets)
    edges = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    found = components(ids, edges)
    return {i: (len(sets[i]), found[i]) for i in ids}


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((0, m.start(), m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((1, m.start(), m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((3, m.start(), m.end(), "phone"))
    return ",".join(f"{k}:{a}:{b}" for _, a, b, k in sorted(out))


def top(vectors, queries, k, scale=256):
    import math

    ints = {i: [math.floor(scale * float(x)) for x in v] for i, v in vectors.items()}
    out = {}
    for q in queries:
        scored = sorted((-sum(a * b for a, b in zip(ints[q], ints[c])), c) for c in ints if c != q)
        out[q] = [(c, -s) for s, c in scored[:k]]
    return out


def doubled(rows):
    return {k for k, n in Counter(rows).items() if n > 1}

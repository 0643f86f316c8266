"""Plain restatements of the operators for small inputs."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

LOWER = {c: c + 32 for c in range(65, 91)}


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def language_model(train: list[str | None], cutoff: int = 1):
    """Returns a function from text to (n_tokens, n_known, base, score) by interpolated absolute discounting of order 3."""
    one, two, three = Counter(), Counter(), Counter()
    for t in train:
        ws = ["<s>", *words(t), "</s>"]
        one.update(ws[1:])
        two.update(zip(ws, ws[1:]))
        three.update(zip(ws, ws[1:], ws[2:]))
    n, v = sum(one.values()), len(one)

    def discount(c):
        a, b = sum(x == 1 for x in c.values()), sum(x == 2 for x in c.values())
        return min(max(a / (a + 2 * b), 0.1), 0.95) if a + b else 0.5

    d1, d2, d3 = discount(one), discount(two), discount(three)
    heads = dict(one)
    heads["<s>"] = len(train)
    follow = Counter(u for u, _ in two)
    kept = defaultdict(dict)
    for (a, b, c), k in three.items():
        if k >= cutoff:
            kept[a, b][c] = k

    def score(text):
        ws = ["<s>", *words(text), "</s>"]
        base = total = 0.0
        for i in range(1, len(ws)):
            w = ws[i]
            base += math.log10((one[w] + 1) / (n + v + 1))
            p = max(one[w] - d1, 0) / n + d1 * v / n / (v + 1)
            u = ws[i - 1]
            if follow[u]:
                p = max(two[u, w] - d2, 0) / heads[u] + d2 * follow[u] / heads[u] * p
            if i > 1:
                k, c = kept.get((ws[i - 2], u), {}), two[ws[i - 2], u]
                if k:
                    p = (k[w] - d3) / c * (w in k) + (1 - sum(x - d3 for x in k.values()) / c) * p if w in k else (1 - sum(x - d3 for x in k.values()) / c) * p
            total += math.log10(p)
        return len(ws) - 1, sum(one[w] > 0 for w in ws[1:]), base, total

    return score, n


def shingles(text: str | None, n: int = 5) -> frozenset:
    ws = words(text)
    return frozenset(tuple(ws[i : i + n]) for i in range(max(len(ws) - n + 1, 1))) if ws else frozenset()


def components(rows: list[tuple[int, str | None]], n: int = 5, percent: int = 80) -> dict[int, tuple[int, int]]:
    """doc_id -> (set size, smallest id reachable) by all pairs."""
    sets = [(i, shingles(t, n)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[k + 1 :]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def bench_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(text: str | None, items: list[tuple[int, str | None]], n: int = 10) -> tuple[int, set[int], list[int]]:
    """Words, hit positions and items by looking for every window everywhere."""
    ws, hit, found = bench_words(text), set(), set()
    for i, t in items:
        own = bench_words(t)
        m = min(n, len(own))
        windows = {tuple(own[k : k + m]) for k in range(len(own) - m + 1)} if m else set()
        for k in range(len(ws) - m + 1):
            if m and tuple(ws[k : k + m]) in windows:
                hit.update(range(k, k + m))
                found.add(i)
    return len(ws), hit, sorted(found)


def deduplicated(rows: list[tuple[int, str | None]], width: int = 3) -> dict[int, str | None]:
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        lines = (t or "").split("\n")
        full = [k for k, x in enumerate(lines) if x.strip(" \t\r")]
        gone = set()
        for j in range(len(full) - width + 1):
            w = tuple(lines[k].strip(" \t\r") for k in full[j : j + width])
            if w in seen:
                gone.update(full[j : j + width])
            seen.add(w)
        out[i] = t if not gone else "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def mixed(x: int) -> int:
    """The kernels' bijection on Python's own integers."""
    full = (1 << 64) - 1
    x &= full
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & full
    x = (x ^ x >> 27) * 0x94D049BB133111EB & full
    return x ^ x >> 31


def ftrl(rows: list[dict[int, float]], labels: list[int], order, epochs: int, alpha: float, beta: float, l1: float, l2: float) -> dict[int, float]:
    """FTRL-proximal logistic regression, coordinate by coordinate."""
    z, n = {}, {}

    def weight(k: int) -> float:
        if abs(z.get(k, 0.0)) <= l1:
            return 0.0
        return -(z[k] - math.copysign(l1, z[k])) / ((beta + math.sqrt(n[k])) / alpha + l2)

    for _ in range(epochs):
        for d in order.permutation(len(rows)):
            w = {k: weight(k) for k in rows[d]}
            p = 1 / (1 + math.exp(-sum(w[k] * x for k, x in rows[d].items())))
            for k, x in rows[d].items():
                g, before = (p - labels[d]) * x, n.get(k, 0.0)
                z[k] = z.get(k, 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / alpha * w[k]
                n[k] = before + g * g
    return {k: weight(k) for k in z}

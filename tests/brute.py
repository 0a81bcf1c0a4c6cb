"""Plain-Python versions of the point operators, by the reference's loops and rules."""

from __future__ import annotations

import hashlib
import math


def sqd(a, b) -> float:
    """Squared distance, summed left to right from zero like ``Vectors.sqdist``."""
    acc = 0.0
    for x, y in zip(a, b):
        acc = acc + (x - y) * (x - y)
    return acc


def dist(a, b) -> float:
    return math.sqrt(sqd(a, b))


def diameter(coords) -> float:
    best = -1.0
    for i in range(len(coords)):
        for j in range(i + 1, len(coords)):
            d = dist(coords[i], coords[j])
            if d > best:
                best = d
    return best


def average(coords) -> float:
    n = len(coords)
    return sum(dist(coords[i], coords[j]) for i in range(n) for j in range(i + 1, n)) / (n * (n - 1) / 2)


def sample(ids, k: int, seed: int = 42) -> list[int]:
    return sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))[:k]


def farthest_first(points: dict[int, list[float]], k: int, seed: int = 42) -> list[int]:
    ids = sorted(points)
    if not ids:
        return []
    chosen = sample(ids, 1, seed)
    md = {i: dist(points[i], points[chosen[0]]) for i in ids}
    while len(chosen) < k:
        best, far = None, -1.0
        for i in ids:
            if i not in chosen and md[i] > far:
                best, far = i, md[i]
        if best is None:
            break
        chosen.append(best)
        for i in ids:
            d = dist(points[i], points[best])
            if d < md[i]:
                md[i] = d
    return chosen


def greedy(points: dict[int, list[float]], k: int) -> list[int]:
    ids = sorted(points)
    if k >= len(ids):
        return ids
    used: list[int] = []
    for _ in range(k // 2):
        free = [i for i in ids if i not in used]
        pair, far = free[:2], 0.0
        for n, a in enumerate(free):
            for b in free[n + 1 :]:
                d = sqd(points[a], points[b])
                if d > far:
                    pair, far = [a, b], d
        used += pair
    if k % 2:
        used.append(min(i for i in ids if i not in used))
    return used

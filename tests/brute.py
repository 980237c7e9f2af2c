"""The model in plain Python, from its definition, to hold Spark against."""

from __future__ import annotations

import math
import re
from collections import Counter


def kept(lines: list[str], letters: str, stop: set[str]) -> list[tuple[str, str, str, float]]:
    rows = []
    for line in lines:
        fields = line.split("\t")
        count = float(fields[2])
        words = fields[0].rstrip(" ").split(" ")
        if len(words) > 2 and all(re.fullmatch(f"[{letters}]+", w) for w in words):
            if not stop & set(words[:3]):
                rows.append((*words[:3], count))
    return rows


def divide(a: float, b: float) -> float:
    if b:
        return a / b
    return math.nan if a == 0 else math.inf


def weight(n: float) -> float:
    return (math.log(n + 1) + 1) / (math.log(n + 1) + 2)


def model(rows: list[tuple[str, str, str, float]]) -> dict[tuple, dict[str, float]]:
    sums, total = Counter(), 0.0
    for w1, w2, w3, count in rows:
        total += count
        for key in ((w1,), (w2,), (w3,), (w1, w2), (w2, w3), (w1, w2, w3)):
            sums[key] += count
    n = {key: float(math.floor(value / len(key))) for key, value in sums.items()}
    c0 = float(math.floor(total / 3 + 0.5))
    result = {}
    for key in n:
        if len(key) == 3:
            w1, w2, w3 = key
            n1, n2, n3, c1, c2 = n[(w3,)], n[(w2, w3)], n[key], n[(w2,)], n[(w1, w2)]
            k2, k3 = weight(n2), weight(n3)
            p = k3 * divide(n3, c2) + (1 - k3) * k2 * divide(n2, c1) + (1 - k3) * (1 - k2) * divide(n1, c0)
            result[key] = dict(n1=n1, n2=n2, n3=n3, c0=c0, c1=c1, c2=c2, p=p)
    return result

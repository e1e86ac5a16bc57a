"""Similarity of two names, spelled out: what the column expressions are held against."""

import re


def words(name):
    plain = "".join(c for c in name.lower() if not 128 <= ord(c) <= 255)
    return re.sub(r"\W", " ", plain).split()


def common(a, b):
    """Longest common subsequence by the textbook table."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def ratio(a, b):
    total = len(a) + len(b)
    return 100.0 * 2 * common(a, b) / total if total else 100.0


def sort_similarity(a, b):
    if a is None or b is None:
        return 0
    return round(ratio(" ".join(sorted(words(a))), " ".join(sorted(words(b)))))


def set_similarity(a, b):
    if a is None or b is None:
        return 0
    left, right = set(words(a)), set(words(b))
    if not left or not right:
        return 0
    shared = left & right
    if shared in (left, right):
        return 100
    base, one, two = (" ".join(sorted(s)) for s in (shared, left - shared, right - shared))
    one, two = f"{base} {one}".strip(), f"{base} {two}".strip()
    best = ratio(one, two)
    return round(max(best, ratio(base, one), ratio(base, two)) if base else best)

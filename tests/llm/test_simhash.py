import random

import numpy as np
import pytest
import xxhash
from conftest import LONG  # noqa: F401

from clinspark.llm import simhash


def slow_fingerprint(text, n=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one TWO", "Ä b c", "a b c a b c a b c", "x y z " * 500])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_long_text_is_read_in_pieces(monkeypatch):
    whole = simhash.fingerprint(LONG[:60_000])
    monkeypatch.setattr(simhash, "PIECE", 11)
    assert simhash.fingerprint(LONG[:60_000]) == whole == slow_fingerprint(LONG[:60_000])


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_bit_sliced_comparison_finds_all_pairs_in_a_bucket(radius):
    rng = np.random.default_rng(radius)
    fps, starts = [], []
    for size in (1, 2, 64, 65, 300, 3):
        starts.append(len(fps))
        fps.extend(rng.integers(0, 1 << 12, size).tolist())
    fps, starts = np.array(fps, np.uint64), np.array(starts)
    left, right = simhash.compare(fps, starts, list(range(16)), radius)
    bucket = np.searchsorted(starts, np.arange(len(fps)), "right")
    wanted = {
        (i, j)
        for i in range(len(fps))
        for j in range(i + 1, len(fps))
        if bucket[i] == bucket[j] and int(fps[i] ^ fps[j]).bit_count() <= radius
    }
    assert set(zip(left.tolist(), right.tolist(), strict=True)) == wanted


def test_chunks_do_not_matter(monkeypatch):
    fps = np.random.default_rng(0).integers(0, 1 << 10, 700).astype(np.uint64)
    one = simhash.compare(fps, np.array([0]), list(range(16)), 2)
    monkeypatch.setattr(simhash, "CHUNK", 37)
    two = simhash.compare(fps, np.array([0]), list(range(16)), 2)
    pairs = lambda x: sorted(zip(x[0].tolist(), x[1].tolist(), strict=True))
    assert pairs(one) == pairs(two)


def roots(values, radius):
    label = list(range(len(values)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(values)):
        for j in range(i + 1, len(values)):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_links_connect_what_is_near(spark):
    rng = random.Random(4)
    values = set()
    for _ in range(60):
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):  # chains and clusters
            values.add(x)
            for _ in range(rng.randint(1, 3)):
                x ^= 1 << rng.randrange(64)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    for radius in (0, 1, 2):
        found = {r["node"]: r["root"] for r in simhash.components(simhash.links(frame, radius)).collect()}
        groups = {}
        for v, s, r in zip(values, signed, roots(values, radius), strict=True):
            groups.setdefault(r, set()).add(found.get(s, s))
        assert all(len(g) == 1 for g in groups.values())
        assert len({min(g) for g in groups.values()}) == len(groups)
    with pytest.raises(ValueError):
        simhash.links(frame, 4)


def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.createDataFrame([(i * 7919 % n, (i + 1) * 7919 % n) for i in range(n - 1)], "u long, v long")
    found = simhash.components(edges).collect()
    assert len(found) == n and {r["root"] for r in found} == {0}


ROWS = [
    (7, "a b c d e f g h"),
    (3, "A b  c d e f g h"),
    (9, None),
    (4, ""),
    (8, "\t"),
    (1, "quite another text with other words"),
    (1, "quite another text with other words"),
    (None, "a b c d e f g h"),
    (12, LONG),
    (11, LONG + " end"),
]


def test_groups(docs):
    found = simhash.near_groups(docs(*ROWS)).collect()
    assert len(found) == len(ROWS)
    for r in found:
        text = next(t for i, t in ROWS if i == r["doc_id"])
        assert r["fingerprint"] == f"{simhash.fingerprint(text):016x}"
    component = {r["doc_id"]: r["component_id"] for r in found}
    assert component == {7: 3, 3: 3, None: 3, 9: 4, 4: 4, 8: 4, 1: 1, 12: 11, 11: 11}


def test_one_document_of_a_group_stays(clashing):
    frame = clashing(*ROWS, names=("gone", "fp", "component_id", "root", "row_key", "one"))
    out = simhash.without_near_copies(frame)
    assert out.columns == frame.columns
    texts = [int(simhash.fingerprint(r["text"], 3)) for r in out.collect()]
    for i, a in enumerate(texts):  # no two that stay are within the radius
        assert all((a ^ b).bit_count() > 2 for b in texts[i + 1 :])
    # All that went are within reach of one that stays.
    near = {r["component_id"] for r in simhash.near_groups(frame).collect()}
    assert len(texts) == len(near)


def test_rows_that_share_an_id_or_have_none(docs):
    """Each group keeps one row, whatever the ids: a text is not lost because another row has its id."""
    a, b, c = ("alpha beta gamma delta " * 20, "one two three four five " * 20, "red green blue black " * 20)
    rows = [(5, a), (5, b), (3, b), (None, c), (None, c), (9, c), (None, "lone text of no id at all"), (7, a), (7, a)]
    rows += [(None, "same null row")] * 3
    kept = sorted(((r["doc_id"], r["text"]) for r in simhash.without_near_copies(docs(*rows)).collect()), key=str)
    wanted = [(3, b), (5, a), (9, c), (None, "lone text of no id at all"), (None, "same null row")]
    assert kept == sorted(wanted, key=str)


def test_empty_table(docs):
    assert simhash.near_groups(docs()).collect() == []
    assert simhash.without_near_copies(docs()).collect() == []

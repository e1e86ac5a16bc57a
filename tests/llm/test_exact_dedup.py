import hashlib
import random
import re

import pytest
from conftest import LONG  # noqa: F401

from clinspark.llm import exact_dedup


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(norm(text), []).append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = groups[norm(text)]
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        out.append((doc_id, keep, len(ids), doc_id == keep, hashlib.sha256(norm(text).encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [
    (5, "a  b\tc"),
    (3, "a b c"),
    (9, "a b c"),
    (4, None),
    (2, ""),
    (1, " "),
    (7, " "),
    (8, "ünï\n\ncode"),
    (6, "ünï code"),
    (6, "ünï code"),
    (None, "a b c"),
    (None, "alone"),
    (10, LONG),
    (11, LONG.replace(" ", "\n")),
]


@pytest.mark.parametrize("hash_bits", [64, 8, 2, 1])
def test_marks_agree_with_brute_force_and_survive_collisions(docs, hash_bits):
    found = exact_dedup.duplicates(docs(*ROWS), hash_bits).collect()
    assert sorted(map(tuple, found), key=str) == brute(ROWS)


def test_hot_group_goes_to_overflow_pages(docs, spark):
    rows = [(i, "the same") for i in range(400)] + [(1000 + i, f"text {i}") for i in range(300)]
    random.Random(1).shuffle(rows)
    frame = docs(*rows)
    assert sorted(map(tuple, exact_dedup.duplicates(frame).collect()), key=str) == brute(rows)
    index = frame.selectExpr("doc_id", "xxhash64(text) as h")
    slots = exact_dedup.directory(index, 700).collect()
    assert max(s["pages"] for s in slots) == 25  # 400 rows on pages of 16
    assert len({s["bucket"] for s in slots}) > 20


def test_directory_splits_only_overfull_buckets(spark):
    index = spark.range(600).selectExpr("id as doc_id", "xxhash64(id) as h")
    slots = exact_dedup.directory(index, 600).collect()
    held = {}
    for row in index.collect():
        slot = (row["h"] % (1 << 64)) >> 50
        bucket = next(s["bucket"] for s in slots if s["slot"] == slot)
        held[bucket] = held.get(bucket, 0) + 1
    assert max(held.values()) <= exact_dedup.LEAST_CAPACITY
    for s in slots:
        assert s["bucket"] == s["slot"] >> (14 - s["depth"]) << (14 - s["depth"])


def test_empty_table(docs):
    assert exact_dedup.duplicates(docs()).collect() == []
    assert exact_dedup.without_copies(docs()).collect() == []


def test_one_row_per_text_stays_with_its_columns(clashing):
    names = ("h", "norm", "keep_id", "copy_sha", "copy_key", "kept", "sha")
    frame = clashing(*ROWS, names=names)
    kept = exact_dedup.without_copies(frame)
    assert kept.columns == frame.columns
    texts = [norm(r["text"]) for r in kept.collect()]
    assert sorted(texts) == sorted({norm(t) for _, t in ROWS})
    assert {r["doc_id"] for r in kept.collect() if norm(r["text"]) == "a b c"} == {3}
    assert all(r["sha"] == "sha!" for r in kept.collect())


def test_no_python_in_the_plan(docs):
    plan = exact_dedup.duplicates(docs(*ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

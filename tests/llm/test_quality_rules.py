import math
import random
import re
import zlib

import pytest
from conftest import LONG  # noqa: F401

from clinspark.llm import quality_rules as q

SF = "/root/testdata/sf0.01"


def statistics(text):
    """The statistics by other means."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    letters = [c for c in text if c.isalpha()]
    share = lambda a, b: a / b if b else 0.0
    parts = re.split(r"[\x20\x09-\x0D]+", text)
    tokens = re.findall(r"\S+", text)
    marks = [c for c in text if not c.isalpha() and not c.isdecimal() and c not in " \t\n\r\f\v"]
    odd = [c for c in marks if c not in ".,;:?'\"()-"]
    return {
        "log_words": math.log1p(len(words)),
        "word_length": share(len(text), len(words)),
        "line_words": len(words) / (text.count("\n") + 1),
        "different_share": share(len(set(parts)), len(words)),
        "again_share": share(sum(a == b for a, b in zip(tokens, tokens[1:], strict=False)), len(words)),
        "capital_share": share(sum(c.isupper() for c in letters), len(letters)),
        "digit_share": share(sum(c.isdecimal() for c in text), len(text)),
        "mark_share": share(len(marks), len(words)),
        "odd_share": share(len(odd), len(words)),
        "stop_share": share(len(re.findall(r"[.!?]+(?=\s|$)", text)), len(words)),
    }


TEXTS = [None, "", " ", "One two two, THREE!", "a a a a\nb b", "1 2 3 %% $$ x|y", "Ünï cödé. So?", "w " * 9000, LONG]


def test_statistics(docs):
    found = q.with_statistics(docs(*enumerate(TEXTS))).collect()
    for r in found:
        wanted = statistics(TEXTS[r["c0"]])
        for name in q.STATISTICS:
            assert r[name] == pytest.approx(wanted[name]), (name, r["c1"] and r["c1"][:20])


def test_score_is_the_weighed_sum_of_rules(docs):
    model = q.RuleModel(
        0.25, [((("capital_share", False, 0.1), ("log_words", True, 1.5)), -2.0), ((("odd_share", True, 0.0),), 1.5)]
    )
    found = q.scored(docs(*enumerate(TEXTS)), model).collect()
    for r in found:
        s = statistics(TEXTS[r["doc_id"]])
        total = 0.25 - 2.0 * (s["capital_share"] > 0.1 and s["log_words"] <= 1.5) + 1.5 * (s["odd_share"] <= 0.0)
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-total)))
    constant = q.scored(docs(*enumerate(TEXTS)), q.RuleModel(0.0)).collect()
    assert {r["score"] for r in constant} == {0.5}


def test_paths_keep_the_tightest_bounds():
    path = [("a", True, 3.0), ("b", False, 1.0), ("a", True, 2.0), ("b", False, 4.0), ("a", False, 0.0)]
    assert q._tightest(path) == (("a", False, 0.0), ("a", True, 2.0), ("b", False, 4.0))


def made(n):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(rng.randint(20, 60))]
        good = rng.random() < 0.7
        text = " ".join(words) + "."
        if not good:
            text = rng.choice([text.upper(), " ".join(w + "%%" for w in words), " ".join(w for w in words[:5] for _ in range(9))])
        rows.append((i, text))
        labels.append((i, int(good), 0))
    return rows, labels


def test_learns_only_from_rows_that_are_not_held_out(spark, docs):
    rows, labels = made(600)
    out = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    turned = [(i, 1 - quality if i in out else quality, t) for i, quality, t in labels]
    schema = "doc_id long, quality int, toxic int"
    frame = docs(*rows)
    model = q.fit(frame, spark.createDataFrame(labels, schema))
    again = q.fit(frame.repartition(5), spark.createDataFrame(turned, schema).repartition(3))
    assert model == again
    assert 0 < len(model.rules) < 100
    right = {i: quality for i, quality, _ in labels}
    scores = q.scored(frame, model).collect()
    hits = [(r["score"] >= 0.3) == right[r["doc_id"]] for r in scores if r["doc_id"] in out]
    assert sum(hits) / len(hits) > 0.95


def test_one_class_none_nulls_and_clashing_names(spark, docs, clashing):
    schema = "doc_id long, quality int, toxic int, extra string"
    frame = clashing((1, "a b"), (2, None), (3, ""), (None, "x"), (4, "y"), (4, "y"), names=("label", "words", "score", "c0"))
    labels = lambda *rows: spark.createDataFrame([(*r, 0, "e") for r in rows], schema)
    for rows, wanted in (((), 0.5), (((2, 1), (3, 1), (4, None), (None, 0)), 0.95), (((2, 0), (4, 0)), 0.05)):
        found = q.scored(frame, q.fit(frame, labels(*rows))).collect()
        assert len(found) == 6
        assert {round(r["score"], 6) for r in found} == {wanted}
    kept = q.accepted(frame, q.RuleModel(3.0), 0.3)
    assert kept.columns == frame.columns and kept.count() == 6
    assert {r["label"] for r in kept.collect()} == {"label!"}
    assert q.accepted(frame, q.RuleModel(-3.0), 0.3).count() == 0
    empty = frame.where("false")
    assert q.scored(empty, q.fit(empty, labels())).collect() == []
    both = q.fit(frame, labels((2, 0), (3, 1), (4, 1), (4, 0)))  # too few rows to tell them apart
    assert q.scored(frame, both).count() == 6


def test_held_out_accuracy_on_the_given_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = q.scored(docs, q.fit(docs, labels)).join(labels, "doc_id").collect()
    held = [r for r in scores if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    right = sum((r["score"] >= 0.3) == bool(r["quality"]) for r in held)
    assert len(held) > 50 and right / len(held) > 0.95


def test_long_runs_take_linear_time(docs):
    """Runs of marks, blanks, letters and one repeated word, a million of each."""
    import time

    runs = ["." * 1_000_000 + "a", "?!" * 500_000 + " x", " " * 1_000_000, "x" * 1_000_000, "ab " * 300_000, "\n" * 1_000_000]
    frame = docs(*enumerate(runs))
    q.with_statistics(docs((1, "a"))).collect()
    begin = time.perf_counter()
    rows = q.with_statistics(frame).collect()
    assert len(rows) == len(runs) and time.perf_counter() - begin < 20


def test_an_id_that_many_documents_have_is_one_row(spark, docs):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5 != 0]
    good, poor = "A plain sentence with several words in it. " * 8, "$$ ## @@ 11 " * 9
    rows = [(i, good if i % 2 else poor) for i in ids] + [(ids[0], poor + str(n)) for n in range(200)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in ids], "doc_id long, quality int, toxic int")
    model = q.fit(docs(*rows), labels)
    again = q.fit(docs(*rows).repartition(7), labels)
    assert model == again


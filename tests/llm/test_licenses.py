import random
import textwrap

import pytest
from conftest import LONG  # noqa: F401
from pyspark.sql import functions as F

from clinspark.llm import licenses

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(corpus):
    return licenses.fit(corpus)


def test_finds_every_notice_and_nothing_else(corpus, model):
    found = {(r["doc_id"], r["line"]): r for r in licenses.scan(corpus, model).collect()}
    wanted = {}
    for r in corpus.collect():
        for i, line in enumerate((r["text"] or "").split("\n")):
            if "licen" in line.lower():
                wanted[r["doc_id"], i] = line
    assert found.keys() == wanted.keys()
    texts = {r["doc_id"]: r["text"] for r in corpus.collect()}
    for key, r in found.items():
        assert texts[key[0]][r["begin"] : r["end"]] == wanted[key]
        assert r["confirmed"] and r["similarity"] == 1.0 and r["probability"] >= 0.5
        name = r["family"].split("-")[0]
        assert {"GPL": "GNU"}.get(name, name) in wanted[key]


def test_damaged_templates(docs, model):
    rng = random.Random(3)
    rows, families = [], {}
    for i, (family, text) in enumerate(licenses.TEMPLATES):
        words = text.split()
        if len(words) >= 12:
            words[0] = "xx"  # at most one of eight shingles is lost
        rows.append((i, "Ordinary words come first.\n" + " ".join(words).upper() + " " + "tail " * rng.randint(0, 4)))
        families[i] = family
    found = {r["doc_id"]: r for r in licenses.scan(docs(*rows), model).collect()}
    right = [i for i, f in families.items() if i in found and found[i]["claim"] == f and found[i]["confirmed"]]
    assert len(right) >= len(rows) - 2


def test_similar_but_unknown_licence_is_not_confirmed(docs, model):
    text = "Licensed under the Imaginary Public License of the moon, version 12, all terms apply"
    for r in licenses.scan(docs((1, text)), model).collect():
        assert (r["family"], r["confirmed"]) == (licenses.UNKNOWN, False)


def test_common_words_do_not_hide_exact_notices(docs):
    rows = [(i, "\n".join(f"licensed under {i} {j} words of ordinary text" for j in range(20))) for i in range(40)]
    rows.append((99, "Licensed under CC BY-NC 4.0"))
    corpus = docs(*rows)
    found = licenses.scan(corpus, licenses.fit(corpus)).where("doc_id = 99").collect()
    assert [(r["similarity"], r["confirmed"]) for r in found] == [(1.0, True)]


def test_a_required_word_is_in_all_that_can_be_confirmed():
    for _, text in licenses.TEMPLATES:
        wanted = set(licenses._shingles(text))
        without = [s for s in wanted if licenses.required_word(text) not in s.split()]
        assert len(without) / len(wanted) < licenses.LEAST_SIMILARITY


def test_wrapped_notices_in_comments(docs, model):
    rows, wanted = [], set()
    for i, (family, text) in enumerate(licenses.TEMPLATES):
        mark = (" * ", "# ", "dnl ", "")[i % 4]
        lines = textwrap.wrap(text, 36)
        rows.append((i, "\n".join(["ordinary words", mark, *(mark + w for w in lines), mark, "more of them"])))
        wanted.add((i, 2, 1 + len(lines), family))
    found = licenses.scan(docs(*rows), model).collect()
    assert {(r["doc_id"], r["line"], r["last_line"], r["family"]) for r in found} == wanted
    texts = dict(rows)
    for r in found:
        assert texts[r["doc_id"]].split("\n")[r["line"] : r["last_line"] + 1] == texts[r["doc_id"]][r["begin"] : r["end"]].split("\n")


class Fixed(licenses.LicenceModel):
    """Claims the LGPL with 0.45, the GPL with 0.40."""

    def claims(self, paragraphs):
        spread = {"claim": "LGPL", "probability": 0.45, "licence_probability": 0.85}
        return paragraphs.withColumns({k: licenses.F.lit(v) for k, v in spread.items()})


def test_a_licence_between_families_is_unknown_and_a_sibling_verbatim_is_confirmed(docs, model):
    fixed = Fixed(model.classes, model.regression, model.temperature)
    gpl = next(t for f, t in licenses.TEMPLATES if f == "GPL")
    found = licenses.scan(docs((1, "licensed under some public license of ours"), (2, gpl)), fixed).collect()
    assert {r["doc_id"]: (r["family"], r["confirmed"]) for r in found} == {1: ("unknown", False), 2: ("GPL", True)}


def test_nulls_repeats_long_texts_and_clashing_names(clashing, model):
    notice = "Released under the MIT License."
    names = ("words", "lines", "paragraph", "claim", "features", "grams", "line")
    frame = clashing(
        (1, notice), (1, notice), (2, None), (3, ""), (None, f"x\n{notice}"), (5, f"{LONG}\n{notice}\n{LONG}"), (6, "Die mit und"),
        names=names,
    )
    found = licenses.scan(frame, model).collect()
    assert sorted(((r["doc_id"] or 0, r["line"], r["family"]) for r in found)) == [
        (0, 1, "MIT"),
        (1, 0, "MIT"),
        (1, 0, "MIT"),
        (5, 1, "MIT"),
    ]


def test_empty_table(docs, model):
    assert licenses.scan(docs(), model).collect() == []
    trained = licenses.fit(docs())  # no ordinary text to learn from
    assert licenses.scan(docs(), trained).collect() == []
    assert [r["family"] for r in licenses.scan(docs((1, "Released under the MIT License.")), trained).collect()] == ["MIT"]


def test_no_python_in_the_plan(corpus, model):
    plan = licenses.scan(corpus, model)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_text_of_very_many_telling_lines(docs):
    """Offsets of 100,000 lines take time in proportion to the text."""
    import time

    lines = ["Licensed under the MIT License" if i % 2 else "licensed somehow" for i in range(100_000)]
    frame = docs((1, "\n".join(lines)), (2, "plain text of no kind")).withColumn("uid", F.col("doc_id"))
    begin = time.perf_counter()
    found = licenses.lines_of(frame, licenses.telling_words())
    row = found.agg(F.count("*").alias("n"), F.max("end").alias("end"), F.sum("begin").alias("begins")).first()
    starts, at = 0, 0
    for line in lines:
        starts, at = starts + at, at + len(line) + 1
    assert (row["n"], row["end"], row["begins"]) == (100_000, at - 1, starts)
    assert time.perf_counter() - begin < 30


class Everywhere(licenses.LicenceModel):
    """Sees a licence in each line."""

    def claims(self, paragraphs):
        spread = {"claim": "MIT", "probability": 0.6, "licence_probability": 0.9}
        return paragraphs.withColumns({k: F.lit(v) for k, v in spread.items()})


def test_lines_without_a_telling_word_are_scored_too(docs, model):
    seen = Everywhere(model.classes, model.regression, model.temperature)
    frame = docs((1, "Free for all\n\n * \nto use and to share"), (2, ""), (3, None), (4, "plain words"))
    found = licenses.scan(frame, seen).collect()
    lines = {(r["doc_id"], r["line"], r["begin"], r["end"], r["family"]) for r in found}
    assert lines == {(1, 0, 0, 12, "unknown"), (1, 3, 18, 37, "unknown"), (4, 0, 0, 11, "unknown")}


def test_unseen_words_say_nothing(docs, model):
    rows = [(i, " ".join(f"{a}{b}{i}" for a in ("erne", "thon", "gezu", "cion") for b in range(150))) for i in range(40)]
    assert licenses.scan(docs(*rows), model).collect() == []

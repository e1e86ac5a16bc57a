import random
import zlib

import pytest
from conftest import LONG  # noqa: F401

from clinspark.llm import language

SF = "/root/testdata/sf0.01"


def slow_phrases(text, sample):
    """Greedy longest phrases of ``text`` that occur in ``sample``, in pieces of the fixed length."""
    count = 0
    for a in range(0, len(text), language.PIECE):
        piece = text[a : a + language.PIECE]
        at = 0
        while at < len(piece):
            end = at + 1
            while end < len(piece) and piece[at : end + 1] in sample:
                end += 1
            if piece[at:end] not in sample:
                end = at + 1  # a symbol never seen
            count += 1
            at = end
    return count


def test_phrases_agree_with_a_search_of_the_sample():
    rng = random.Random(5)
    samples = {n: "".join(rng.choices(a + " ", k=400)) for n, a in (("x", "abc"), ("y", "bcde"))}
    samples = {n: " ".join(s.split()) for n, s in samples.items()}
    model = language.CrossParser.fit(samples)
    texts = ["".join(rng.choices("abcdefg", k=k)) for k in (1, 2, 30, 255, 256, 257, 900)] + ["zzz", "a b c"]
    found = model.phrases([model.alphabet.symbols(t) for t in texts])
    for row, text in zip(found.tolist(), texts, strict=True):
        assert row == [slow_phrases(text, samples[n]) for n in model.languages]


def test_a_text_does_not_depend_on_its_batch():
    model = language.CrossParser.fit({"x": "the cat and the dog", "y": "der hund und die katze"})
    texts = ["the dog", "die katze und der hund " * 60, "cat", ""]
    alone = [model.classify([t]) for t in texts]
    together = model.classify(texts)
    assert [a[0][0] for a in alone] == together[0] == ["x", "y", "x", "und"]
    assert [a[1][0] for a in alone] == together[1]


def test_symbols():
    alphabet = language.Alphabet(["Ab é"])
    a, b, e, other = 1, 2, 3, 4
    assert alphabet.symbols("a, 12 B!!é𝒳🙂ß").tolist() == [a, 0, b, 0, e, other, 0, other]
    assert alphabet.symbols("").tolist() == []


def test_learns_from_labelled_rows_only(docs):
    out = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    learn = [i for i in range(400) if i not in out]
    rows = [(i, "the cat and the dog run", "en") if i % 2 else (i, "der hund und die katze", "de") for i in learn]
    rows += [(i, "zut alors", "fr") for i in out]
    rows += [(1000, "no label here", None), (None, "alors", "fr"), (1001, "123 !", "xx"), (1002, None, "yy")]
    frame = docs(*[(*r, "s") for r in rows])
    model = language.learn(frame)
    assert sorted(model.languages) == ["de", "en"]
    found = {r["doc_id"]: r for r in language.predict(frame, model).collect()}
    assert all(found[i]["lang_pred"] == ("en" if i % 2 else "de") for i in learn)
    assert all(0 < found[i]["score"] <= 1 for i in learn)
    for i in (1001, 1002):
        assert (found[i]["lang_pred"], found[i]["score"]) == ("und", 0.0)


def test_a_shared_header_does_not_hide_the_language(docs):
    header = "0 " * 600 + "the cat and the dog run over the hill " * 40
    rows = [(i, header + "le chat et le chien courent sur la colline " * 80, "fr", "s") for i in range(40)]
    rows += [(100 + i, "the cat and the dog run over the hill " * 80, "en", "s") for i in range(60)]
    model = language.learn(docs(*rows))
    assert [r["lang_pred"] for r in language.predict(docs((1, "le chien et le chat")), model).collect()] == ["fr"]


def test_nulls_empty_tables_and_clashing_names(clashing):
    frame = clashing(
        (1, "the cat", "en"), (1, "the cat", "en"), (2, None, "en"), (3, "", None), (None, "x", None), (4, LONG, "en"),
        names=("lang_pred", "score", "mark"),
    )
    model = language.learn(frame)
    assert len(language.predict(frame, model).collect()) == 6
    empty = frame.where("false")
    nothing = language.learn(empty)
    assert nothing.languages == []
    assert language.predict(empty, model).collect() == []
    assert {r["lang_pred"] for r in language.predict(frame, nothing).collect()} == {"und"}


def test_held_out_accuracy_on_the_given_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.learn(docs)
    rows = language.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) >= 0.97


@pytest.mark.parametrize("sequence", [[], [1], [1, 1, 1], [1, 2, 1, 2, 2, 1]])
def test_automaton_accepts_exactly_the_parts_of_its_text(sequence):
    moves = language.automaton(sequence)

    def known(part):
        state = 0
        for c in part:
            if c not in moves[state]:
                return False
            state = moves[state][c]
        return True

    parts = {tuple(sequence[a:b]) for a in range(len(sequence) + 1) for b in range(a, len(sequence) + 1)}
    from itertools import product

    for n in range(len(sequence) + 2):
        for word in product([1, 2], repeat=n):
            assert known(word) == (word in parts)

import random

from conftest import LONG  # noqa: F401

from clinspark.llm import repeats


def brute(rows, min_words):
    """Stretches by a walk over all documents in order of their ids."""
    rows = [r for r in rows if r[0] is not None]
    keeper = {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        for _, _, words in repeats.units(text or ""):
            keeper.setdefault(tuple(words), doc_id)
    out = []
    for doc_id, text in rows:
        seen, run = set(), []
        marks = []
        for begin, end, words in repeats.units(text or ""):
            key = tuple(words)
            marks.append((begin, end, len(words), keeper[key], keeper[key] != doc_id or key in seen))
            seen.add(key)
        for mark in [*marks, (0, 0, 0, 0, False)]:
            if mark[4]:
                run.append(mark)
            elif run:
                n = sum(m[2] for m in run)
                if n >= min_words:
                    out.append((doc_id, run[0][0], run[-1][1], len(run), n, min(m[3] for m in run)))
                run = []
    return sorted(out)


def sentence(rng):
    return " ".join("".join(rng.choices("abcdefgh", k=4)) for _ in range(rng.randint(3, 12))) + rng.choice(".?!")


def test_units_cover_the_words_with_their_offsets():
    text = "  One two.  Three!? four\nfive... six v1.2 e.g. x\n\n  \nseven"
    found = list(repeats.units(text))
    assert [text[a:b] for a, b, _ in found] == ["One two.", "Three!? four", "five... six v1.2 e.g.", "x", "seven"]
    assert [w for _, _, ws in found for w in ws] == text.lower().split()


def test_stretches_agree_with_a_walk(docs):
    rng = random.Random(8)
    passages = [" ".join(sentence(rng) for _ in range(8)) for _ in range(4)]
    rows = []
    for i in range(120):
        parts = [rng.choice([" ", "\n"]).join(sentence(rng) for _ in range(5)) for _ in range(3)]
        if rng.random() < 0.4:
            parts.insert(rng.randint(0, 3), rng.choice(passages))
        rows.append((1000 - i, rng.choice([" ", "\n"]).join(parts)))
    rows += [(5, rows[0][1]), (6, rows[0][1].upper()), (7, None), (8, ""), (9, LONG), (10, LONG), (11, "short one. " * 30)]
    for least in (1, 25, 60):
        found = repeats.stretches(docs(*rows), least).select("doc_id", "begin", "end", "n_units", "n_words", "keep_id")
        assert sorted(map(tuple, found.collect())) == brute(rows, least)


def test_a_passage_inside_another_line_is_found(docs):
    rng = random.Random(1)
    passage = " ".join(sentence(rng) for _ in range(12))
    rows = [(1, f"{sentence(rng)}\n{passage}\n{sentence(rng)}"), (2, f"begins here {passage} goes on. {sentence(rng)}")]
    found = repeats.stretches(docs(*rows)).collect()
    assert [r["doc_id"] for r in found] == [2] and found[0]["keep_id"] == 1
    assert rows[1][1][found[0]["begin"] : found[0]["end"]].count(" ") > 30


def test_a_passage_cut_mid_sentence_keeps_its_halves(docs):
    passage = "one two three four five. Six seven eight. Nine ten eleven twelve"
    rows = [(1, f"Alpha {passage} omega."), (2, f"Beta {passage} end."), (3, f"Gamma. {passage}. Delta"), (4, "alone here.\nSix seven eight.")]
    found = {r["doc_id"]: r for r in repeats.passages(docs(*rows)).collect()}
    assert found.keys() == {2, 3, 4}
    for i, words in ((2, passage), (3, passage.rsplit(" ", 1)[0]), (4, "Six seven eight.")):
        r = found[i]
        assert (rows[i - 1][1][r["begin"] : r["end"]], r["n_words"], r["keep_id"]) == (words, len(words.split()), 1)
    assert [r["doc_id"] for r in repeats.passages(docs(*rows), 12).collect()] == [2]
    left = {r["doc_id"]: r["text"] for r in repeats.without_repeats(docs(*rows)).collect()}
    assert left == {1: rows[0][1], 2: "Beta  end.", 3: "Gamma.  twelve. Delta", 4: "alone here.\n"}


def test_a_unit_kept_for_others_is_not_cut(docs):
    text = "p z.\nq z.\nq z."
    assert repeats.without_repeats(docs((1, text))).first()["text"] == "p z.\nq z.\n"


def test_cut_texts_and_what_is_kept(clashing):
    rng = random.Random(2)
    passage = "\n".join(sentence(rng) for _ in range(10))
    rows = [(3, f"first.\n{passage}"), (4, f"before\n{passage}\nafter ünï"), (5, passage), (6, None), (7, "alone"), (None, passage)]
    frame = clashing(*rows, names=("cuts", "digest", "unit", "begin", "keep_id"))
    out = repeats.without_repeats(frame)
    assert out.columns == [*frame.columns, "kept_spans"]
    found = {r["doc_id"]: r for r in out.collect()}
    assert found[3]["text"] == rows[0][1] and found[4]["text"] == "before\n\nafter ünï"
    assert found[5]["text"] == "" and found[6]["text"] is None and found[7]["text"] == "alone"
    assert found[None]["text"] == passage
    for i, text in rows:
        if text is not None:
            assert "".join(text[s["begin"] : s["end"]] for s in found[i]["kept_spans"]) == found[i]["text"]


def test_rows_of_one_id_count_as_one_document(docs):
    text = " ".join(f"w{i}" for i in range(40))
    assert repeats.stretches(docs((1, text), (1, text))).collect() == []
    assert [r["doc_id"] for r in repeats.stretches(docs((1, text), (2, text), (2, text))).collect()] == [2]


def test_empty_table(docs):
    assert repeats.stretches(docs()).collect() == []
    assert repeats.without_repeats(docs()).collect() == []

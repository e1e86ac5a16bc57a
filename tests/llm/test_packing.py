import os
import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import LONG
from hypothesis import given, settings
from hypothesis import strategies as st

from clinspark.llm import packing

os.environ["TOKENIZERS_PARALLELISM"] = "false"
public_tokenizers = pytest.importorskip("public_tokenizers")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")

TEXTS = [
    "",
    None,
    " ",
    "Plain words, some's ends. And\nlines\r\n\ttabs  two",
    "<|endoftext|> and <|endoftext|>x foo<|startoftext|>! <|>",
    "Straße ÉCOLE İstanbul ΣΊΣΥΦΟΣ 数字 🙂 emoji🙂",
    "l'eau 'tis we'll 123 4567 a1b2 a-b $$$ x$$$ naïve...",
    "\x1c odd \x85 controls \x00 end",
    "é ́x Å ﬁ",
    "x" * 5000,
]

ANY_TEXT = st.text(
    alphabet=st.one_of(st.sampled_from(" \n\t'.,aAÉß1<|>́\x1c "), st.characters(exclude_categories=["Cs"])), max_size=40
)


@settings(max_examples=500, deadline=None)
@given(st.lists(ANY_TEXT, max_size=4))
def test_words_are_encoded_as_in_their_text(texts):
    tool = packing.encoder(WORD_BPE)
    assert tool.by_word
    found = [np.frombuffer(x, tool.id_type).tolist() for x in tool.encode(texts)]
    assert found == [tool.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_other_tokenizers_get_whole_texts():
    tool = packing.encoder(BYTE_BPE)
    assert not tool.by_word
    texts = [t or "" for t in TEXTS]
    found = [np.frombuffer(x, tool.id_type).tolist() for x in tool.encode(texts)]
    assert found == [tool.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=300))
def test_tree_finds_the_first_bin_with_room(sizes):
    room, wanted = [], []
    for size in sizes:
        place = next((i for i, r in enumerate(room) if r >= size), len(room))
        if place == len(room):
            room.append(50)
        room[place] -= size
        wanted.append(place)
    assert packing.first_fit(sizes, 50) == wanted


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 63), max_size=60), st.integers(0, 5))
def test_gaps_are_closed_without_losing_an_id(sizes, slack):
    places = packing.first_fit(sorted(sizes, reverse=True), 64)
    bins = [[] for _ in range(max(places, default=-1) + 1)]
    for owner, (place, size) in enumerate(zip(places, sorted(sizes, reverse=True), strict=True)):
        bins[place].append((owner, 0, size))
    found = packing.close_gaps(bins, 64, slack)
    seen = defaultdict(list)
    for pieces in found:
        fill = sum(p[2] for p in pieces)
        assert 0 < fill <= 64 and all(p[2] > 0 for p in pieces)
        assert 64 - fill <= slack or fill & (fill - 1) == 0
        for owner, start, size in pieces:
            seen[owner].extend(range(start, start + size))
    assert [sorted(seen[i]) for i in range(len(sizes))] == [list(range(s)) for s in sorted(sizes, reverse=True)]


def check(found, rows, length, end_id=2):
    """Every id of every document in exactly one piece; sequences without gaps and almost without padding."""
    tokenizer = packing.encoder(WORD_BPE).tokenizer
    by_sequence, pieces = defaultdict(list), defaultdict(list)
    for r in found:
        assert r["length"] == len(r["ids"]) > 0
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        by_sequence[r["sequence_id"]].append(r)
        pieces[r["doc_id"]].append((r["start"], r["doc_tokens"], tuple(r["ids"])))
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    encoded = {t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, end_id] for t in {t for _, t in rows}}
    wanted = defaultdict(list)
    for doc_id, text in rows:
        wanted[doc_id].append(encoded[text])
    assert set(pieces) == set(wanted)
    for doc_id, copies in wanted.items():
        # Documents that share an id: every id at every place as often as the documents have it.
        cells = sorted((s + i, n, x) for s, n, ids in pieces[doc_id] for i, x in enumerate(ids))
        assert cells == sorted((i, len(ids), x) for ids in copies for i, x in enumerate(ids))
    total = sum(r["length"] for r in found)
    assert padding <= 0.004 * total + packing.SLACK * len(by_sequence)
    return by_sequence


def test_all_documents_are_packed(docs, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_DOCS", 100)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, f"text {i} " * (i % 90)) for i in range(400)]
    rows += [(None, "no id"), (None, None), (7, "other text"), (7, "other text"), (900, LONG), (-1, "x")]
    found = packing.pack(docs(*rows), WORD_BPE, ids=True).collect()
    by_sequence = check(found, rows, packing.LENGTH)
    whole = sum(len(r["ids"]) for r in found) / packing.LENGTH
    assert len(by_sequence) < whole + 13 * 6


def test_short_sequences_of_other_end(clashing):
    rows = [(i, "word " * i) for i in range(40)]
    frame = clashing(*rows, names=("ids", "grp", "start", "size"))
    found = packing.pack(frame, WORD_BPE, end_id=49407, length=16, ids=True).collect()
    check(found, rows, 16, 49407)
    assert packing.pack(frame.where("false"), WORD_BPE).collect() == []


def test_a_third_of_the_rows_without_id(docs):
    rows = [(None if i % 3 == 0 else i, "same text here") for i in range(600)]
    frame = docs(*rows).repartition(4)
    check(packing.pack(frame, WORD_BPE, ids=True).collect(), rows, packing.LENGTH)

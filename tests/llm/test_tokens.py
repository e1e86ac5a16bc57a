import os
import re
import zlib

import numpy as np
import pytest
from conftest import LONG  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from clinspark.llm import pieces, token_files

os.environ["TOKENIZERS_PARALLELISM"] = "false"
public_tokenizers = pytest.importorskip("public_tokenizers")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

TEXTS = [
    "",
    " ",
    "a",
    "plain words, some's ends. And\nlines",
    "two  spaces and\ttabs \n mixed  ",
    " leading",
    "nbsp here  and there",
    "<|endoftext|> and <|endoftext|>x",
    "naïve Straße 数字 🙂 emoji🙂",
    "it's we'll 'tis 123 4567 a1b2",
    "\x1c odd \x85 controls \x00 end",
    "already ▁ marked ▁▁ text",
    "trailing ",
    "\n\n",
    "x" * 5000,
]

ANY_TEXT = st.text(
    alphabet=st.one_of(st.sampled_from(" \n\t'.,ab1é▁ "), st.characters(exclude_categories=["Cs"])), max_size=40
)


@settings(max_examples=400, deadline=None)
@given(ANY_TEXT)
def test_words_are_encoded_as_in_their_text(text):
    tool = token_files.encoder(BYTE_BPE)
    found = np.frombuffer(next(iter(tool.encode([text]))), tool.id_type)
    assert found.tolist() == tool.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\t\x0b\x1c\x85\xa0\u2003\u3000aé1", min_size=1, max_size=8))
def test_lone_blanks(text):
    words = re.split(r"\s", text)
    assert token_files.lone_blanks(text) == all(words)


def test_words_are_remembered_over_two_generations(monkeypatch):
    monkeypatch.setattr(token_files, "CACHED_WORDS", 40)
    tool = token_files.WordEncoder(BYTE_BPE)
    for round_ in range(6):
        texts = [" ".join(f"word{'abcdefghij'[(i * 7 + round_) % 10]}{'xyz' * (i % 9)}, and" for i in range(30)), "and wordaxyz again"]
        for text, ids in zip(texts, tool.encode(texts), strict=True):
            found = np.frombuffer(ids, tool.id_type).tolist()
            assert found == tool.tokenizer.encode(text, add_special_tokens=False).ids
        assert len(tool.known) <= 40 + 100 and len(tool.before) <= 40 + 100


@settings(max_examples=400, deadline=None)
@given(ANY_TEXT)
def test_pieces_are_those_of_the_library(text):
    tool = pieces.encoder(PIECES)
    ids, begins, ends = next(iter(tool.encode([text])))
    assert ids.tolist() == tool.library.encode(text, add_eos=True)
    data = text.encode()
    assert begins.tolist()[0] == 0 and ends.tolist()[-1] == len(data)
    for i, a, b in zip(ids.tolist()[:-1], begins, ends, strict=False):
        piece = tool.library.id_to_piece(i)
        if tool.library.is_byte(i):
            assert data[a:b] == bytes([int(piece[3:5], 16)])
        elif "▁" not in text:
            assert data[a:b].decode() in (piece.replace("▁", " "), piece.replace("▁", " ")[1:])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 300), st.integers(0, (1 << 32) - 1)), max_size=30), max_size=6))
def test_packing_round_trip(rows):
    counts = np.array([len(r) for r in rows], np.int64)
    control, quads, data, ends = token_files.pack(np.array([x for r in rows for x in r], np.uint32), counts)
    assert quads.tolist()[-1] == len(control) and ends.tolist()[-1] == len(data)
    for i, row in enumerate(rows):  # each document's bytes can be read by themselves
        mine = control[quads[i] : quads[i + 1]], data[ends[i] : ends[i + 1]]
        assert token_files.unpack(*mine, counts[i : i + 1]).tolist() == row
    found = token_files.unpack(control, data, np.array([len(r) for r in rows], np.int64))
    assert found.tolist() == [x for r in rows for x in r]


def test_files_hold_the_ids_in_order(docs):
    rows = [(1000 - 7 * i, t) for i, t in enumerate(TEXTS)] + [(3, None), (5000, LONG), (4, "same"), (4, "same")]
    manifest, by_rank = token_files.write(docs(*rows), BYTE_BPE)
    found = sorted(token_files.read(manifest, by_rank, ids=True).collect(), key=lambda r: r["start"])
    tokenizer = token_files.encoder(BYTE_BPE).tokenizer
    start = 0
    assert [r["doc_id"] for r in found] == sorted(i for i, _ in rows)
    texts = dict(rows)
    for r in found:
        ids = [*tokenizer.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids, 0]
        assert r["ids"] == ids
        assert (r["start"], r["n_tokens"]) == (start, len(ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert sum(r["n_docs"] for r in manifest.collect()) == len(rows)


def test_a_third_of_the_rows_share_an_id(docs):
    """Rows without id and rows of one id are dealt over several files, and all are read back."""
    rows = [(None if i % 3 == 0 else 500 if i % 3 == 1 else i, f"text {i % 7}") for i in range(900)]
    manifest, by_rank = token_files.write(docs(*rows).repartition(5), BYTE_BPE)
    files = manifest.collect()
    assert max(r["n_docs"] for r in files) < 500
    found = sorted(token_files.read(manifest, by_rank, ids=True).collect(), key=lambda r: r["start"])
    order = lambda i: -(1 << 63) if i is None else i
    assert [r["doc_id"] for r in found] == sorted((i for i, _ in rows), key=order)
    assert [r["start"] for r in found] == np.cumsum([0, *(r["n_tokens"] for r in found[:-1])]).tolist()
    tokenizer = token_files.encoder(BYTE_BPE).tokenizer
    wanted = [(order(i), [*tokenizer.encode(t, add_special_tokens=False).ids, 0]) for i, t in rows]
    assert sorted((order(r["doc_id"]), r["ids"]) for r in found) == sorted(wanted)


def test_columns_with_clashing_names(clashing):
    frame = clashing((1, "a b"), (2, None), names=("ids", "salt", "n", "file_no"))
    manifest, by_rank = token_files.write(frame, BYTE_BPE)
    found = token_files.read(manifest, by_rank).collect()
    assert sorted((r["doc_id"], r["n_tokens"]) for r in found) == [(1, 3), (2, 1)]


def test_ranks_follow_the_counts(docs):
    frame = docs((1, "a a a a b"), (2, " b b"))
    ids = token_files.encoded(frame, BYTE_BPE, 0)
    found = {r["id"]: r["rank"] for r in token_files.frequency_ranks(ids).collect()}
    tokenizer = token_files.encoder(BYTE_BPE).tokenizer
    counts = {}
    for text in ("a a a a b", " b b"):
        for i in [*tokenizer.encode(text, add_special_tokens=False).ids, 0]:
            counts[i] = counts.get(i, 0) + 1
    assert sorted(found, key=found.get) == sorted(counts, key=lambda i: (-counts[i], i))


def test_empty_table_null_id_and_other_end_id(docs):
    manifest, by_rank = token_files.write(docs(), BYTE_BPE)
    assert token_files.read(manifest, by_rank).collect() == []
    manifest, by_rank = token_files.write(docs((None, "x"), (-5, "y")), BYTE_BPE, end_id=50256)
    found = sorted(token_files.read(manifest, by_rank, ids=True).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == [None, -5]
    assert all(r["ids"][-1] == 50256 for r in found)


def test_encode_and_decode(clashing):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100, None), (100, "again"), (101, LONG[:200_000]), (None, "n")]
    frame = clashing(*rows, names=("ids", "begins", "ends", "decoded"))
    found = pieces.encode(frame, PIECES)
    library = pieces.encoder(PIECES).library
    wanted = sorted((i if i is not None else -1, library.encode(t or "", add_eos=True)) for i, t in rows)
    got = found.collect()
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["ids"]) for r in got) == wanted
    assert all(r["decoded"] == library.decode(r["ids"]) for r in got)
    assert all(len(r["ids"]) == len(r["begins"]) == len(r["ends"]) for r in got)
    back = {r["doc_id"]: r["text"] for r in pieces.decode(found.where("doc_id < 50"), PIECES).collect()}
    assert back == {i: library.decode(library.encode(t)) for i, t in enumerate(TEXTS)}
    assert pieces.digests(pieces.encode(frame.where("false"), PIECES)).collect() == []


def charsmap(rule):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as schema

    tool = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, remove_extra_whitespaces=True, escape_whitespaces=True)
    proto = schema.ModelProto()
    proto.ParseFromString(tool.serialized_model_proto())
    return tool, proto.normalizer_spec


def test_normalisation_through_a_compiled_map():
    tool, spec = charsmap("nmt_nfkc_cf")
    chars = pieces.CharacterMap(spec.precompiled_charsmap)
    assert chars.units

    @settings(max_examples=300, deadline=None)
    @given(st.text(alphabet=st.one_of(st.sampled_from("  　ａｂ①ﬁﬀİßÅ½ \t\n"), st.characters(exclude_categories=["Cs"])), max_size=30))
    def same(text):
        data = text.encode()
        normal, source = pieces.normalise(data, chars, dummy=True, trim=True, escape=True)
        assert normal.decode() == tool.normalize(text)
        assert len(source) == len(normal) + 1 and source[-1] <= len(data)
        assert (np.diff(source) >= 0).all()

    same()


def test_offsets_lead_back_to_the_source():
    _, spec = charsmap("nmt_nfkc_cf")
    chars = pieces.CharacterMap(spec.precompiled_charsmap)
    data = "  Ａ  ﬁx".encode()
    normal, source = pieces.normalise(data, chars, dummy=True, trim=True, escape=True)
    assert normal.decode() == "▁a▁fix"
    assert source.tolist() == [2] * 3 + [2] + [5] * 3 + [7, 7, 10, 11]


def test_few_words_are_remembered():
    tool = pieces.PieceEncoder(PIECES)
    for at in range(0, 150_000, 5000):
        tool.learn({f"w{i}" for i in range(at, at + 5000)})
    assert len(tool.known) <= 110_000
    tool.learn({"x" * 9_000_000})
    ids = [found[0].tolist() for found in tool.encode(["plain words"])]
    assert ids == [[*tool.library.encode("plain words"), tool.end]] and tool.held < 100

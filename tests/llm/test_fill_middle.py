import hashlib
import re

import numpy as np
import pyarrow as pa
from conftest import LONG
from hypothesis import given, settings
from hypothesis import strategies as st

from clinspark.llm import fill_middle

TEXTS = [
    "",
    None,
    " ",
    "a",
    "plain words, and\nlines\r\n\tof text",
    "naïve Straße 数字 🙂 ends",
    "with <P> inside",
    "<S>",
    "x<M>y",
    "<P <S <M P> S> M>",
    "\x00\x01 control \x85 ",
    "é combining",
    "x" * 5000,
    ". " * 3000,
]


def expected(doc_id, text, seed="1"):
    """The contract, step by step."""
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def rows_of(frame):
    text = fill_middle.restored(frame["output"], frame["form"]).alias("back")
    return frame.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", text).collect()


def test_every_text_by_every_id(docs):
    rows = [(100 * i + j, t) for i, t in enumerate(TEXTS) for j in range(25)]
    rows += [(None, "no id"), (None, "no id"), (7, "same id"), (7, "same id"), (7, None), (-3, "below zero"), (9, LONG)]
    found = rows_of(fill_middle.transform(docs(*rows)))
    key = lambda r: tuple(str(x) for x in r)
    wanted = [(i, *expected(i, t), t or "") for i, t in rows]
    assert sorted(map(key, found)) == sorted(map(key, wanted))
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}


def test_other_columns_and_empty_table(clashing):
    frame = clashing((1, "some text"), (2, None), names=("n", "form", "output", "first"))
    found = {r["doc_id"]: tuple(r)[1:5] for r in rows_of(fill_middle.transform(frame))}
    assert found == {1: expected(1, "some text")[:4], 2: expected(2, None)[:4]}
    assert rows_of(fill_middle.transform(frame.where("false"))) == []


def test_shares_are_parameters(docs):
    frame = docs(*[(i, f"text {i}") for i in range(300)])
    forms = {r["form"] for r in fill_middle.transform(frame, plain_percent=0, spm_percent=100).collect()}
    assert forms == {"spm"}
    forms = {r["form"] for r in fill_middle.transform(frame, plain_percent=100).collect()}
    assert forms == {"plain"}


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.text(alphabet=st.one_of(st.sampled_from("aZ <PSM>\n0é"), st.characters(exclude_categories=["Cs"]))), max_size=5),
    st.integers(1, 9),
    st.integers(0, (1 << 32) - 1),
    st.integers(0, (1 << 32) - 1),
)
def test_parts_of_texts_in_one_piece_and_in_segments(texts, size, first, second):
    units = [re.findall(r"[A-Za-z]+|[^A-Za-z]", t) for t in texts]
    cuts = [sorted((first % (len(u) + 1), second % (len(u) + 1))) for u in units]
    wanted = [["".join(u[:a]), "".join(u[a:b]), "".join(u[b:])] for u, (a, b) in zip(units, cuts, strict=True)]
    draw = [np.full(len(texts), d) for d in (first, second)]
    array = pa.array([t.encode() for t in texts], pa.binary())
    if texts:
        n, prefix, middle, output = fill_middle.rearrange(array, *draw, pa.array(["psm"] * len(texts)))
        assert n.to_pylist() == [len(u) for u in units]
        assert output.to_pylist() == [f"<P>{p}<S>{s}<M>{m}" for p, m, s in wanted]
        assert prefix.to_pylist() == [len(p) for p, _, _ in wanted]
    before, fill_middle.CHUNK_BYTES = fill_middle.CHUNK_BYTES, size
    try:
        for text, u, parts in zip(texts, units, wanted, strict=True):
            assert b"".join(fill_middle._segments(text.encode())) == text.encode()
            n, found = fill_middle._long_parts(text.encode(), draw[0][:1], draw[1][:1])
            assert n[0] == len(u)
            assert [f[0].as_py().decode() for f in found] == parts
    finally:
        fill_middle.CHUNK_BYTES = before

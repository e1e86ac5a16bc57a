"""Fill-in-the-middle rearrangement of texts.

A text is a run of units: a run of the letters A-Z and a-z, or any other single code point.
Two cuts between units, drawn from the hash of the document's id, divide it into prefix, middle
and suffix, and the parts are written in another order behind their marks.  The cutting is a
pipeline of ``pyarrow.compute`` calls over the texts of a batch: units become list arrays,
which are flattened with the index of their text; a unit's ordinal is its place less that of
its text's first unit; units are filtered by role, and each role's units are joined again.

Texts are handled as bytes, so a byte that no UTF-8 text holds can part the units.  A batch is
worked off in chunks of about ``CHUNK_BYTES``; a longer text is a chunk of its own and is cut,
between units, into segments of that size, so the lists of units stay small for any text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinspark.llm.common import small_batches, whole

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)

# A unit in bytes; a stray byte of a broken character is a unit, too.
UNIT = rb"[A-Za-z]+|[^A-Za-z\x80-\xBF][\x80-\xBF]*|[\x80-\xBF]"
BORDER = b"\xff"
CHUNK_BYTES = 2 << 20

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def draws(doc_id: Column, seed: str = "1") -> list[Column]:
    """Four numbers below 2 ** 32 that depend on seed and id only; a null id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _lists(texts: pa.Array) -> pa.ListArray:
    """The units of each text; every list ends with an empty item."""
    return pc.split_pattern(pc.replace_substring_regex(texts, b"(" + UNIT + b")", b"\\1" + BORDER), BORDER)


def _parts(texts: pa.Array, first: np.ndarray, low: np.ndarray, high: np.ndarray, lists: pa.ListArray) -> list[pa.Array]:
    """Prefix, middle and suffix of each text or segment, whose first unit has the ordinal ``first``."""
    units = pc.list_flatten(lists)
    owner = pc.list_parent_indices(lists).to_numpy()
    begins = np.asarray(lists.offsets, np.int64)
    ordinal = np.arange(len(owner)) - (begins[:-1] - begins[0] - first)[owner]
    role = (ordinal >= low[owner]).astype(np.int8) + (ordinal >= high[owner])
    found = []
    for wanted in range(3):
        chosen = role == wanted
        ends = np.append(0, np.cumsum(np.bincount(owner[chosen], minlength=len(texts))))
        rebuilt = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), units.filter(pa.array(chosen)))
        found.append(pc.binary_join(rebuilt, b""))
    return found


def _segments(text: bytes) -> Iterator[bytes]:
    """A text in pieces of at least ``CHUNK_BYTES``, cut between units."""
    data, begin = np.frombuffer(text, np.uint8), 0
    while begin < len(data):
        end = begin + CHUNK_BYTES
        while end < len(data):
            window = data[end - 1 : end + (1 << 16)]
            letter, inside = _LETTER[window], (window & 0xC0) == 0x80
            edge = np.flatnonzero(~(letter[:-1] & letter[1:]) & ~inside[1:])
            if len(edge):
                end += int(edge[0])
                break
            end += 1 << 16
        yield text[begin:end]
        begin = min(end, len(data))


def _chunks(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``CHUNK_BYTES`` together, or one row."""
    begin, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > begin and total + size > CHUNK_BYTES:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def _cuts(n: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, b = first % (n + 1), second % (n + 1)
    return np.minimum(a, b), np.maximum(a, b)


def _long_parts(text: bytes, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """Number of units and parts of one text, segment by segment."""
    counts = [pc.count_substring_regex(pa.array([s], pa.binary()), UNIT)[0].as_py() for s in _segments(text)]
    n = np.array([sum(counts)], np.int64)
    low, high = _cuts(n, first, second)
    pieces, done = [[], [], []], 0
    for segment, count in zip(_segments(text), counts, strict=True):
        one = pa.array([segment], pa.binary())
        for all_of_role, part in zip(pieces, _parts(one, np.array([done]), low, high, _lists(one)), strict=True):
            all_of_role.append(part[0].as_py())
        done += count
    return n, [pa.array([b"".join(p)], pa.binary()) for p in pieces]


def _length(texts: pa.Array) -> pa.Array:
    return pc.utf8_length(texts.view(pa.string())).cast(pa.int64())


def rearrange(texts: pa.Array, first: np.ndarray, second: np.ndarray, form: pa.Array) -> tuple[pa.Array, ...]:
    """Units, prefix and middle code points, and output of each text (bytes, no nulls)."""
    if len(texts) == 1 and len(texts[0].as_buffer()) > CHUNK_BYTES:
        n, (prefix, middle, suffix) = _long_parts(texts[0].as_py(), first, second)
    else:
        lists = _lists(texts)
        n = np.asarray(pc.list_value_length(lists), np.int64) - 1
        low, high = _cuts(n, first, second)
        prefix, middle, suffix = _parts(texts, np.zeros(len(texts), np.int64), low, high, lists)
    p, s, m = (mark.encode() for mark in MARKS)
    psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, b"")
    spm = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, b"")
    plain = pc.equal(form, "plain")
    output = pc.if_else(plain, texts, pc.if_else(pc.equal(form, "spm"), spm, psm))
    nothing = pa.scalar(None, pa.int64())
    chars = [pc.if_else(plain, nothing, _length(part)) for part in (prefix, middle)]
    return pa.array(n), *chars, output.view(pa.string())


def transform(docs: DataFrame, seed: str = "1", plain_percent: int = 10, spm_percent: int = 20) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text``) rearranged.

    Returns ``doc_id``, ``n`` (units), ``form`` (``plain``, ``psm`` or ``spm``), ``prefix_chars`` and
    ``middle_chars`` (code points; null if plain) and ``output``.  Null texts count as empty; empty
    texts and texts that contain a mark stay plain, with ``plain_percent`` of the others.  Rows
    that repeat an id are cut by the same draws, rows without id by those of an empty id.  Other
    columns are not read.  An empty table gives an empty table.
    """
    first, second, third, fourth = draws(F.col("doc_id"), seed)
    marked = F.lit(False)
    for mark in MARKS:
        marked |= F.contains("text", F.lit(mark))
    stays = (F.length("text") == 0) | marked | (third % 100 >= 100 - plain_percent)
    form = F.when(stays, "plain").when(fourth % 100 < spm_percent, "spm").otherwise("psm")
    rows = docs.select("doc_id", whole().cast("string").alias("text")).select(
        "doc_id", F.col("text").cast("binary").alias("text"), first.alias("first"), second.alias("second"), form.alias("form")
    )

    def run(batches):
        for batch in batches:
            texts, names = batch.column(1), ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
            for a, b in _chunks(np.asarray(pc.binary_length(texts), np.int64)):
                rows = batch.slice(a, b - a)
                n, prefix, middle, output = rearrange(
                    rows.column(1), rows.column(2).to_numpy(), rows.column(3).to_numpy(), rows.column(4)
                )
                yield pa.RecordBatch.from_arrays([rows.column(0), n, rows.column(4), prefix, middle, output], names)

    small_batches(docs.sparkSession)
    long, string = T.LongType(), T.StringType()
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("n", long),
            T.StructField("form", string),
            T.StructField("prefix_chars", long),
            T.StructField("middle_chars", long),
            T.StructField("output", string),
        ]
    )
    return rows.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` of that form was made from.

    A rearranged text holds each mark once: texts that contain one stay plain, and no mark can
    arise where a part meets a mark.
    """
    part = F.split(output, "|".join(MARKS))
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(part[1], part[3], part[2]))
        .otherwise(F.concat(part[2], part[3], part[1]))
    )

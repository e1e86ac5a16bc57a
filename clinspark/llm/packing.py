"""Packing documents into sequences of a fixed length.

Documents are encoded, and what of a document fills whole sequences becomes sequences of its
own.  The rests are dealt at random into groups of about ``GROUP_DOCS`` documents, which are
packed independently: in falling order of size, each rest goes into the first open sequence
that has room for it.  A tournament tree over the room of all sequences finds that one in a
logarithmic number of steps.

What first-fit decreasing leaves open is closed by cutting: pieces of the emptiest sequences
fill the gaps of the fullest ones, and the one sequence that stays open is cut at powers of
two, lengths that need no padding.  Gaps of at most ``SLACK`` tokens are padded instead.

A group's task sees its rests already sorted (Spark's sort spills) and holds them until the
group is complete, which is at most ``GROUP_DOCS`` sequences' worth of ids, give or take the
chance of the dealing.  Groups come from a hash of a row number, so neither repeated ids nor
equal texts can meet in one group more often than others.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinspark.llm.common import small_batches, whole
from clinspark.llm.letter_words import ByteModel, is_letters

LENGTH = 4096
GROUP_DOCS = 1024
SLACK = 16
CHUNK_SEQUENCES = 16  # whole sequences of a document that travel as one row
CACHED_WORDS = 1_500_000

# Fixed value: the pieces that a word tokenizer of the CLIP kind cuts a text into; blanks are dropped.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

MARKS = string.punctuation.replace("'", "")  # a run of these behind letters is a piece of its own


class WordEncoder:
    """Ids of whole texts, word by word.

    A tokenizer that drops blanks never joins what lies on both sides of one, so a text is cut
    at spaces and line breaks and each word is encoded once.  What is known is a memory of the
    worker: it is dropped when full and changes no result.  Tokenizers with another pattern
    get whole texts.
    """

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        parts = json.loads(self.tokenizer.to_str())["pre_tokenizer"] or {}
        first = (parts.get("pretokenizers") or [parts])[0]
        self.by_word = first.get("pattern") == {"Regex": WORD_PATTERN} and first.get("behavior") == "Removed"
        self.size = max(self.tokenizer.get_vocab().values()) + 1
        self.id_type = "<u2" if self.size <= 1 << 16 else "<u4"
        self.model = ByteModel(self.tokenizer) if self.by_word else None
        self.known: dict[str, bytes] = {"": b""}
        self.letters: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {"": b""}

    def _encoded(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.id_type).tobytes() for e in found]

    def _learn(self, words: set[str]) -> None:
        for memory in (self.known, self.letters, self.marks):
            if len(memory) > CACHED_WORDS:
                memory.clear()
                memory[""] = b""
        new = words.difference(self.known)
        bare = {w: w.rstrip(MARKS) for w in new}
        odd = [w for w, b in bare.items() if not is_letters(b)]
        self.known.update(zip(odd, self._encoded(odd), strict=True))
        for word in odd:
            del bare[word]
        marks = list({w[len(b) :] for w, b in bare.items()}.difference(self.marks))
        self.marks.update(zip(marks, self._encoded(marks), strict=True))
        for word, letters in bare.items():
            low = letters.lower()
            ids = self.letters.get(low)
            if ids is None:
                ids = self.letters[low] = np.array(self.model.ids(low), self.id_type).tobytes()
            self.known[word] = ids + self.marks[word[len(letters) :]]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text, as little-endian numbers of ``id_type``."""
        if not self.by_word:
            yield from self._encoded(texts)
            return
        cut = [t.replace("\n", " ").split(" ") for t in texts]
        self._learn(set().union(*cut))
        for words in cut:
            yield b"".join(map(self.known.__getitem__, words))


@lru_cache(maxsize=4)
def encoder(path: str) -> WordEncoder:
    """One encoder per worker process."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordEncoder(path)


class TournamentTree:
    """Room left in each of ever more bins; every inner node holds the larger room of its two."""

    def __init__(self, capacity: int, leaves: int = 64):
        self.capacity, self.leaves = capacity, leaves
        self.room = [capacity] * (2 * leaves)

    def _grow(self) -> None:
        old, self.leaves = self.room[self.leaves :], 2 * self.leaves
        self.room = [0] * self.leaves + old + [self.capacity] * len(old)
        for node in range(self.leaves - 1, 0, -1):
            self.room[node] = max(self.room[2 * node], self.room[2 * node + 1])

    def place(self, size: int) -> int:
        """Put ``size`` (1 to the capacity) into the first bin with room for it."""
        while self.room[1] < size:
            self._grow()
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        room[node] -= size
        found = node - self.leaves
        while node > 1:
            node //= 2
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
        return found


Piece = tuple  # owner, start, length: ids of a document from ``start`` on


def first_fit(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each size, in the given order."""
    tree = TournamentTree(capacity)
    return [tree.place(size) for size in sizes]


def _take(pieces: list[Piece], wanted: int) -> list[Piece]:
    """Remove ``wanted`` ids from the end of a list of pieces, cutting one if need be."""
    taken = []
    while wanted and pieces:
        owner, start, length = pieces.pop()
        part = min(length, wanted)
        if part < length:
            pieces.append((owner, start, length - part))
        taken.append((owner, start + length - part, part))
        wanted -= part
    return taken[::-1]


def close_gaps(bins: list[list[Piece]], capacity: int, slack: int = SLACK) -> list[list[Piece]]:
    """Sequences with at most ``slack`` ids of padding each, or with a power of two of ids."""
    bins = sorted(bins, key=lambda pieces: -sum(p[2] for p in pieces))
    done, last = [], len(bins) - 1
    for i, pieces in enumerate(bins):
        if i > last:
            break
        gap = capacity - sum(p[2] for p in pieces)
        while gap > slack and last > i:
            more = _take(bins[last], gap)
            pieces.extend(more)
            gap -= sum(p[2] for p in more)
            if not bins[last]:
                last -= 1
        if gap <= slack:
            done.append(pieces)
            continue
        fill = capacity - gap  # nothing is left to fill this one with
        while fill:
            part = 1 << (fill.bit_length() - 1)
            done.append(_take(pieces, part))
            fill -= part
    return done


def _encoded(docs: DataFrame, tokenizer: str, end_id: int, length: int, groups: int) -> DataFrame:
    """Rows of ids: ``grp``, ``size``, ``doc_id``, ``start``, ``doc_tokens``, ``ids``.

    A document's whole sequences come in rows of several each, its rest in a row of less than
    ``length`` ids.
    """
    chunk = CHUNK_SEQUENCES * length

    def run(batches):
        tool = encoder(tokenizer)
        width, end = np.dtype(tool.id_type).itemsize, np.array([end_id], tool.id_type).tobytes()
        for batch in batches:
            groups_of, texts = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            rows, grp, start, total, ids = [], [], [], [], []
            for i, data in enumerate(tool.encode(texts)):
                data += end
                n = len(data) // width
                filled = n - n % length
                begins = [*range(0, filled, chunk), *([filled] if n > filled else [])]
                for number, begin in enumerate(begins):
                    stop = min(begin + chunk, filled) if begin < filled else n
                    rows.append(i)
                    grp.append((groups_of[i] + number) % groups)
                    start.append(begin)
                    total.append(n)
                    ids.append(data[begin * width : stop * width])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(grp, pa.int64()),
                    pa.array([len(x) // width for x in ids], pa.int64()),
                    batch.column(1).take(pa.array(rows, pa.int64())),
                    pa.array(start, pa.int64()),
                    pa.array(total, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                ["grp", "size", "doc_id", "start", "doc_tokens", "ids"],
            )

    long = T.LongType()
    fields = [("grp", long), ("size", long), ("doc_id", docs.schema["doc_id"].dataType)]
    fields += [("start", long), ("doc_tokens", long), ("ids", T.BinaryType())]
    grp = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))
    rows = docs.select(grp.alias("grp"), "doc_id", whole().cast("string").alias("text"))
    return rows.mapInArrow(run, T.StructType([T.StructField(*f) for f in fields]))


class _Group:
    """The rows of one group, as they come: whole sequences leave at once, rests are held."""

    def __init__(self, number: int, length: int, width: int):
        self.first_id, self.length, self.width = number << 32, length, width
        self.tree = TournamentTree(length)
        self.bins: list[list[Piece]] = []
        self.rows: list[tuple] = []
        self.given = 0

    def _sequence(self, pieces: list[Piece], rows: list[tuple]) -> Iterator[tuple]:
        at = 0
        for owner, start, size in pieces:
            doc_id, first, total, ids = rows[owner]
            yield doc_id, first + start, size, total, self.first_id + self.given, at, ids[start * self.width : (start + size) * self.width]
            at += size
        self.given += 1

    def add(self, doc_id, start: int, total: int, ids: bytes) -> Iterator[tuple]:
        size = len(ids) // self.width
        if size >= self.length:
            for at in range(0, size, self.length):
                yield from self._sequence([(0, at, self.length)], [(doc_id, start, total, ids)])
            return
        place = self.tree.place(size)
        if place == len(self.bins):
            self.bins.append([])
        self.bins[place].append((len(self.rows), 0, size))
        self.rows.append((doc_id, start, total, ids))

    def finish(self) -> Iterator[tuple]:
        for pieces in close_gaps(self.bins, self.length):
            yield from self._sequence(pieces, self.rows)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, length: int = LENGTH, ids: bool = False) -> DataFrame:
    """Sequences of at most ``length`` ids from every text of ``docs`` (``doc_id``, ``text``).

    Returns a row per piece: ``doc_id``, ``start`` (ids of its document before it), ``length``,
    ``ids_crc32`` (of the ids as little-endian unsigned 32-bit numbers), ``doc_tokens`` (with the
    end id), ``sequence_id``, ``offset`` (place in the sequence) and, if asked for, ``ids``.
    Null texts count as empty and give the end id alone.  Rows that repeat an id, or have none,
    are documents of their own; other columns are not read.  An empty table gives no piece.
    """
    spark = docs.sparkSession
    groups = max(1, -(-docs.count() // GROUP_DOCS))
    id_type = encoder(tokenizer).id_type
    small_batches(spark)
    rows = _encoded(docs, tokenizer, end_id, length, groups)

    def run(batches):
        width, group, number = np.dtype(id_type).itemsize, None, None
        held: list[tuple] = []
        for batch in batches:
            for grp, doc_id, start, total, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if grp != number:
                    if group is not None:
                        held.extend(group.finish())
                    group, number = _Group(grp, length, width), grp
                held.extend(group.add(doc_id, start, total, data))
            if held:
                yield table(held)
                held = []
        if group is not None:
            held.extend(group.finish())
            yield table(held)

    def table(found: list[tuple]) -> pa.RecordBatch:
        doc_id, start, size, total, sequence, offset, data = zip(*found, strict=True)
        whole_ids = [np.frombuffer(d, id_type).astype("<u4") for d in data]
        columns = [
            pa.array(doc_id, pa_id),
            pa.array(start, pa.int64()),
            pa.array(size, pa.int64()),
            pa.array([zlib.crc32(x.tobytes()) for x in whole_ids], pa.int64()),
            pa.array(total, pa.int64()),
            pa.array(sequence, pa.int64()),
            pa.array(offset, pa.int64()),
        ]
        if ids:
            columns.append(pa.array([x.astype(np.int32) for x in whole_ids], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    from pyspark.sql.pandas.types import to_arrow_type

    long = T.LongType()
    kind = docs.schema["doc_id"].dataType
    pa_id = to_arrow_type(kind)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    fields = [T.StructField(n, kind if n == "doc_id" else long) for n in names[:-1]]
    if ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    return (
        rows.repartition("grp")
        .sortWithinPartitions("grp", F.desc("size"), "doc_id")
        .select("grp", "doc_id", "start", "doc_tokens", "ids")
        .mapInArrow(run, T.StructType(fields))
    )

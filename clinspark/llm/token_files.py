"""Token ids in compact binary files.

Ids are replaced by their rank in the corpus (the most frequent id has rank 0) and stored
byte-aligned: a rank takes one to four bytes, and four two-bit lengths share a control byte.
Control bytes and data bytes are kept apart, so a reader looks up the lengths of four ranks
at once in a table of 256 rows and gathers the data without a loop.

The work is a few Spark jobs: encode the texts and keep their ids in the stage folder, count
the ids, code them by rank and deal the rows out by ranges of ``doc_id``, write one file per
range.  An id that more rows have than a range holds is dealt over several files by a row
number.  A file has a name of its own for each attempt of its task; the
manifest, written by Spark, names the files of the attempts that were committed, so lost
executors and repeated tasks leave nothing wrong behind.

File layout, little-endian: the magic ``TOKR0001``, then blocks of
``n_docs, control_bytes, data_bytes`` (three u8), ``doc_id`` (i8 each, the smallest i8 for
null), ``n_tokens`` (u8 each), ``data_bytes`` (u8 each), all control bytes, all data bytes.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinspark.llm.common import drop_path, shuffle_partitions, small_batches
from clinspark.llm.letter_words import ByteModel, is_letters
from clinspark.session import stage, stage_path

MAGIC = b"TOKR0001"
BLOCK_BYTES = 4 << 20
NO_ID = -(1 << 63)
CACHED_WORDS = 800_000  # of the newest words, and as many of those before
ENCODED = "doc_id long, salt long, ids binary"

# Lengths of the four ranks that a control byte describes.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1

MARKS = ".,;:!?%&#$*|)]}\""  # of these, what ends a word is encoded by itself

# Blanks besides the space and the line break.
_OTHER_BLANKS = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"]
_OTHER_ASCII = [c for c in _OTHER_BLANKS if c.isascii()]
_BLANK = re.compile(r"\s")
_TWO_BLANKS = re.compile(r"\s\s|^\s|\s$")
_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def lone_blanks(text: str) -> bool:
    """Whether every blank stands alone between two other characters; ``text`` is not empty.

    Most texts have no other blanks than spaces and line breaks, and a few searches tell.
    """
    if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[0].isspace() or text[-1].isspace():
        return False
    others = _OTHER_ASCII if text.isascii() else _OTHER_BLANKS
    return not any(c in text for c in others) or not _TWO_BLANKS.search(text)


class WordEncoder:
    """Ids of whole texts, word by word.

    A byte-level pre-tokenizer always cuts before a single space between two other characters,
    and on both sides of such a line break; what lies between two cuts is encoded by itself.
    So a text is cut there, and each word is given to the tokenizer once.  Texts with runs of
    blanks are cut at their single spaces only, and other kinds of tokenizers get whole texts.
    What is known is a memory of the worker and changes no result.  When it is full, the words
    of that time are kept beside the new ones until these fill it, and then dropped.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        before = self.tokenizer.pre_tokenizer
        self.by_word = (
            self.tokenizer.normalizer is None
            and isinstance(before, pre_tokenizers.ByteLevel)
            and not before.add_prefix_space
            and "use_regex=False" not in repr(before)
        )
        vocabulary = self.tokenizer.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.id_type = "<u2" if self.size <= 1 << 16 else "<u4"
        self.starts_word = np.zeros(self.size, dtype=bool)
        self.starts_word[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True
        self.break_id = vocabulary.get("Ċ")
        self.model = ByteModel(self.tokenizer) if self.by_word else None
        self.known: dict[str, bytes] = {}  # words behind a space, or with the line break before them
        self.before: dict[str, bytes] = {}  # what was known when it was last full
        self.marks: dict[str, bytes] = {}  # ends of words
        self.code = "H" if self.id_type == "<u2" else "I"

    def cut(self, text: str) -> list[str]:
        """The words of a text, without the space but with the line break before them.

        The text counts as a line.  An empty list means that it has to be encoded whole.
        """
        if not self.by_word or self.break_id is None or not text or not lone_blanks(text):
            return []
        words = text.replace("\n", " \n").split(" ")
        words[0] = "\n" + words[0]
        return words

    def learn(self, words: set[str]) -> None:
        """Encode the words that are not known yet."""
        if len(self.known) > CACHED_WORDS:
            self.known, self.before = {}, self.known
        if len(self.marks) > CACHED_WORDS:
            self.marks.clear()
        known, before = self.known, self.before
        new = words.difference(known)
        again = new.intersection(before)
        known.update(zip(again, map(before.__getitem__, again), strict=True))
        new -= again
        # The tokenizer cuts between a letter and the marks behind it, too.
        bare = {w: w.rstrip(MARKS) for w in new}
        bare = {w: b if b and b[-1].isalpha() else w for w, b in bare.items()}
        other = []
        for word in set(bare.values()).difference(known):
            if is_letters(word):
                known[word] = array(self.code, self.model.ids(word, behind_space=True)).tobytes()
            elif word[:1] == "\n" and is_letters(word[1:]):
                known[word] = array(self.code, [self.break_id, *self.model.ids(word[1:])]).tobytes()
            else:
                other.append(word)
        for blank in ("\n", " "):
            plain = {w for w in other if (w[:1] == "\n") == (blank == "\n")}
            odd = {w for w in plain if not w.isalnum() and _BLANK.search(w, 1)}
            self._one_by_one(list(odd), blank)
            plain = list(plain - odd)
            for at in range(0, len(plain), 2000):  # many words in one call: each begins with its blank
                self._together(plain[at : at + 2000], blank)
        marks = list({w[len(b) :] for w, b in bare.items() if w != b} - self.marks.keys())
        self.marks.update(zip(marks, (ids.tobytes() for ids in self._encoded(marks)), strict=True))
        known.update((w, known[b] + self.marks[w[len(b) :]]) for w, b in bare.items() if w != b)

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.id_type) for e in found]

    def _together(self, words: list[str], before: str) -> None:
        ids = self._encoded(["".join(words) if before == "\n" else " " + " ".join(words)])[0]
        # A space is part of its word's first id, a line break is an id of its own.
        begins = np.flatnonzero(self.starts_word[ids] if before == " " else ids == self.break_id)
        if len(begins) != len(words):
            self._one_by_one(words, before)
            return
        size = ids.itemsize
        data, ends = ids.tobytes(), np.append(begins[1:], len(ids)) * size
        for word, a, b in zip(words, (begins * size).tolist(), ends.tolist(), strict=True):
            self.known[word] = data[a:b]

    def _one_by_one(self, words: list[str], before: str) -> None:
        ids = self._encoded([w if before == "\n" else " " + w for w in words])
        self.known.update(zip(words, (i.tobytes() for i in ids), strict=True))

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text, as little-endian numbers of ``id_type``."""
        cut = [self.cut(t) for t in texts]
        self.learn(set().union(*cut))
        size = np.dtype(self.id_type).itemsize
        for text, words in zip(texts, cut, strict=True):
            if words:
                yield b"".join(map(self.known.__getitem__, words))[size:]  # without the break before the text
            else:
                yield self._split(text)

    def _split(self, text: str) -> bytes:
        """A text with runs of blanks, cut at its single spaces only."""
        if not self.by_word:
            return self._encoded([text])[0].tobytes()
        words = _LONE_SPACE.split(text)
        parts = [words[0], *(" " + w for w in words[1:])]
        return b"".join(ids.tobytes() for ids in self._encoded(parts))


@lru_cache(maxsize=4)
def encoder(path: str) -> WordEncoder:
    """One encoder per worker process."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordEncoder(path)


def pack(ranks: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Control and data bytes of the ranks (below 2 ** 32) of several documents, and where each one's begin.

    ``counts`` are the documents' numbers of ranks; the bounds have one entry more than that.
    """
    ranks = ranks.astype(np.uint32)
    code = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    quads = np.append(0, np.cumsum(-(-counts // 4)))
    ends = np.append(0, np.cumsum(counts))
    padded = np.zeros(4 * int(quads[-1]), np.uint8)
    padded[np.arange(len(ranks)) + np.repeat(4 * quads[:-1] - ends[:-1], counts)] = code
    control = (padded.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)).astype(np.uint8)
    length = code.astype(np.int64) + 1
    at = np.append(0, np.cumsum(length))
    data = np.zeros(int(at[-1]), np.uint8)
    for byte in range(4):
        some = np.flatnonzero(code >= byte)
        data[at[some] + byte] = ranks[some] >> np.uint32(8 * byte) & np.uint32(0xFF)
    return control, quads, data, at[ends]


def as_binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The stretches of ``data`` between the bounds."""
    buffers = [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, buffers)


def flat(ids: pa.Array, id_type: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of bytes, one document behind the other, and the documents' numbers of them."""
    bounds = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1]
    data = ids.buffers()[2]
    width = np.dtype(id_type).itemsize
    begin, size = int(bounds[0]) if len(bounds) else 0, int(bounds[-1] - bounds[0]) if len(bounds) else 0
    values = np.frombuffer(data, np.uint8, size, begin).view(id_type) if size else np.zeros(0, id_type)
    return values, np.diff(bounds).astype(np.int64) // width


def unpack(control: np.ndarray, data: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The ranks of several documents with ``counts`` ranks each, whose bytes follow each other."""
    quads = -(-counts // 4)
    length = LENGTHS[control].ravel()
    place = np.arange(len(length)) - np.repeat((np.cumsum(quads) - quads) * 4, quads * 4)
    length = length[place < np.repeat(counts, quads * 4)]
    at = np.cumsum(length) - length
    ranks = data[at].astype(np.uint32)
    for byte in range(1, 4):
        some = np.flatnonzero(length > byte)
        if not len(some):
            break
        ranks[some] |= data[at[some] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return ranks


def filesystem(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """The store and the path in it of a stage folder."""
    return arrow_fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", uri))


def encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """``doc_id``, a row number ``salt``, and ``ids`` (bytes, the end id included) of every row."""

    def run(batches):
        tool = encoder(tokenizer)
        end = np.array([end_id], tool.id_type).tobytes()
        for batch in batches:
            ids = [x + end for x in tool.encode([t or "" for t in batch.column(2).to_pylist()])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(ids, pa.binary())], ["doc_id", "salt", "ids"])

    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long"), F.monotonically_increasing_id().alias("salt"), F.col("text").cast("string")
    )
    return rows.mapInArrow(run, ENCODED)


def frequency_ranks(ids: DataFrame, id_type: str = "<u2") -> DataFrame:
    """``id`` and ``rank`` of every id in the ``ids`` bytes; ties to the smaller id."""

    def run(batches):
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            counts = np.bincount(flat(batch.column(0), id_type)[0])
            if len(counts) > len(total):
                total = np.append(total, np.zeros(len(counts) - len(total), np.int64))
            total[: len(counts)] += counts
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    counts = ids.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    order = Window.orderBy(F.desc("n"), "id")  # at most one row per id of the vocabulary
    return counts.select("id", (F.row_number().over(order) - 1).alias("rank"))


def file_numbers(doc_ids: pa.Array, salts: pa.Array, bounds: np.ndarray) -> np.ndarray:
    """The range of each id; an id that is the bound of several ranges is dealt over them by ``salts``."""
    ids = doc_ids.fill_null(NO_ID).to_numpy()
    low, high = np.searchsorted(bounds, ids, "left"), np.searchsorted(bounds, ids, "right")
    salt = salts.to_numpy().astype(np.uint64)
    share = (salt * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    return np.where(high - low > 1, low + 1 + (share * (high - low)).astype(np.int64), high)


def write(docs: DataFrame, tokenizer: str, end_id: int = 0) -> tuple[DataFrame, list[int]]:
    """Encode every text of ``docs``, append ``end_id``, and write the files in ascending ``doc_id`` order.

    Returns the manifest (``file_no``, ``path``, ``n_docs``, ``n_tokens``, and ``start``, the ids
    in all files before) and the ids by rank.  Null texts count as empty; null ids come first;
    rows that repeat an id have no order among themselves.  An empty table writes no file.
    """
    spark = docs.sparkSession
    id_type = encoder(tokenizer).id_type
    held = stage_path(spark, "token-ids")
    encoded(docs, tokenizer, end_id).write.option("compression", "zstd").parquet(held)
    ids = spark.read.schema(ENCODED).parquet(held)
    by_rank = [r["id"] for r in frequency_ranks(ids, id_type).orderBy("rank").collect()]  # one per id used
    rank_of = np.zeros(max(by_rank, default=0) + 1, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank))

    # Bounds of the ranges come from the documents' ids alone, so that nothing is coded for them.
    parts = shuffle_partitions(spark)
    shares = [i / parts for i in range(1, parts)]
    bounds = np.zeros(0, np.int64)
    if shares:
        known = F.percentile_approx(F.coalesce("doc_id", F.lit(NO_ID)), shares, 10 * parts)
        bounds = np.array(ids.agg(known).first()[0] or [], np.int64)

    def code(batches):
        for batch in batches:
            values, counts = flat(batch.column(2), id_type)
            control, quads, data, ends = pack(rank_of[values], counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(file_numbers(batch.column(0), batch.column(1), bounds), pa.int32()),
                    *batch.columns[:2],
                    pa.array(counts),
                    as_binary(control, quads),
                    as_binary(data, ends),
                ],
                ["file_no", "doc_id", "salt", "n", "control", "data"],
            )

    folder = stage_path(spark, "tokens")

    def save(batches):
        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        out, name, held, done = None, None, [], [0, 0, 0]

        def flush():
            ids, n, control, data = zip(*held, strict=True)
            out.write(struct.pack("<3Q", len(held), sum(map(len, control)), sum(map(len, data))))
            out.write(np.array([NO_ID if i is None else i for i in ids], "<i8").tobytes())
            out.write(np.array(n, "<u8").tobytes())
            out.write(np.array([len(d) for d in data], "<u8").tobytes())
            out.write(b"".join(control) + b"".join(data))
            done[1], done[2] = done[1] + len(held), done[2] + sum(n)
            held.clear()

        def close():
            if held:
                flush()
            out.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in (done[0], name, done[1], done[2])], ["file_no", "path", "n_docs", "n_tokens"]
            )

        size = 0
        for batch in batches:
            for no, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if out is None or no != done[0]:
                    if out is not None:
                        yield close()
                    done, size = [no, 0, 0], 0
                    name = f"{root}/tokens-{no:06d}-{uuid.uuid4().hex}.bin"
                    out = store.open_output_stream(name)
                    out.write(MAGIC)
                held.append(row)
                size += len(row[3])
                if size >= BLOCK_BYTES:
                    flush()
                    size = 0
        if out is not None:
            yield close()

    coded = ids.mapInArrow(code, "file_no int, doc_id long, salt long, n long, control binary, data binary")
    manifest = (
        coded.repartitionById(parts, F.col("file_no"))
        .sortWithinPartitions("file_no", "doc_id", "salt")
        .drop("salt")
        .mapInArrow(save, "file_no long, path string, n_docs long, n_tokens long")
    )
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    manifest = stage(manifest, "token-manifest")
    drop_path(spark, held)
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))), by_rank


def blocks(store, path: str, by_rank: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each block of a file: document ids, numbers of tokens, token ids."""
    with store.open_input_stream(path) as file:
        if file.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"{path} is no token file")
        while head := file.read(24):
            n_docs, n_control, n_data = struct.unpack("<3Q", head)
            doc_ids = np.frombuffer(file.read(8 * n_docs), "<i8")
            counts = np.frombuffer(file.read(8 * n_docs), "<u8").astype(np.int64)
            file.read(8 * n_docs)
            control = np.frombuffer(file.read(n_control), np.uint8)
            data = np.frombuffer(file.read(n_data), np.uint8)
            yield doc_ids, counts, by_rank[unpack(control, data, counts)]


def read(manifest: DataFrame, by_rank: list[int], ids: bool = False) -> DataFrame:
    """From the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` of every document, and if asked its ``ids``."""
    with_ids = ids
    table = np.array(by_rank, "<u4")
    root = stage_path(manifest.sparkSession, "x")

    def run(batches):
        store, _ = filesystem(root)
        for batch in batches:
            for path, start in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                for doc_ids, counts, ids in blocks(store, path, table):
                    ends = np.cumsum(counts)
                    data = ids.astype("<u4").tobytes()
                    crc = [zlib.crc32(data[4 * (b - n) : 4 * b]) for b, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                    columns = [
                        pa.array(doc_ids, mask=doc_ids == NO_ID),
                        pa.array(start + ends - counts),
                        pa.array(counts),
                        pa.array(crc, pa.int64()),
                    ]
                    if with_ids:
                        offsets = pa.array(np.append(0, ends), pa.int32())
                        columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))))
                    yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])
                    start += int(ends[-1])

    names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    files = manifest.repartitionById(shuffle_partitions(manifest.sparkSession), F.col("file_no").cast("int"))
    return files.select("path", "start").mapInArrow(run, schema)

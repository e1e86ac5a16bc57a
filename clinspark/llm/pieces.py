"""SentencePiece encoding with byte offsets, and decoding.

Ids come from the sentencepiece library.  Beside them every piece is projected to the bytes
of the original text: the text is normalised through the model's compiled character map,
always by its longest matching prefix, and each normalised byte remembers the source byte
it came from, so the bounds of a piece in the normalised text give its bounds in the source.

Models without a character map that keep blanks as they are (pieces have a blank at their
beginning or nowhere) encode each space-separated word by itself; their words are encoded
once per worker and the normalised bytes map to the source one to one.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinspark.llm.common import small_batches

BLANK = "▁"  # stands for a space in a normalised text
_BLANK = BLANK.encode()
CACHED_WORDS = 100_000  # of a worker; one takes about 300 bytes
CACHED_CHARS = 8_000_000  # in all of them
_WORD_END = re.compile(r"(?<=[^ ]) ")


class CharacterMap:
    """The compiled map: a double-array trie over UTF-8 prefixes, and the strings they become."""

    def __init__(self, blob: bytes):
        size = struct.unpack("<I", blob[:4])[0] if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.strings = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """What the longest mapped prefix of ``data[at:]`` becomes, and its length."""
        if not self.units:
            return None
        found, node = None, _offset(self.units[0])
        for k in range(at, len(data)):
            node ^= data[k]
            unit = self.units[node]
            if unit & 0x800000FF != data[k]:
                break
            node ^= _offset(unit)
            if unit >> 8 & 1:
                found = self.units[node] & 0x7FFFFFFF, k + 1 - at
        if found is None:
            return None
        value, length = found
        return self.strings[value : self.strings.index(b"\0", value)], length


def _offset(unit: int) -> int:
    return unit >> 10 << ((unit & 0x200) >> 6)


def normalise(data: bytes, chars: CharacterMap, dummy: bool, trim: bool, escape: bool, suffix: bool = False):
    """Normalised bytes and, for each of them and the end, the position in ``data`` it came from.

    All bytes of a mapped string come from the beginning of its prefix, copied bytes from themselves.

    ``dummy`` adds a blank in front (at the end with ``suffix``), ``trim`` drops blanks at both
    ends and all but one of a run, ``escape`` writes blanks as the blank symbol.
    """
    blank = _BLANK if escape else b" "
    out, source, at = bytearray(), [], 0

    def put(piece: bytes, origin: int) -> None:
        out.extend(piece)
        copied = piece == data[origin : origin + len(piece)]
        source.extend(range(origin, origin + len(piece)) if copied else [origin] * len(piece))

    def step(k: int) -> tuple[bytes, int]:
        mapped = chars.longest(data, k)
        if mapped:
            return mapped
        first = data[k]
        width = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
        return data[k : k + width], width

    if trim:
        while at < len(data) and (part := step(at))[0] == b" ":
            at += part[1]
    if at == len(data):
        return b"", np.array([at], np.int64)
    if dummy and not suffix:
        put(blank, at)
    after_blank = trim
    while at < len(data):
        part, width = step(at)
        if after_blank:
            part = part.lstrip(b" ")
        if part:
            put(part.replace(b" ", blank), at)
            after_blank = trim and part.endswith(b" ")
        at += width
    end = at
    if trim:
        while out.endswith(blank):
            end = source[len(out) - len(blank)]
            del out[-len(blank) :], source[-len(blank) :]
    if dummy and suffix:
        put(blank, end)
    return bytes(out), np.array([*source, end], np.int64)


class PieceEncoder:
    def __init__(self, model: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as schema

        with open(model, "rb") as file:
            blob = file.read()
        proto = schema.ModelProto()
        proto.ParseFromString(blob)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=blob)
        spec = proto.normalizer_spec
        self.chars = CharacterMap(spec.precompiled_charsmap)
        self.rules = {
            "dummy": spec.add_dummy_prefix,
            "trim": spec.remove_extra_whitespaces,
            "escape": spec.escape_whitespaces,
            "suffix": proto.trainer_spec.treat_whitespace_as_suffix,
        }
        kinds = schema.ModelProto.SentencePiece
        pieces = [p.piece for p in proto.pieces]
        is_byte = np.array([p.type == kinds.BYTE for p in proto.pieces])
        self.is_unknown = np.array([p.type == kinds.UNKNOWN for p in proto.pieces])
        # Length in the normalised text, and in a source that differs from it by blanks only.
        self.length = np.where(is_byte, 1, [len(p.encode()) for p in pieces])
        self.width = np.where(is_byte, 1, [len(p.replace(BLANK, " ").encode()) for p in pieces]).astype("<i4")
        self.end = self.library.eos_id()
        plain = [p.piece for p in proto.pieces if p.type == kinds.NORMAL]
        self.by_word = (
            not self.chars.units
            and self.rules == {"dummy": True, "trim": False, "escape": True, "suffix": False}
            and proto.trainer_spec.model_type == schema.TrainerSpec.BPE
            and proto.trainer_spec.byte_fallback
            and not any(p.type == kinds.USER_DEFINED for p in proto.pieces)
            and not any(BLANK in p.lstrip(BLANK) for p in plain)
        )
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.held = 0  # characters of the known words

    def cut(self, text: str) -> list[str] | None:
        """The words of a text, without the space before them; None if it must stay whole."""
        if not self.by_word or not text or text[0] == " " or text[-1] == " " or BLANK in text:
            return None
        return _WORD_END.split(text) if "  " in text else text.split(" ")

    def learn(self, words: set[str]) -> None:
        if len(self.known) > CACHED_WORDS or self.held > CACHED_CHARS:
            self.known.clear()
            self.held = 0
        new = [w for w in words if w not in self.known]
        self.held += sum(map(len, new))
        for at in range(0, len(new), 5000):
            some = new[at : at + 5000]
            encoded = self.library.encode(some, num_threads=1)
            ends = np.cumsum([len(e) for e in encoded]) * 4
            ids = np.array([i for e in encoded for i in e], "<i4")
            coded, widths = ids.tobytes(), self.width[ids].tobytes()
            a = 0
            for word, b in zip(some, ends.tolist(), strict=True):
                self.known[word] = coded[a:b], widths[a:b]
                a = b

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids with the end id, and begin and end of each piece in the bytes of its text."""
        cut = [self.cut(t) for t in texts]
        self.learn({w for words in cut if words for w in words})
        for text, words in zip(texts, cut, strict=True):
            if words is None:
                yield self._whole(text)
                continue
            found = [self.known[w] for w in words]
            ids = np.frombuffer(b"".join([f[0] for f in found]), "<i4")
            ends = np.cumsum(np.frombuffer(b"".join([f[1] for f in found]), "<i4")) - 1  # no space in front
            yield np.append(ids, self.end), np.concatenate(([0], ends)), np.append(ends, ends[-1])

    def _whole(self, text: str):
        data = text.encode()
        normal, source = normalise(data, self.chars, **self.rules)
        ids = np.array(self.library.encode(text, num_threads=1), np.int64)
        lengths = self.length[ids] if len(ids) else np.zeros(0, np.int64)
        if self.is_unknown[ids].any():  # the library knows how long an unknown piece is
            pieces = self.library.encode(text, out_type=str, num_threads=1)
            lengths = np.where(self.is_unknown[ids], [len(p.encode()) for p in pieces], lengths)
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        if bounds[-1] != len(normal):
            raise ValueError(f"pieces cover {bounds[-1]} of {len(normal)} normalised bytes")
        last = source[bounds[-1]]
        return (
            np.append(ids, self.end),
            np.append(source[bounds[:-1]], last),
            np.append(source[bounds[1:]], last),
        )

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids, num_threads=1)


@lru_cache(maxsize=4)
def encoder(model: str) -> PieceEncoder:
    """One encoder per worker process."""
    return PieceEncoder(model)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays])))
    values = np.concatenate(arrays) if arrays else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.astype(np.int32)))


def encode(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id``, ``ids``, ``begins``, ``ends`` and ``decoded`` of every row of ``docs``.

    ``ids`` end with the end id.  Begin and end of each piece count bytes of the text's UTF-8.
    ``decoded`` is what the library makes of the ids.  Null texts count as empty.
    """
    small_batches(docs.sparkSession, 256)

    def run(batches):
        tool = encoder(model)
        for batch in batches:
            coded = list(tool.encode([t or "" for t in batch.column(1).to_pylist()]))
            ids, begins, ends = zip(*coded, strict=True) if coded else ((), (), ())
            decoded = tool.decode([i.tolist() for i in ids]) if ids else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _lists(ids), _lists(begins), _lists(ends), pa.array(decoded, pa.string())],
                ["doc_id", "ids", "begins", "ends", "decoded"],
            )

    schema = "doc_id long, ids array<int>, begins array<int>, ends array<int>, decoded string"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id`` and ``text`` of rows with ``ids``; null ids give an empty text."""

    def run(batches):
        for batch in batches:
            ids = [i or [] for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(encoder(model).decode(ids), pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(
        run, "doc_id long, text string"
    )


def digests(encoded: DataFrame) -> DataFrame:
    """Of each row of ``encode``: number of ids, bytes its pieces cover, digests of ids and decoded text."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.element_at("ends", -1).cast("long").alias("n_bytes"),
    )

"""Repeated passages by hashing of lines and their sentences.

A text is cut into units: lines, and within a line wherever one end mark stands between a
word and a blank, so that a passage is found even where it was pasted into another line.
Units are normalised (lower case, runs of blanks as one) and hashed.  Digests are grouped
over all documents; of equal units the earliest stays: the one in the document with the
smallest id, and there the first.  All others are repeats.  Repeats that follow each other
form a stretch.

A passage pasted into the middle of a sentence shares only a part of its first and last unit with
the kept document.  So a stretch is extended, on both sides, by the words that the unit beside it
has in common with the unit beside the kept one.  Extended stretches are passages; they are
reported or cut out if they have at least ``min_words`` words, by default all of them.  A passage
that holds no whole unit has no digest in common with another text and is not found.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinspark.llm.common import own_name, small_batches
from clinspark.session import stage

MIN_WORDS = 1
# A unit ends at a line break, or at a lone end mark after a word and before a blank.
_END = re.compile(r"\n|(?<=[^\W_][.!?])(?=\s)")


def units(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """Begin, end and lower-case words of each unit of a text that has words; blanks around are left out."""
    begin = 0
    for end in [*(m.end() for m in _END.finditer(text)), len(text)]:
        raw = text[begin:end]
        words = raw.lower().split()
        if words:
            lead = len(raw) - len(raw.lstrip())
            yield begin + lead, begin + len(raw.rstrip()), words
        begin = end


def _digest(words: list[str]) -> bytes:
    return hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=12).digest()


def _sum(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) >> 1


def unit_rows(docs: DataFrame) -> DataFrame:
    """A row per unit: ``doc_id``, ``mark``, ``unit`` (running number), ``begin``, ``end``, ``n_words``, ``digest``, ``again``,
    ``before``, ``after``.

    ``mark`` is a hash of the text, ``again`` tells whether the same unit stands earlier in the
    same text, ``before`` and ``after`` are checksums of the words around the unit (null at the
    ends of the text).  Offsets count characters.  Null texts have no units.
    """
    small_batches(docs.sparkSession)
    names = ["doc_id", "mark", "unit", "begin", "end", "n_words", "digest", "again", "before", "after"]

    def run(batches):
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, mark, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                seen: set[bytes] = set()
                found = list(units(text or ""))
                firsts = [_sum(words[0]) for _, _, words in found]
                lasts = [_sum(words[-1]) for _, _, words in found]
                around = zip(found, [None, *lasts], [*firsts[1:], None], strict=False)
                for i, ((begin, end, words), before, after) in enumerate(around):
                    digest = _digest(words)
                    rows.append((doc_id, mark, i, begin, end, len(words), digest, digest in seen, before, after))
                    seen.add(digest)
                if len(rows) > 20_000:
                    yield pa.RecordBatch.from_arrays(_columns(rows), names)
                    rows = []
            yield pa.RecordBatch.from_arrays(_columns(rows), names)

    schema = (
        "doc_id long, mark long, unit int, begin int, end int, n_words int, digest binary, again boolean, before int, after int"
    )
    return _marked(docs).mapInArrow(run, schema)


def _marked(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("mark"), text.alias("text"))


def _columns(rows: list[tuple]) -> list[pa.Array]:
    i32 = pa.int32()
    types = [pa.int64(), pa.int64(), i32, i32, i32, i32, pa.binary(), pa.bool_(), i32, i32]
    columns = zip(*rows, strict=True) if rows else [[]] * len(types)
    return [pa.array(c, t) for c, t in zip(columns, types, strict=True)]


def _repeated(docs: DataFrame) -> DataFrame:
    """The rows of all units that occur more than once, with ``keep_id``."""
    rows = stage(unit_rows(docs), "units")
    grouped = rows.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("n")).where("n > 1")
    # Staged, so that the join has a plain shuffle on both sides: the rows of a very common unit can then be split.
    grouped = stage(grouped.select("digest", "keep_id"), "repeated-units")
    return rows.join(grouped, "digest")


def _runs(repeated: DataFrame) -> DataFrame:
    """Stretches, with their first and last unit (``first``, ``last``)."""
    repeats = (
        repeated.where((F.col("doc_id") > F.col("keep_id")) | (F.col("again") & F.col("doc_id").isNotNull()))
        .drop("again")
        .distinct()
    )
    in_text = Window.partitionBy("doc_id", "mark").orderBy("unit")
    return (
        repeats.withColumn("stretch", F.col("unit") - F.row_number().over(in_text))
        .groupBy("doc_id", "mark", "stretch")
        .agg(
            F.min("begin").alias("begin"),
            F.max("end").alias("end"),
            F.count("*").alias("n_units"),
            F.sum("n_words").alias("n_words"),
            F.min("keep_id").alias("keep_id"),
            F.min(F.struct("unit", "digest", "before")).alias("first"),
            F.max(F.struct("unit", "digest", "after")).alias("last"),
        )
    )


def stretches(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Stretches of whole repeated units: ``doc_id``, ``begin``, ``end``, ``n_units``, ``n_words``, ``keep_id``.

    ``keep_id`` is the smallest id of the documents that keep the units.  Rows with the same id
    count as one document, whose units are not repeats of each other across its rows; rows
    without id come after all others and are never reported, as nothing can name them.
    """
    return _runs(_repeated(docs)).where(F.col("n_words") >= min_words).drop("mark", "stretch", "first", "last")


def _edges(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Words, their offsets and the digest of the ``wanted`` units (``id``, ``mark``, ``unit``)."""
    per_text = wanted.groupBy("id", "mark").agg(F.collect_set("unit").alias("wanted"))  # of one text
    texts = _marked(docs).withColumnRenamed("doc_id", "id").join(per_text, ["id", "mark"])
    names = ["id", "mark", "unit", "words", "begins", "ends", "digest"]
    ints = pa.list_(pa.int32())
    types = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.string()), ints, ints, pa.binary()]

    def run(batches):
        for batch in batches:
            for doc_id, mark, text, numbers in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                numbers, rows = set(numbers), []
                for i, (begin, end, words) in enumerate(units(text)):
                    if i in numbers:
                        at = [m.span() for m in re.compile(r"\S+").finditer(text, begin, end)]
                        rows.append((doc_id, mark, i, words, [a for a, _ in at], [b for _, b in at], _digest(words)))
                columns = zip(*rows, strict=True) if rows else [[]] * len(types)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
                )

    schema = "id long, mark long, unit int, words array<string>, begins array<int>, ends array<int>, digest binary"
    found = texts.select("id", "mark", "text", "wanted").mapInArrow(run, schema)
    return found.dropDuplicates(["id", "mark", "unit"])


def passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Stretches with the words around them that the kept document has too.

    ``doc_id``, ``begin``, ``end``, ``n_units`` (whole repeated ones), ``n_words``, ``keep_id``, and
    ``cut_begin`` and ``cut_end``, which leave out the words of a unit that is itself kept for others.
    """
    return _passages(docs, min_words).drop("mark")


def _passages(docs: DataFrame, min_words: int) -> DataFrame:
    found = stage(_repeated(docs), "repeated-rows")
    runs = stage(_runs(found), "stretches")
    heads = (
        found.where((F.col("doc_id") == F.col("keep_id")) & ~F.col("again"))
        .groupBy("digest")
        .agg(F.min(F.struct("doc_id", "mark", "unit", "before", "after")).alias("head"))
    )
    heads = stage(heads, "kept-units")

    # Sides on which at least the next word is the same, by its checksum.
    sides = []
    for side, edge, near, step in (("left", "first", "before", -1), ("right", "last", "after", 1)):
        one = runs.select("doc_id", "mark", "stretch", F.col(edge)["unit"].alias("unit"), F.col(edge)["digest"].alias("digest"), F.col(edge)[near].alias("near"))
        one = one.where("near is not null").join(heads, "digest").where(F.col("near") == F.col("head")[near])
        sides.append(
            one.select(
                "doc_id",
                "mark",
                "stretch",
                F.lit(side).alias("side"),
                (F.col("unit") + step).alias("unit"),
                F.col("head")["doc_id"].alias("kept_id"),
                F.col("head")["mark"].alias("kept_mark"),
                (F.col("head")["unit"] + step).alias("kept_unit"),
            )
        )
    sides = stage(sides[0].union(sides[1]), "stretch-sides")
    here = sides.select(F.col("doc_id").alias("id"), "mark", "unit")
    there = sides.select("kept_id", "kept_mark", "kept_unit")
    edges = stage(_edges(docs, here.union(there).distinct()), "stretch-edges")
    kept = edges.select(F.col("id").alias("kept_id"), F.col("mark").alias("kept_mark"), F.col("unit").alias("kept_unit"), F.col("words").alias("kept_words"))
    used = heads.select("digest", F.lit(True).alias("used"))
    mine = stage(edges.join(used, "digest", "left").drop("digest").withColumnRenamed("id", "doc_id"), "stretch-edges-used")
    pairs = sides.join(mine, ["doc_id", "mark", "unit"]).join(kept, ["kept_id", "kept_mark", "kept_unit"])
    left = F.col("side") == "left"
    a = F.when(left, F.reverse("words")).otherwise(F.col("words"))
    b = F.when(left, F.reverse("kept_words")).otherwise(F.col("kept_words"))
    # Null where one of them ends: the first place that is not true is the end of the common words.
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    stop = F.array_position(same, False)
    common = F.when(stop > 0, stop - 1).otherwise(F.size("words")).cast("int")
    pairs = pairs.withColumn("common", common).where("common > 0")
    at = F.when(left, F.element_at("begins", -F.col("common"))).otherwise(F.element_at("ends", F.col("common")))
    grown = pairs.select("doc_id", "mark", "stretch", "side", "common", at.alias("at"), F.col("used").isNull().alias("free"))
    grown = grown.groupBy("doc_id", "mark", "stretch").agg(
        F.sum("common").alias("common"),
        *[
            F.max(F.when((F.col("side") == side) & (F.col("free") | ~F.lit(free)), F.col("at"))).alias(f"{side}{free}")
            for side in ("left", "right")
            for free in (False, True)
        ],
    )
    return (
        runs.join(grown, ["doc_id", "mark", "stretch"], "left")
        .select(
            "doc_id",
            "mark",
            F.coalesce("leftFalse", "begin").alias("begin"),
            F.coalesce("rightFalse", "end").alias("end"),
            "n_units",
            (F.col("n_words") + F.coalesce("common", F.lit(0))).alias("n_words"),
            "keep_id",
            F.coalesce("leftTrue", "begin").alias("cut_begin"),
            F.coalesce("rightTrue", "end").alias("cut_end"),
        )
        .where(F.col("n_words") >= min_words)
    )


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the passages cut out of ``text``; ``kept_spans`` has the original offsets of what is left.

    Documents of which nothing is left keep an empty text.
    """
    found = own_name(docs, "cuts")
    at = own_name(docs, "cut_id")
    mark = own_name(docs, "cut_mark")
    span = F.struct(F.col("cut_begin").alias("begin"), F.col("cut_end").alias("end"))
    cuts = (
        _passages(docs, min_words)
        .groupBy(F.col("doc_id").alias(at), F.col("mark").alias(mark))
        .agg(F.array_sort(F.collect_list(span)).alias(found))  # of one text
    )
    same_text = F.xxhash64(docs["text"].cast("string")) == F.col(mark)
    joined = docs.join(cuts, (docs["doc_id"] == F.col(at)) & same_text, "left")
    size = F.length(F.coalesce("text", F.lit("")))
    gaps = F.concat(F.expr("array(0)"), F.coalesce(F.col(found)["end"], F.expr("array()").cast("array<int>")))
    stops = F.concat(F.coalesce(F.col(found)["begin"], F.expr("array()").cast("array<int>")), F.array(size))
    spans = F.filter(
        F.arrays_zip(gaps.alias("begin"), stops.alias("end")), lambda s: s["begin"] < s["end"]
    )
    spans = spans.cast("array<struct<begin:int,end:int>>")
    kept = own_name(docs, "kept_spans")
    cut = F.array_join(
        F.transform(F.col(kept), lambda s: F.substr(F.col("text"), s["begin"] + 1, s["end"] - s["begin"])), ""
    )
    return joined.withColumn(kept, spans).withColumn(
        "text", F.when(F.col("text").isNotNull(), cut)
    ).select([F.col(f"`{c}`") for c in docs.columns] + [kept])

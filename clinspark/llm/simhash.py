"""SimHash near-duplicates, compared bit-sliced.

A fingerprint has 64 bits: bit i is set if it is set in over half of the hashes of a text's
word shingles.  Two fingerprints link at ``radius`` or fewer differing bits.  Equal ones are
collapsed first.  Two that link agree outside of ``radius`` bytes, so each fingerprint is
sent to one bucket per choice of ``radius`` of its eight bytes, keyed by the other bytes.
With radius 2 these are 28 buckets, and a bucket cannot hold more than 2 ** 16 different
fingerprints, whatever the data: no bucket needs a cap, and no hot bucket exists.

Inside a bucket 64 members form a block, stored as bit planes: one machine word per bit
position, one lane per member.  A fingerprint meets a whole block at once; the differing
bits are added up lane by lane with carry-save counters, and a block is abandoned as soon
as all of its lanes exceed the radius.  Only the links of a spanning forest leave a bucket.

Groups are the components of the links, found by alternating large-star and small-star
steps whose links lie in the stage folder after every round.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinspark.llm.common import own_name, shuffle_partitions, small_batches
from clinspark.session import stage

SEED = 42
PIECE = 1 << 20  # bytes of a text that are cut into words at a time
BYTES = 8
CHUNK = 1 << 19  # pairs of a fingerprint and a block that are compared at a time
_BLANK = b" \t\n\v\f\r"
# For each byte, its bits spread over the eight bytes of a word.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def _word_runs(data: bytes) -> Iterator[list[bytes]]:
    """The words of ``data``, from pieces that end at blanks."""
    at = 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        while end < len(data) and data[end] not in _BLANK:
            end += 1
        yield data[at:end].split()  # exactly the six ASCII blanks
        at = end


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """The fingerprint of one text; 0 without words."""
    ones, total, held = np.zeros(64, dtype=np.int64), 0, []
    for words in _word_runs((text or "").encode().lower()):  # bytes.lower() changes A-Z only
        words = held + words
        n = len(words) - shingle_words + 1
        if n < 1:
            held = words
            continue
        held = words[n:]
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[: n - 1] + 1)).tolist()
        hashed = [xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts, ends[shingle_words - 1 :].tolist(), strict=True)]
        ones += _bit_counts(np.array(hashed, dtype=np.uint64))
        total += n
    if not total:
        if not held:
            return 0
        total, ones = 1, _bit_counts(np.array([xxhash.xxh64_intdigest(b" ".join(held), SEED)], dtype=np.uint64))
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of ``hashes`` have each of the 64 bits set."""
    spread = _SPREAD[hashes.view(np.uint8).reshape(-1, 8)]
    out = np.zeros(64, dtype=np.int64)
    for at in range(0, len(spread), 255):  # a byte counts to 255
        out += spread[at : at + 255].sum(axis=0, dtype=np.uint64).view(np.uint8)
    return out


def _marked(rows: DataFrame, shingle_words: int) -> DataFrame:
    """``rows``, whose last column is ``text``, with ``fp`` (the 64 bits as a long) in its place."""
    small_batches(rows.sparkSession)
    names = [*rows.columns[:-1], "fp"]

    def run(batches):
        for batch in batches:
            values = [fingerprint(t.as_py(), shingle_words) for t in batch.columns[-1]]
            fps = np.array(values, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps)], names)

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], T.StructField("fp", T.LongType())]))


def fingerprints(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """``doc_id`` and ``fp`` of every row; null counts as empty."""
    return _marked(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), shingle_words)


def compare(fps: np.ndarray, starts: np.ndarray, planes: list[int], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of members of the same bucket that differ in ``radius`` or fewer of ``planes``.

    ``starts`` has the first position of each bucket.  Members of a bucket form blocks of 64
    lanes; each member meets its own block (later lanes only) and the blocks after it.
    """
    sizes = np.diff(np.append(starts, len(fps)))
    within = np.arange(len(fps)) - np.repeat(starts, sizes)
    lane = (within % 64).astype(np.uint64)
    first = np.flatnonzero(within % 64 == 0)  # the first member of each block
    block_of = np.cumsum(within % 64 == 0) - 1
    last_block = np.repeat(block_of[starts + sizes - 1], sizes)
    words = {b: np.bitwise_or.reduceat(((fps >> np.uint64(b)) & np.uint64(1)) << lane, first) for b in planes}
    filled = np.bitwise_or.reduceat(np.uint64(1) << lane, first)
    full, one = np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(1)

    span = last_block - block_of + 1
    left, right = [], []
    edges = np.searchsorted(np.cumsum(span), np.arange(0, span.sum() + CHUNK, CHUNK))
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        n = span[lo:hi]
        if not len(n):
            continue
        member = np.repeat(np.arange(lo, hi), n)
        block = block_of[member] + np.arange(len(member)) - np.repeat(np.cumsum(n) - n, n)
        alive = filled[block]
        own = block == block_of[member]
        alive[own] &= (full << lane[member[own]]) << one
        keep = alive != 0
        member, block, alive = member[keep], block[keep], alive[keep]
        digits = [np.zeros(len(member), np.uint64) for _ in range(radius.bit_length())]
        for k, b in enumerate(planes):
            carry = words[b][block] ^ (np.uint64(0) - ((fps[member] >> np.uint64(b)) & one))
            for i, digit in enumerate(digits):
                digits[i], carry = digit ^ carry, digit & carry
            alive &= ~carry  # beyond what the counters hold
            if k % 4 == 3 or b == planes[-1]:
                alive &= ~_exceeds(digits, radius)
                keep = alive != 0
                if not keep.all():
                    member, block, alive = member[keep], block[keep], alive[keep]
                    digits = [d[keep] for d in digits]
        bits = np.unpackbits(alive.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, bit = np.nonzero(bits)
        left.append(member[row])
        right.append(first[block[row]] + bit)
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def _exceeds(digits: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter (lowest digit first) is above ``radius``."""
    above = np.zeros_like(digits[0])
    level = ~above
    for i in reversed(range(len(digits))):
        if radius >> i & 1:
            level = level & digits[i]
        else:
            above = above | (level & digits[i])
            level = level & ~digits[i]
    return above


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of ``n`` positions the smallest position its links lead to."""
    label = np.arange(n)
    while len(left):
        a, b = label[left], label[right]
        differ = a != b
        left, right, a, b = left[differ], right[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(label, label[label]):
            label = label[label]
    return label


def _bucket_links(radius: int):
    """Reads rows (choice, key, fp) in order; writes the links of each bucket's spanning forest."""
    choices = list(combinations(range(BYTES), radius))

    def solve(choice: np.ndarray, key: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(fps):
            return
        new = np.append(True, (choice[1:] != choice[:-1]) | (key[1:] != key[:-1]))
        size = np.diff(np.append(np.flatnonzero(new), len(fps)))
        shared = np.repeat(size > 1, size)
        choice, fps, new = choice[shared], fps[shared], new[shared]
        for c in np.unique(choice):
            mine = choice == c
            group, starts = fps[mine], np.flatnonzero(new[mine])
            planes = [8 * byte + i for byte in choices[c] for i in range(8)]
            label = forest(len(group), *compare(group, starts, planes, radius))
            linked = np.flatnonzero(label != np.arange(len(group)))
            u, v = group[linked].view(np.int64), group[label[linked]].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    def run(batches):
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)]
        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            new = [new[0].astype(np.int64), new[1], new[2].view(np.uint64)]
            held = [np.concatenate(x) for x in zip(held, new, strict=True)]
            if len(held[0]) < 1 << 18:
                continue
            last = (held[0] == held[0][-1]) & (held[1] == held[1][-1])  # may go on in the next batch
            yield from solve(*[x[~last] for x in held])
            held = [x[last] for x in held]
        yield from solve(*held)

    return run


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """Links ``u``, ``v`` between different fingerprints (``fp``) that connect all that are within ``radius``."""
    if radius == 0:
        return distinct.select(F.col("fp").alias("u"), F.col("fp").alias("v")).where("false")
    if radius > 3:
        raise ValueError("radius may be 0 to 3: beyond, the buckets of this method grow too large")
    keys = []
    for i, choice in enumerate(combinations(range(BYTES), radius)):
        mask = sum(0xFF << 8 * b for b in range(BYTES) if b not in choice)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(signed)).alias("key")))
    spark = distinct.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")  # narrow rows
    return (
        distinct.select("fp", F.explode(F.array(*keys)).alias("k"))
        .select("k.choice", "k.key", "fp")
        .repartition(shuffle_partitions(spark), "choice", "key")
        .sortWithinPartitions("choice", "key", "fp")
        .mapInArrow(_bucket_links(radius), "u long, v long")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node it is connected with) of every node in ``edges`` (``u``, ``v``)."""
    larger, smaller = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    stars = stage(edges.where("u <> v").select(larger, smaller).distinct(), "stars")
    seen = None
    while True:
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
        # Large star: larger neighbours move to the smallest neighbour (or the node itself).
        both = stars.union(stars.select(F.col("v"), F.col("u"))).toDF("u", "v")
        lowest = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "stars-low")
        large = stage(
            both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
            "stars-large",
        )
        # Small star: smaller neighbours, and the node, move to the smallest of them.
        lowest = stage(large.groupBy("u").agg(F.min("v").alias("m")), "stars-low")
        moved = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = stage(moved.union(lowest.select("u", F.col("m").alias("v"))).distinct(), "stars")
    roots = stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(stars.select(F.col("v"), F.col("v")).distinct())


def _grouped(marked: DataFrame, radius: int) -> DataFrame:
    """``fp`` and ``component_id`` of the fingerprints in ``marked`` (``doc_id``, ``fp``)."""
    distinct = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "fingerprints-distinct")
    roots = stage(components(links(distinct.select("fp"), radius)), "roots")
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return stage(rooted.join(least, "root").select("fp", "root", "component_id"), "fingerprint-groups")


def near_groups(docs: DataFrame, shingle_words: int = 3, radius: int = 2) -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id`` (smallest id in reach) of every row of ``docs``.

    Null texts count as empty; texts without words share the fingerprint zero and are linked
    like any others.  Rows that repeat an id each get a row.  A group of null ids only has a
    null component.
    """
    marked = stage(fingerprints(docs, shingle_words), "fingerprints")
    return marked.join(_grouped(marked, radius), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def without_near_copies(docs: DataFrame, shingle_words: int = 3, radius: int = 2) -> DataFrame:
    """One row of each group of ``docs``, with its columns as they were.

    It is the row with the smallest ``doc_id`` (rows without one come last), and of rows that
    share it the one with the smallest hash of all columns.
    """
    one, two, times = (own_name(docs, name) for name in ("row_key", "row_key_too", "row_times"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.withColumns({one: F.xxhash64(*columns), two: F.xxhash64(F.lit(1), *columns)})
    narrow = rows.select(
        F.col(one).alias("one"), F.col(two).alias("two"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string")
    )
    marked = stage(_marked(narrow, shingle_words), "fingerprints")
    # Rows that are alike in every column share their key.
    known = marked.groupBy("one", "two", "doc_id", "fp").agg(F.count("*").alias("times"))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "one", "two", "times")
    first = (
        known.join(_grouped(marked, radius), "fp")
        .groupBy("root")
        .agg(F.min(place).alias("first"))
        .select(F.col("first.one").alias(one), F.col("first.two").alias(two), F.col("first.times").alias(times))
    )
    first = stage(first, "near-kept")
    kept = rows.join(first.where(F.col(times) == 1), [one, two], "left_semi")
    several = first.where(F.col(times) > 1)
    if not several.isEmpty():
        kept = kept.unionByName(rows.join(several, [one, two], "left_semi").dropDuplicates([one, two]))
    return kept.select(columns)

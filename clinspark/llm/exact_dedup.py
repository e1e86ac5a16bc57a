"""Exact duplicates through an extendible-hash index, in DataFrame operations only.

Every text is normalised (each run of blanks becomes one space) and hashed.  The index
directory is addressed by the leading bits of the hash.  It starts as one bucket and
doubles: at every depth a bucket that holds more rows than its capacity splits in two,
until it fits or the deepest level is reached.  A bucket that still does not fit holds
one key with very many rows (or many colliding ones) and continues on overflow pages,
so that no owner task takes more than about one capacity of rows per bucket or page.

Owner tasks then take whole buckets, that is ranges of the hash.  There the rows of a
hash are chained by comparing the bytes of their texts; one entry (first id, rows) is
left per distinct text, and the entries of overflow pages are merged by the same test.

The index files (id, hash, digest) and the directory lie in the shared stage folder,
so a lost executor costs a re-read.  The capacity follows the number of rows, which
bounds the directory to a few thousand slots however large the input is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinspark.llm.common import BLANKS, own_name, shuffle_partitions, whole
from clinspark.session import stage

DEPTH = 14  # directory doublings at most
BUCKETS = 4096  # a capacity is chosen so that about this many buckets are in use
LEAST_CAPACITY = 16


def normalised(text: str = "text") -> Column:
    """The text with each run of blanks replaced by one space; null counts as empty."""
    return F.regexp_replace(whole(text), f"[{BLANKS}]+", " ")


def _hash(norm: Column, hash_bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(norm), 64 - hash_bits)


def directory(index: DataFrame, rows: int, hash_bits: int = 64) -> DataFrame:
    """Slots of the directory: ``slot`` (leading bits at the deepest level), ``bucket``, ``depth``, ``pages``."""
    depth = min(DEPTH, hash_bits)
    capacity = max(LEAST_CAPACITY, rows // BUCKETS)
    cells = index.groupBy(_slot(hash_bits).alias("slot")).agg(F.count("*").alias("n"))
    levels = cells.select("slot", "n", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("depth"))
    prefix = F.expr(f"shiftright(slot, {depth} - depth)")
    counted = levels.groupBy("depth", prefix.alias("prefix")).agg(F.sum("n").alias("held"))
    # A slot belongs to the first depth at which its bucket fits.
    fits = (F.col("held") <= capacity) | (F.col("depth") == depth)
    chosen = (
        levels.select("slot", "depth", prefix.alias("prefix"))
        .join(counted, ["depth", "prefix"])
        .where(fits)
        .groupBy("slot")
        .agg(F.min("depth").alias("depth"))
    )
    held = F.expr(f"shiftright(slot, {depth} - depth)")
    pages = F.greatest(F.lit(1), F.ceil(F.col("held") / capacity)).cast("int")
    return (
        chosen.select("slot", "depth", held.alias("prefix"))
        .join(counted, ["depth", "prefix"])
        .select(
            "slot",
            "depth",
            F.expr(f"shiftleft(prefix, {depth} - depth)").alias("bucket"),
            F.when(F.col("depth") == depth, pages).otherwise(1).alias("pages"),
        )
    )


def _slot(hash_bits: int) -> Column:
    return F.shiftrightunsigned(F.col("h"), max(0, hash_bits - DEPTH))


def _index(docs: DataFrame, hash_bits: int) -> tuple[DataFrame, DataFrame]:
    """The index file (``doc_id``, ``h``, ``sha``) and its entries (``h``, ``sha``, ``keep_id``, ``group_size``)."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", normalised().alias("norm")).withColumn("h", _hash(F.col("norm"), hash_bits))
    index = stage(texts.select("doc_id", "h", F.sha2("norm", 256).alias("sha")), "dedup-index")
    slots = stage(directory(index, index.count(), hash_bits), "dedup-directory")

    page = F.pmod(F.xxhash64("doc_id"), F.col("pages").cast("long"))
    owned = (
        texts.withColumn("slot", _slot(hash_bits))
        .join(F.broadcast(slots), "slot")  # at most 2 ** DEPTH rows
        .select("doc_id", "norm", "h", "bucket", "pages", page.alias("page"))
        .repartition(shuffle_partitions(spark), "bucket", "page")
    )
    chained = owned.groupBy("bucket", "page", "pages", "h", "norm").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("n")
    )
    # Only entries on overflow pages can meet their like again; the others need no bytes any more.
    entries = (
        chained.select(
            "h",
            F.sha2("norm", 256).alias("sha"),
            F.when(F.col("pages") > 1, F.col("norm")).alias("bytes"),
            "first",
            "n",
        )
        .groupBy("h", "sha", "bytes")
        .agg(F.min("first").alias("keep_id"), F.sum("n").alias("group_size"))
    )
    return index, entries.drop("bytes")


def duplicates(docs: DataFrame, hash_bits: int = 64) -> DataFrame:
    """Mark the copies among ``docs`` (``doc_id``, ``text``; other columns are ignored).

    Returns a row per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256``.  Of equal texts the smallest ``doc_id`` stays; a null id comes after
    all others, and a group of null ids only has a null ``keep_id`` and is kept.  Rows that
    repeat an id with the same text count in ``group_size`` and are marked alike.
    ``hash_bits`` shortens the index hash (tests use it to force collisions).
    """
    index, entries = _index(docs, hash_bits)
    return index.join(entries, ["h", "sha"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row per distinct text, all columns as they were.

    The row with the smallest ``doc_id`` stays; of rows that repeat both id and text, the one
    whose columns hash lowest.
    """
    digest, turn, key = (own_name(docs, x) for x in ("copy_sha", "copy_turn", "copy_key"))
    _, entries = _index(docs, 64)
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    kept = entries.select(named("keep_id").alias(key), F.col("sha").alias(digest))
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    turns = F.row_number().over(Window.partitionBy(key, digest).orderBy(row_hash))
    return (
        docs.withColumn(key, named("doc_id"))
        .withColumn(digest, F.sha2(normalised(), 256))
        .join(kept, [key, digest], "left_semi")
        .withColumn(turn, turns)
        .where(F.col(turn) == 1)
        .select([F.col(f"`{c}`") for c in docs.columns])
    )

"""Mixing sources to target weights.

Each document gets a hash-random key, from its id and its text: rows that share an id, or have
none, are spread like others.  The documents of a source are ranged by that key;
as keys are uniform, the bounds of the ranges are known without sampling: a source of n
rows has about n / 1000 equal key ranges (blocks).  Sums per block, then running sums over
blocks and groups of blocks, give every block its offset, and one sort inside each block
gives every document its place in its source's prefix sum.  The mix takes whole passes
over a source while they fit its target, and in the last pass the documents whose middle
lies before the cut; so a source misses its target by half a document at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinspark.llm.common import WORD, whole
from clinspark.session import stage

WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
BLOCK_ROWS = 1000
GROUP_BLOCKS = 1000


def words(text: str = "text") -> Column:
    """Number of words; null counts as empty."""
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """Per source (``source``, ``source_size``) its ``target`` and running number ``source_no``.

    Sources by code point, null last, weigh ``weights`` in turn.  A target stops at ``most``
    times the source's size, and what is left over is shared anew by weight among the others.
    The sources that stop are those with the smallest size per weight, so one sort by that
    ratio finds them: a source stops if its limit is not above its share of what all
    sources before it leave.
    """
    everywhere = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("source_no") - 1) % len(weights) + 1).cast("int"))
    numbered = sizes.withColumn("source_no", F.row_number().over(everywhere)).withColumn("weight", weight.cast("long"))
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), "source_no")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy()
    ranked = (
        numbered.withColumn("limit", F.col("source_size") * most)
        .withColumn("left_words", F.sum("source_size").over(all_rows) - F.coalesce(F.sum("limit").over(before), F.lit(0)))
        .withColumn("left_weight", F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("stops", F.col("limit") * F.col("left_weight") <= F.col("left_words") * F.col("weight"))
    )
    # The first source that does not stop fixes the share of all that follow.
    first_open = lambda c: F.max(F.when(~F.col("stops"), F.col(c))).over(all_rows)
    target = F.when(F.col("stops"), F.col("limit").cast("double")).otherwise(
        (F.col("weight") * first_open("left_words")).cast("double") / first_open("left_weight")
    )
    return ranked.select("source", "source_no", "source_size", target.alias("target"))


def _placed(docs: DataFrame, weights: tuple, most: int, seed: str) -> DataFrame:
    """Rows of ``docs`` (column i is called ``c<i>``) with ``size``, ``source_size``, ``target`` and ``copies``."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    key = F.md5(F.concat(F.lit(f"{seed}:"), doc_id, F.lit(":"), F.md5(whole())))
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("long") / float(1 << 32)
    rows = docs.select(
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)],
        F.col("source").alias("source"),
        words().alias("size"),
        key.alias("key"),
    )
    per_source = stage(
        rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows")), "mix-sources"
    )
    plan = stage(
        targets(per_source, weights, most)
        .join(per_source.select(F.col("source").alias("s"), "source_rows"), F.col("source").eqNullSafe(F.col("s")))
        .select(
            F.col("source").alias("plan_source"),
            "source_no",
            "source_size",
            "target",
            F.ceil(F.col("source_rows") / BLOCK_ROWS).alias("blocks"),
        ),
        "mix-plan",
    )
    placed = (
        rows.join(plan, F.col("source").eqNullSafe(F.col("plan_source")))
        .withColumn("block", F.floor(place * F.col("blocks")))
        .drop("source", "plan_source", "blocks")
    )
    sums = stage(placed.groupBy("source_no", "block").agg(F.sum("size").alias("block_size")), "mix-blocks")
    group = F.floor(F.col("block") / GROUP_BLOCKS)

    def earlier(order: str, *by: str):
        return Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    groups = (
        sums.groupBy("source_no", group.alias("grp"))
        .agg(F.sum("block_size").alias("group_size"))
        .withColumn("before_group", F.sum("group_size").over(earlier("grp", "source_no")))
    )
    offsets = (
        sums.withColumn("grp", group)
        .withColumn("in_group", F.sum("block_size").over(earlier("block", "source_no", "grp")))
        .join(groups, ["source_no", "grp"])
        .select(
            "source_no",
            "block",
            (F.coalesce("before_group", F.lit(0)) + F.coalesce("in_group", F.lit(0))).alias("before_block"),
        )
    )
    inside = (
        Window.partitionBy("source_no", "block")
        .orderBy("key")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    middle = F.col("before_block") + F.coalesce("in_block", F.lit(0)) + F.col("size") / 2
    return (
        placed.join(offsets, ["source_no", "block"])
        .withColumn("in_block", F.sum("size").over(inside))
        .withColumn("passes", passes)
        .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
        .withColumn("copies", (F.col("passes") + (middle < F.col("rest")).cast("long")).cast("long"))
    )


def mix(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_EPOCHS, seed: str = "mix") -> DataFrame:
    """The part of each row of ``docs`` (``doc_id``, ``text``, ``source``) in the mix.

    Returns ``doc_id``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` (words,
    copies counted).  Keys depend on seed, id and text only, so reruns agree; rows that repeat both
    are alike.  A document without words has ``taken`` 0.
    An empty table gives an empty mix.
    """
    id_column = f"c{docs.columns.index('doc_id')}"
    return _placed(docs, weights, most, seed).select(
        F.col(id_column).alias("doc_id"),
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def mixed(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_EPOCHS, seed: str = "mix") -> DataFrame:
    """The mix itself: the columns of ``docs``, each row as often as the mix takes it."""
    columns = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)]
    return (
        _placed(docs, weights, most, seed)
        .where("copies > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select(columns)
    )

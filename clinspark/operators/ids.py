"""Dense surrogate ids 1..n in a given order, without a one-partition window.

Rows are range-partitioned on the whole order key, so one hot leading value is
cut by the later keys and never lands in one task.  The partition and the
position inside it are written once (see ``session.stage``); both the partition
sizes and the final ids are read from that table, so a retried task cannot see
other range bounds than the first one did.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from clinspark.session import stage

_POSITION_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def with_dense_ids(
    df: DataFrame, id_col: str, order_by: list[str], start: int | Column = 1, keep: list[str] | None = None
) -> DataFrame:
    """Add ``id_col`` = start, start+1, ... in ``order_by`` order (nulls first).

    Rows that tie on ``order_by`` are told apart by a hash of their other
    columns, so the result does not depend on the order in which rows were read.
    With ``keep`` only those columns are carried along and returned; the ids are the same.
    """
    keep = df.columns if keep is None else keep
    rest = [f.name for f in df.schema if f.name not in order_by and not isinstance(f.dataType, T.MapType)]
    keys = [*order_by, "_tie"]
    tied = df.withColumn("_tie", F.xxhash64(*rest) if rest else F.lit(0))
    carried = tied.select(*dict.fromkeys([*keys, *keep]))
    ranged = carried.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*keep)
    placed = stage(ranged.withColumn("_slot", F.monotonically_increasing_id()), f"ids-{id_col}")

    part = F.shiftright("_slot", _POSITION_BITS)
    position = F.col("_slot").bitwiseAND((1 << _POSITION_BITS) - 1)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per shuffle partition: the unpartitioned window and the broadcast are bounded by that.
    before = F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")
    offsets = sizes.select("_part", before.alias("_before"))

    first = start if isinstance(start, Column) else F.lit(start)
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(id_col, (F.col("_before") + position + first).cast("bigint"))
        .select(id_col, *keep)
    )


def next_id(existing: DataFrame | None, id_col: str) -> int:
    """First free id after those already given out."""
    if existing is None:
        return 1
    return (existing.agg(F.max(id_col)).first()[0] or 0) + 1

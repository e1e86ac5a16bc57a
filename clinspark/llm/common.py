"""What several operators of this package share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of characters that are none of these; stands inside a character class.
BLANKS = r"\x20\x09-\x0D"
WORD = f"[^{BLANKS}]+"

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Rows no model learns from: one document in five, by the checksum of its id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def uniform(*parts: Column) -> Column:
    """A value in [0, 1) that depends on nothing but ``parts``."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 40)) / float(1 << 40)


def whole(text: str = "text") -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def own_name(df: DataFrame, label: str) -> str:
    """A column name that ``df`` does not use."""
    taken = {name.lower() for name in df.columns}
    while label.lower() in taken:
        label = f"_{label}"
    return label


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Let Python tasks take few rows at a time: texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def drop_path(spark: SparkSession, uri: str) -> None:
    """Delete a stage that no later step reads."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(label: str) -> str:
    return f"{label}-{uuid.uuid4().hex[:12]}"

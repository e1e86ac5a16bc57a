"""Vocabulary files: tab-separated, with a header, without quoting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinspark.contracts import CONTRACTS, missing_columns, schema_of
from clinspark.functions.dates import vocabulary_date


def read_vocabulary(spark: SparkSession, table: str, path: str) -> DataFrame:
    """``concept`` or ``concept_relationship`` in contract columns and types; extra columns are ignored.

    An id or number that is present but unreadable stops the job.
    """
    raw = (
        spark.read.option("sep", "\t")
        .option("header", True)
        .option("quote", "")
        .option("inferSchema", False)
        .option("nullValue", "")
        .csv(path)
    )
    missing = missing_columns(raw, [f.name for f in CONTRACTS[table]])
    if missing:
        raise ValueError(f"{table} file is missing fields: " + ", ".join(missing))
    columns, declared = [], schema_of(table)
    for field in CONTRACTS[table]:
        text = F.nullif(F.trim(F.col(field.name)), F.lit(""))
        if isinstance(field.spark_type, T.StringType):
            value = F.nullif(F.col(field.name), F.lit(""))
        elif isinstance(field.spark_type, T.DateType):
            value = vocabulary_date(text)
        else:
            value = text.cast(field.spark_type)
        columns.append(value.alias(field.name, metadata=declared[field.name].metadata))
    return raw.select(columns)


def write_vocabulary(df: DataFrame, path: str) -> None:
    """Write in the layout ``read_vocabulary`` reads, dates as yyyyMMdd."""
    columns = [
        F.date_format(f.name, "yyyyMMdd").alias(f.name)
        if isinstance(f.dataType, T.DateType)
        else F.col(f.name).cast("string").alias(f.name)
        for f in df.schema
    ]
    out = df.select(columns).write.option("sep", "\t").option("header", True).option("quote", "")
    out.option("emptyValue", "").csv(path)

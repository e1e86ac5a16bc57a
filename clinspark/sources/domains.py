"""Tabulation domains and processed tables on storage."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text columns of each domain, then its numeric columns.
DOMAIN_COLUMNS = {
    "DM": (["USUBJID", "SEX", "RACE", "ETHNIC", "BRTHDTC", "RFSTDTC", "RFENDTC"], []),
    "SV": (["USUBJID", "VISIT", "SVSTDTC", "SVENDTC"], ["VISITNUM"]),
    "AE": (["USUBJID", "AETERM", "AEDECOD", "AESTDTC", "AEENDTC", "AEOUT"], ["AESEQ"]),
    "MH": (["USUBJID", "MHTERM", "MHSTDTC"], ["MHSEQ"]),
    "EX": (["USUBJID", "EXTRT", "EXDOSU", "EXROUTE", "EXSTDTC", "EXENDTC"], ["EXSEQ", "EXDOSE"]),
    "CM": (["USUBJID", "CMTRT", "CMDOSU", "CMROUTE", "CMSTDTC", "CMENDTC"], ["CMSEQ", "CMDOSE"]),
    "LB": (["USUBJID", "LBTEST", "LBORRES", "LBORRESU", "LBDTC", "VISIT"], ["LBSEQ", "LBSTRESN", "VISITNUM"]),
    "VS": (["USUBJID", "VSTEST", "VSORRES", "VSORRESU", "VSDTC", "VISIT"], ["VSSEQ", "VSSTRESN", "VISITNUM"]),
    "EG": (["USUBJID", "EGTEST", "EGORRES", "EGORRESU", "EGDTC", "VISIT"], ["EGSEQ", "EGSTRESN", "VISITNUM"]),
}


def domain_schema(domain: str) -> T.StructType:
    texts, numbers = DOMAIN_COLUMNS[domain.upper()]
    return T.StructType(
        [T.StructField(name, T.StringType()) for name in texts] + [T.StructField(name, T.DoubleType()) for name in numbers]
    )


def read_domain(
    spark: SparkSession, domain: str, path: str, fmt: str = "parquet", multi_line: bool = False
) -> DataFrame:
    """One domain, its known columns in their types.

    CSV follows the header by name, so columns may come in any order or be absent.  Line breaks
    inside quotes need ``multi_line``, and then a file is one task; without it a row that is cut
    by one does not have the header's number of columns and stops the read with an error.
    """
    schema = domain_schema(domain)
    raw = spark.read.parquet(path) if fmt == "parquet" else _text_csv(spark, path, multi_line)
    return raw.select(
        [
            F.col(f.name).try_cast(f.dataType).alias(f.name)
            for f in schema
            if f.name in raw.columns
        ]
        + [name for name in raw.columns if name not in schema.names]
    )


def read_domain_if_present(
    spark: SparkSession, domain: str, path: str, fmt: str = "parquet", multi_line: bool = False
) -> DataFrame | None:
    """``None`` for a domain that was not delivered."""
    try:
        return read_domain(spark, domain, path, fmt, multi_line)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _text_csv(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    options = {"header": True, "inferSchema": False, "escape": '"', "multiLine": multi_line, "mode": "FAILFAST"}
    # With pruning, columns nobody asks for are not parsed, and a torn row would go unnoticed.
    return spark.read.options(columnPruning=False, **options).csv(path)


def read_staging_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A processed table as text columns; the empty string is null.

    Line breaks inside quotes need ``multi_line``, and then a file is one task.
    """
    raw = _text_csv(spark, path, multi_line)
    return raw.select([F.nullif(F.col(name), F.lit("")).alias(name) for name in raw.columns])


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        writer.options(header=True, escape='"', **spaces).csv(path)
    else:
        writer.format(fmt).save(path)


RANGE_BYTES = 64 << 20


def _range_digests(ranges: DataFrame) -> DataFrame:
    """SHA-256 of each (path, offset, size) of a file, read by its own task in small pieces."""

    def run(batches):
        import hashlib

        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            found = []
            for path, offset, size in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                # A local path has one slash behind its scheme, and may hold signs that a URI cannot.
                local = path.removeprefix("file:") if path.startswith("file:") else None
                store, name = (fs.LocalFileSystem(), local) if local else fs.FileSystem.from_uri(path)
                digest, left = hashlib.sha256(), size
                with store.open_input_file(name) as file:
                    file.seek(offset)
                    while left and (piece := file.read(min(left, 1 << 20))):
                        digest.update(piece)
                        left -= len(piece)
                found.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)], ["path", "offset", "digest"])

    columns = ranges.select("path", "offset", "size")
    return columns.repartition("path", "offset").mapInArrow(run, "path string, offset long, digest string")


def _digests(files: DataFrame, range_bytes: int) -> DataFrame:
    """(path, sha256) of files of any size.

    A file of up to ``range_bytes`` is hashed by Spark's own reader.  Of a larger one every range
    of that size is hashed by a task of its own, and the digest is that of the hexadecimal digests
    of its ranges, one behind the other.
    """
    small = files.where(F.col("length") <= range_bytes).select("path", F.sha2("content", 256).alias("sha256"))
    offsets = F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(range_bytes).cast("bigint"))
    ranges = (
        files.where(F.col("length") > range_bytes)
        .select("path", "length", F.explode(offsets).alias("offset"))
        .withColumn("size", F.least(F.lit(range_bytes), F.col("length") - F.col("offset")))
    )
    ordered = F.array_sort(F.collect_list(F.struct("offset", "digest")))  # one per range of a file
    large = (
        _range_digests(ranges)
        .groupBy("path")
        .agg(F.sha2(F.array_join(F.transform(ordered, lambda r: r["digest"]), ""), 256).alias("sha256"))
    )
    return small.unionByName(large)


def _empty_files(fs, found) -> list[tuple]:
    """(path, modified at) of files without a byte, which Spark's reader leaves out."""
    empty = []
    for status in found:
        inside = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        for file in inside:
            path = file.getPath()
            if not file.isDirectory() and file.getLen() == 0 and path.getName()[:1] not in "_.":
                empty.append((path.toString(), dt.datetime.fromtimestamp(file.getModificationTime() / 1000, dt.timezone.utc)))
    return empty


def input_manifest(
    spark: SparkSession, paths: list[str], with_hash: bool = True, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Path, size, modification time and SHA-256 of each file; absent paths are marked missing.

    ``ranges`` tells in how many parts the digest was taken: it is the plain one if there is one
    part, and else a digest of digests (see ``_digests``).  Without the hash, no file is read.
    """
    found = None
    absent, empty = [], []
    for path in paths:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        statuses = fs.globStatus(place)
        if not statuses:
            absent.append((path,))
            continue
        empty += _empty_files(fs, statuses)
        files = spark.read.format("binaryFile").load(path)
        rows = files.select(
            "path",
            F.col("length").alias("size_bytes"),
            F.col("modificationTime").alias("modified_at"),
            F.greatest(F.ceil(F.col("length") / range_bytes), F.lit(1)).cast("bigint").alias("ranges"),
            F.lit(False).alias("missing"),
        )
        if with_hash:
            rows = rows.join(_digests(files, range_bytes), "path", "left")
        else:
            rows = rows.withColumn("sha256", F.lit(None).cast("string"))
        found = rows if found is None else found.unionByName(rows)
    gone = spark.createDataFrame(absent, "path string").select("path", F.lit(True).alias("missing"))
    if empty:
        nothing = spark.createDataFrame(empty, "path string, modified_at timestamp").select(
            "path",
            F.lit(0).cast("bigint").alias("size_bytes"),
            "modified_at",
            F.lit(1).cast("bigint").alias("ranges"),
            F.lit(False).alias("missing"),
            (F.sha2(F.lit(""), 256) if with_hash else F.lit(None).cast("string")).alias("sha256"),
        )
        found = found.unionByName(nothing)
    return gone if found is None else found.unionByName(gone, allowMissingColumns=True)

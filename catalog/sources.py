"""Files in and out: absent domains, staging tables, vocabulary columns, manifests, refused input."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.registry import query
from clinspark.contracts import missing_columns
from clinspark.functions import codes
from clinspark.operators import acceptance, domains, visits
from clinspark.session import stage_path
from clinspark.sources.domains import input_manifest, read_domain_if_present, read_staging_csv, write_table
from clinspark.sources.vocabulary import read_vocabulary, write_vocabulary

DELIVERED = ["DM", "SV", "AE", "LB"]
ABSENT = ["MH", "EX", "CM", "VS", "EG"]


@query(
    "absent_domains",
    " union all ".join(
        [f"select '{name}' as domain, true as delivered, count(*) as n_rows from {{{name.lower()}}}" for name in DELIVERED]
        + [f"select '{name}', false, 0" for name in ABSENT]
    ),
)
def absent_domains(v):
    """A delivery in which five of nine domains are absent."""
    folder = stage_path(v.spark, "delivery")
    for name in DELIVERED:
        write_table(getattr(v, name.lower()), f"{folder}/{name}")
    parts = []
    for name in [*DELIVERED, *ABSENT]:
        rows = read_domain_if_present(v.spark, name, f"{folder}/{name}")
        there = rows if rows is not None else v.dm.where("false")
        counts = there.agg(F.count("*").alias("n_rows"))
        parts.append(counts.select(F.lit(name).alias("domain"), F.lit(rows is not None).alias("delivered"), "n_rows"))
    return reduce(DataFrame.unionByName, parts)


@query(
    "scan_staging",
    """select cast(p_partkey as varchar) as p_partkey, nullif(case when p_partkey % 3 = 0 then '' else p_name end, '') as p_name,
              p_type || chr(10) || p_brand as note, cast(p_size as varchar) as p_size from {part}""",
)
def scan_staging(v):
    """A processed table as CSV: every column text, empty is null, line breaks kept."""
    path = stage_path(v.spark, "staging-csv")
    rows = v.part.select(
        "p_partkey",
        F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.col("p_name")).alias("p_name"),
        F.concat("p_type", F.lit("\n"), "p_brand").alias("note"),
        "p_size",
    )
    write_table(rows, path, "csv")
    return read_staging_csv(v.spark, path, multi_line=True)


@query(
    "vocabulary_columns",
    """select concept_id_1::bigint as concept_id_1, concept_id_2::bigint as concept_id_2, relationship_id,
              valid_start_date, valid_end_date, nullif(invalid_reason, '') as invalid_reason from {rel}""",
)
def vocabulary_columns(v):
    """A relationship file with its columns in another order and one too many: contract columns and types."""
    path = stage_path(v.spark, "relationship-tsv")
    turned = v.rel.select(F.lit("x").alias("surplus"), *reversed(v.rel.columns))
    write_vocabulary(turned, path)
    return read_vocabulary(v.spark, "concept_relationship", path)


MANIFEST_RANGE = 1 << 14


@query(
    "input_manifest",
    f"""with lines as (
           select o_orderkey % 16 as part, string_agg(o_orderkey || '|' || o_custkey || '|' || o_orderpriority || chr(10), ''
                                                      order by o_orderkey) as content
           from {{orders}} group by part),
         parts as (
           select length(content) as size, content,
                  cast(ceil(length(content) / {MANIFEST_RANGE}.0) as bigint) as ranges
           from lines)
       select size::bigint as size_bytes, ranges, false as missing,
              case when ranges = 1 then sha256(content)
                   else sha256(array_to_string(list_transform(range(0, ranges),
                            lambda i: sha256(substr(content, i * {MANIFEST_RANGE} + 1, {MANIFEST_RANGE}))), '')) end as sha256
       from parts
       union all select null, null, true, null""",
)
def manifest(v):
    """Delivered files, hashed by ranges, and one that is not there."""
    folder = stage_path(v.spark, "manifest")
    line = F.concat_ws("|", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderpriority")
    lines = v.orders.select((F.col("o_orderkey") % 16).alias("part"), "o_orderkey", line.alias("value"))
    lines.repartition("part").sortWithinPartitions("part", "o_orderkey").select("part", "value").write.option(
        "maxRecordsPerFile", 0
    ).partitionBy("part").text(folder)
    found = input_manifest(v.spark, [f"{folder}/part=*", f"{folder}-absent"], range_bytes=MANIFEST_RANGE)
    return found.select("size_bytes", "ranges", "missing", "sha256")


@query(
    "required_type_concepts",
    """select t.id::bigint as concept_id, c.concept_id is not null as found
       from (select 32809 as id union all select 32880) t left join {concept} c on c.concept_id = t.id""",
)
def required_type_concepts(v):
    """Type concepts the tables need, looked up in the vocabulary."""
    known = v.concept.select(F.col("concept_id").cast("bigint").alias("concept_id"), F.lit(True).alias("hit"))
    needed = codes.required_type_concepts(v.spark).select("concept_id")
    return needed.join(known, "concept_id", "left").select("concept_id", F.col("hit").isNotNull().alias("found"))


@query(
    "repeated_visit_numbers",
    """select @pid(USUBJID) as person_id, VISITNUM as number, count(*) * 2 as n from {sv}
       where VISITNUM % 2 = 0 group by all""",
)
def repeated_visit_numbers(v):
    """Visits that are there twice, once as "2" and once as "2.0"; odd numbers are fine."""
    rows = domains.visit_occurrence(v.sv, ids=False, check=False).withColumn("visit_occurrence_id", F.lit(1))
    number = F.col("source_visit_num")
    plain = rows.withColumn("source_visit_num", number.cast("bigint").cast("string"))
    again = rows.where(number % 2 == 0).withColumn("source_visit_num", number.cast("string"))
    return visits.repeated_visit_numbers(plain.unionByName(again)).where("number % 2 = 0")


@query(
    "unreadable_values",
    """select 'person' as table_name, 'year_of_birth' as column_name, count(*) as violations from {part} where p_partkey % 5 = 0
       union all select 'person', 'birth_datetime', count(*) from {part} where p_partkey % 7 = 0""",
)
def unreadable_values(v):
    """Text that does not read as its contract type, per column."""
    raw = v.sql(
        """select cast(p_partkey as string) as person_id, cast(p_partkey as string) as gender_concept_id,
                  case when p_partkey % 5 = 0 then 'about 1950' else '1950' end as year_of_birth,
                  '0' as race_concept_id, '0' as ethnicity_concept_id,
                  case when p_partkey % 7 = 0 then 'unknown' when p_partkey % 2 = 0 then '1950-02-03' else ' ' end
                      as birth_datetime
           from {part}"""
    )
    return acceptance.unreadable_values(raw, "person")


@query(
    "absent_columns",
    """select 'SV' as domain, 'VISITNUM' as column_name, count(*) as n_rows from {sv}
       union all select 'AE', 'AETERM', count(*) from {ae}""",
)
def absent_columns(v):
    """Columns that a contract asks for and a delivered frame lacks, with the rows concerned."""
    parts = []
    for name, lost in (("SV", "VISITNUM"), ("AE", "AETERM"), ("DM", None)):
        rows = getattr(v, name.lower())
        needed = rows.columns
        rows = rows.drop(lost) if lost else rows
        for column in missing_columns(rows, needed):
            parts.append(rows.agg(F.lit(name).alias("domain"), F.lit(column).alias("column_name"), F.count("*").alias("n_rows")))
    return reduce(DataFrame.unionByName, parts)



"""Code lists. All are small and fixed, so they are literals inside the plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinspark.functions.text import strip

# Source code -> concept id.
GENDER = {"M": 8507, "F": 8532, "U": 8521}
RACE = {"WHITE": 8527, "BLACK OR AFRICAN AMERICAN": 8516, "ASIAN": 8515, "UNKNOWN": 0}
ETHNICITY = {"HISPANIC OR LATINO": 38003563, "NOT HISPANIC OR LATINO": 38003564, "UNKNOWN": 0}
UNIT = {
    "MG/DL": 8840,
    "mg/dL": 8840,
    "U/L": 8645,
    "beats/min": 8541,
    "g/dL": 8713,
    "kg": 9529,
    "mmHg": 8876,
    "msec": 9593,
}

# How a record came to be, by target table and source domain.
CASE_REPORT_FORM = (32809, "Case Report Form")
STANDARD_ALGORITHM = (32880, "Standard algorithm")
TYPE_CONCEPTS = [
    ("condition_occurrence", "AE", *CASE_REPORT_FORM),
    ("condition_occurrence", "MH", *CASE_REPORT_FORM),
    ("drug_exposure", "EX", *CASE_REPORT_FORM),
    ("drug_exposure", "CM", *CASE_REPORT_FORM),
    ("measurement", "LB", *CASE_REPORT_FORM),
    ("measurement", "VS", *CASE_REPORT_FORM),
    ("measurement", "EG", *CASE_REPORT_FORM),
    ("visit_occurrence", "SV", *CASE_REPORT_FORM),
    ("observation_period", "DERIVED", *STANDARD_ALGORITHM),
]


def _decode(code: Column, values: dict[str, int]) -> Column:
    # One look-up: a chain of cases would work the code out again in every case.
    known = F.create_map(*[F.lit(x) for text, value in values.items() for x in (text, value)])
    return F.coalesce(F.try_element_at(known, code).cast("bigint"), F.lit(0).cast("bigint"))


def gender_concept(code: Column) -> Column:
    return _decode(code, GENDER)


def race_concept(text: Column) -> Column:
    return _decode(F.upper(text), RACE)


def ethnicity_concept(text: Column) -> Column:
    return _decode(F.upper(text), ETHNICITY)


def unit_concept(unit: Column) -> Column:
    """Null for an absent unit, 0 for an unknown one."""
    name = strip(unit)
    return F.when(name != "", _decode(name, UNIT))


def type_concept_id(target_table: str, source_domain: str) -> int:
    key = (target_table.strip().lower(), source_domain.strip().upper())
    for table, domain, concept_id, _ in TYPE_CONCEPTS:
        if (table, domain) == key:
            return concept_id
    raise ValueError(f"No type concept is documented for {key[0]}/{key[1]}.")


def type_concepts(spark: SparkSession) -> DataFrame:
    schema = "target_table string, source_domain string, concept_id long, concept_name string"
    return spark.createDataFrame(TYPE_CONCEPTS, schema)


def required_type_concepts(spark: SparkSession) -> DataFrame:
    return type_concepts(spark).select("concept_id", "concept_name").distinct()


def with_type_concept(df: DataFrame, table_col: str, domain_col: str) -> DataFrame:
    """Add ``type_concept_id`` by the fixed matrix (nine rows); null marks an undocumented pair."""
    matrix = type_concepts(df.sparkSession).select(
        F.col("target_table").alias("_table"),
        F.col("source_domain").alias("_domain"),
        F.col("concept_id").alias("type_concept_id"),
    )
    same = (F.lower(strip(F.col(table_col))) == F.col("_table")) & (
        F.upper(strip(F.col(domain_col))) == F.col("_domain")
    )
    return df.join(F.broadcast(matrix), same, "left").drop("_table", "_domain")

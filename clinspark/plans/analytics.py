"""Cohort queries on the published tables.

Event tables are reduced to one row per concept (or concept and person) before
they meet the vocabulary, so the join is on the aggregate and never on events.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _names(concept: DataFrame) -> DataFrame:
    return concept.select(F.col("concept_id").cast("bigint").alias("concept_id"), "concept_name")


def _one_row(*parts: DataFrame) -> DataFrame:
    """One-row frames side by side, without a join."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.agg(*[F.max(name).alias(name) for name in rows.columns])


def population(person: DataFrame, observation_period: DataFrame) -> DataFrame:
    """Number of patients and mean days observed, one row."""
    patients = person.agg(F.count_distinct("person_id").alias("total_patients"))
    days = F.datediff("observation_period_end_date", "observation_period_start_date")
    observed = observation_period.agg(F.round(F.avg(days), 1).alias("avg_days_observed"))
    return _one_row(patients, observed)


def gender_distribution(person: DataFrame, concept: DataFrame) -> DataFrame:
    counts = person.groupBy(F.col("gender_concept_id").alias("concept_id")).agg(
        F.count("person_id").alias("n")
    )
    return (
        counts.join(_names(concept), "concept_id", "left")
        .groupBy(F.coalesce("concept_name", F.lit("Unknown")).alias("gender"))
        .agg(F.sum("n").alias("patients"))
    )


def top_conditions(condition_occurrence: DataFrame, concept: DataFrame, k: int = 5) -> DataFrame:
    """Most frequent mapped conditions; ties go by name."""
    counts = (
        condition_occurrence.where("condition_concept_id <> 0")
        .groupBy(F.col("condition_concept_id").alias("concept_id"))
        .agg(F.count("condition_occurrence_id").alias("n"))
    )
    return (
        counts.join(_names(concept), "concept_id")
        .groupBy("concept_name")
        .agg(F.sum("n").alias("occurrences"))
        .orderBy(F.desc("occurrences"), "concept_name")
        .limit(k)
    )


def lab_means(measurement: DataFrame, k: int = 5) -> DataFrame:
    """Highest mean values by test and unit; ties go by test and unit."""
    return (
        measurement.where("value_as_number is not null")
        .groupBy("measurement_source_value", "unit_source_value")
        .agg(F.round(F.avg("value_as_number"), 1).alias("avg_value"))
        .orderBy(F.desc("avg_value"), "measurement_source_value", "unit_source_value")
        .limit(k)
    )


def rescue_rate(
    person: DataFrame, drug_exposure: DataFrame, concept: DataFrame, substance: str = "acetaminophen"
) -> DataFrame:
    """Patients with a drug whose concept name contains the substance, and their share in percent."""
    matching = _names(concept).where(F.contains(F.lower("concept_name"), F.lit(substance.lower())))
    takers = (
        drug_exposure.select(F.col("drug_concept_id").cast("bigint").alias("concept_id"), "person_id")
        .distinct()
        .join(matching.select("concept_id"), "concept_id", "left_semi")
        .agg(F.count_distinct("person_id").alias("rescue_patients"))
    )
    patients = person.agg(F.count_distinct("person_id").alias("total_patients"))
    rate = F.col("rescue_patients") / F.col("total_patients") * 100
    return _one_row(takers, patients).select(
        "rescue_patients",
        "total_patients",
        F.when(F.col("total_patients") > 0, F.round(rate, 1)).otherwise(F.lit(0.0)).alias("rescue_rate"),
    )

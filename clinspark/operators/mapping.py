"""Deterministic and approved mapping of source terms to vocabulary concepts."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinspark.functions import text
from clinspark.functions.numbers import lenient_id
from clinspark.session import stage

DEFAULT_VERSION = "Athena_Standard"  # fixed value

DIRECT = "deterministic_direct_match"  # fixed values: method labels
MAPS_TO = "deterministic_maps_to_relation"
APPROVED = "human_approved_mapping"


@dataclass(frozen=True)
class Target:
    table: str
    id_col: str
    source_col: str
    concept_col: str
    domain: str


# The tables whose terms are mapped.
TARGETS = {
    t.table: t
    for t in [
        Target(
            "condition_occurrence",
            "condition_occurrence_id",
            "condition_source_value",
            "condition_concept_id",
            "Condition",
        ),
        Target("drug_exposure", "drug_exposure_id", "drug_source_value", "drug_concept_id", "Drug"),
        Target("measurement", "measurement_id", "measurement_source_value", "measurement_concept_id", "Measurement"),
    ]
}
DOMAIN_OF = {t.table: t.domain for t in TARGETS.values()}


# --- vocabulary predicates ------------------------------------------------------------------


def on_day(as_of: dt.date | str | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def not_invalid(prefix: str = "") -> Column:
    reason = F.col(f"{prefix}invalid_reason")
    return reason.isNull() | (reason == "")


def valid_on(as_of: dt.date | str | None = None, prefix: str = "") -> Column:
    return on_day(as_of).between(F.col(f"{prefix}valid_start_date"), F.col(f"{prefix}valid_end_date"))


def is_standard(prefix: str = "") -> Column:
    return (F.col(f"{prefix}standard_concept") == "S") & not_invalid(prefix)


def standard_concepts(concept: DataFrame, as_of: dt.date | str | None = None, domain: str | None = None) -> DataFrame:
    """Standard concepts valid on the day, of one domain or all."""
    rows = concept.where(is_standard() & valid_on(as_of))
    return rows if domain is None else rows.where(F.col("domain_id") == domain)


# --- deterministic mapping ------------------------------------------------------------------


def orphan_terms(df: DataFrame, target: Target) -> DataFrame:
    """Distinct source terms of unmapped rows: (target_table, domain_id, source_value)."""
    return (
        df.where((lenient_id(df, target.concept_col) == 0) & F.col(target.source_col).isNotNull())
        .select(
            F.lit(target.table).alias("target_table"),
            F.lit(target.domain).alias("domain_id"),
            F.col(target.source_col).alias("source_value"),
        )
        .distinct()
    )


def _lowest(rows: DataFrame) -> DataFrame:
    """The lowest concept id of each (domain, key), with its name."""
    best = F.min(F.struct("concept_id", "concept_name")).alias("best")
    return rows.groupBy("domain_id", "term_key").agg(best).select("domain_id", "term_key", "best.*")


def direct_matches(keys: DataFrame, concept: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """Lowest standard concept whose name equals the key, per (domain_id, term_key)."""
    names = standard_concepts(concept, as_of).select(
        "domain_id", F.lower("concept_name").alias("term_key"), "concept_id", "concept_name"
    )
    return _lowest(keys.join(names, ["domain_id", "term_key"]))


def maps_to_matches(
    keys: DataFrame,
    concept: DataFrame,
    relationship: DataFrame,
    as_of: dt.date | str | None = None,
) -> DataFrame:
    """Lowest standard concept one 'Maps to' step from a concept of that name, per (domain_id, term_key)."""
    sources = concept.where(not_invalid() & valid_on(as_of)).select(
        F.lower("concept_name").alias("term_key"), F.col("concept_id").alias("concept_id_1")
    )
    steps = relationship.where((F.col("relationship_id") == "Maps to") & not_invalid() & valid_on(as_of)).select(
        "concept_id_1", F.col("concept_id_2").alias("concept_id")
    )
    targets = standard_concepts(concept, as_of).select("concept_id", "concept_name", "domain_id")
    # Reduce to distinct (key, target) pairs before the domain of the target is looked up.
    reached = (
        keys.select("term_key").distinct().join(sources, "term_key").join(steps, "concept_id_1")
        .select("term_key", "concept_id")
        .distinct()
    )
    return _lowest(reached.join(targets, "concept_id").join(keys, ["domain_id", "term_key"], "left_semi"))


def map_terms(
    terms: DataFrame,
    concept: DataFrame,
    relationship: DataFrame,
    as_of: dt.date | str | None = None,
) -> DataFrame:
    """Best concept of each term: a direct match, else a 'Maps to' match, else concept 0.

    Input (target_table, domain_id, source_value); adds concept_id, concept_name, mapping_method.
    The distinct terms are staged, so that the events behind them are scanned once.
    """
    keyed = stage(terms.withColumn("term_key", text.match_key(F.col("source_value"))), "terms")
    keys = keyed.select("domain_id", "term_key").distinct()
    direct = direct_matches(keys, concept, as_of).withColumn("mapping_method", F.lit(DIRECT))
    left_over = keys.join(direct, ["domain_id", "term_key"], "left_anti")
    related = maps_to_matches(left_over, concept, relationship, as_of).withColumn("mapping_method", F.lit(MAPS_TO))
    found = direct.unionByName(related)
    return (
        keyed.join(found, ["domain_id", "term_key"], "left")
        .withColumn("concept_id", F.coalesce("concept_id", F.lit(0).cast("bigint")))
        .select("target_table", "domain_id", "source_value", "concept_id", "concept_name", "mapping_method")
    )


def _lookup(mapped: DataFrame, target: Target) -> DataFrame:
    return mapped.where((F.col("target_table") == target.table) & (F.col("concept_id") != 0)).select(
        F.col("source_value").alias("_term"), F.col("concept_id").alias("_concept"), "mapping_method"
    )


def apply_terms(df: DataFrame, target: Target, mapped: DataFrame) -> DataFrame:
    """Write mapped concept ids into the unmapped rows of the same raw term.

    Pass a staged ``mapped``: Spark then plans with its real size.  Below the
    session's broadcast threshold the events are not shuffled at all, above it
    this is a sort-merge join whose hot terms the adaptive skew rule splits.
    """
    current = df.withColumn(target.concept_col, lenient_id(df, target.concept_col))
    same = (F.col(target.source_col) == F.col("_term")) & (F.col(target.concept_col) == 0)
    joined = current.join(_lookup(mapped, target).drop("mapping_method"), same, "left")
    return joined.withColumn(target.concept_col, F.coalesce("_concept", target.concept_col)).select(*df.columns)


def provenance_of_terms(
    df: DataFrame,
    target: Target,
    mapped: DataFrame,
    run_id: str,
    vocabulary_version: str = DEFAULT_VERSION,
) -> DataFrame:
    """Audit rows of the events that ``apply_terms`` changes."""
    lookup = _lookup(mapped, target)
    unmapped = df.where(lenient_id(df, target.concept_col) == 0).select(target.id_col, target.source_col)
    return unmapped.join(lookup, F.col(target.source_col) == F.col("_term")).select(
        F.lit(target.table).alias("target_table"),
        F.col(target.id_col).cast("bigint").alias("target_id"),
        F.col(target.source_col).alias("source_value"),
        F.col(target.source_col).alias("normalized_value"),
        F.col("_concept").alias("assigned_concept_id"),
        F.col("mapping_method"),
        F.lit(1.0).alias("score"),
        F.lit("OHDSI_Vocabulary").alias("model_name"),
        F.lit(vocabulary_version).alias("vocabulary_version"),
        F.lit("System_Auto_Approved").alias("reviewed_by"),
        F.lit(run_id).alias("run_id"),
        F.lit(None).cast("bigint").alias("mapping_decision_id"),
    )


def map_tables(
    tables: dict[str, DataFrame],
    concept: DataFrame,
    relationship: DataFrame,
    run_id: str,
    as_of: dt.date | str | None = None,
    vocabulary_version: str = DEFAULT_VERSION,
    written: dict[str, DataFrame] | None = None,
) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """Map the terms of all target tables at once: (tables, provenance, mapped terms).

    ``written`` may hold the same rows with more columns filled in: then those are returned mapped,
    and terms and audit rows are read from ``tables``, without whatever fills the other columns.
    """
    targets = [TARGETS[name] for name in tables if name in TARGETS]
    terms = reduce(DataFrame.unionByName, [orphan_terms(tables[t.table], t) for t in targets])
    mapped = stage(map_terms(terms, concept, relationship, as_of), "mapped-terms")
    audit = [provenance_of_terms(tables[t.table], t, mapped, run_id, vocabulary_version) for t in targets]
    return apply_mapped(written or tables, mapped), reduce(DataFrame.unionByName, audit), mapped


def apply_mapped(tables: dict[str, DataFrame], mapped: DataFrame) -> dict[str, DataFrame]:
    """``apply_terms`` to all target tables."""
    return {name: apply_terms(df, TARGETS[name], mapped) if name in TARGETS else df for name, df in tables.items()}


def mapping_coverage(mapped: DataFrame) -> DataFrame:
    """Distinct terms and how many of them were mapped, per domain."""
    return mapped.groupBy("domain_id").agg(
        F.count(F.lit(1)).alias("terms"), F.count_if(F.col("concept_id") != 0).alias("mapped_terms")
    )


# --- approved mapping -----------------------------------------------------------------------


def active_approvals(approved: DataFrame, decisions: DataFrame, concept: DataFrame) -> DataFrame:
    """Active approved rules with their decision's evidence, and what is wrong with them.

    ``problem`` is null for a usable rule.  Validity dates are not looked at here.
    """
    evidence = decisions.select(
        F.col("mapping_decision_id").alias("source_decision_id"), "score", "model_name", "vocabulary_version"
    )
    facts = concept.select(
        F.col("concept_id").cast("bigint").alias("concept_id"),
        "concept_name",
        "domain_id",
        "standard_concept",
        "invalid_reason",
    )
    return (
        approved.where("active")
        .select("target_table", "normalized_value", "concept_id", "source_decision_id", "approved_by")
        .join(evidence, "source_decision_id")
        .join(facts, "concept_id", "left")
        .withColumn(
            "problem",
            F.when(F.col("concept_name").isNull(), "is not in the vocabulary")
            .when(~F.coalesce(is_standard(), F.lit(False)), "is not standard any more")
            .when(~F.coalesce(F.col("domain_id") == expected_domain(), F.lit(False)), "has another domain"),
        )
        .select(
            "target_table",
            "normalized_value",
            "concept_id",
            "source_decision_id",
            "approved_by",
            "score",
            "model_name",
            "vocabulary_version",
            "problem",
        )
    )


def expected_domain(table_col: str = "target_table") -> Column:
    domain = F.lit(None).cast("string")
    for table, name in DOMAIN_OF.items():
        domain = F.when(F.col(table_col) == table, name).otherwise(domain)
    return domain


def require_usable(approvals: DataFrame) -> None:
    bad = approvals.where("problem is not null").orderBy("target_table", "normalized_value").first()
    if bad:
        raise ValueError(f"A rule for {bad.target_table} cannot be used: concept {bad.concept_id} {bad.problem}.")


def _usable(approvals: DataFrame, target: Target) -> DataFrame:
    return approvals.where((F.col("target_table") == target.table) & F.col("problem").isNull()).select(
        F.col("normalized_value").alias("_key"),
        F.col("concept_id").alias("_concept"),
        F.col("source_decision_id").alias("_decision"),
        F.col("approved_by").alias("_by"),
        F.col("score").alias("_score"),
        F.col("model_name").alias("_model"),
        F.col("vocabulary_version").alias("_version"),
    )


def approvals_of_terms(df: DataFrame, target: Target, approvals: DataFrame) -> DataFrame:
    """The approval of each raw term of unmapped rows, staged: the rule key is worked out per term, not per event."""
    terms = orphan_terms(df, target).select(F.col("source_value").alias("_term"))
    keyed = terms.withColumn("_wanted", text.normalized_key(F.col("_term")))
    found = keyed.join(_usable(approvals, target), F.col("_wanted") == F.col("_key")).drop("_wanted")
    return stage(found, "term-approvals")


def _with_approval(df: DataFrame, target: Target, approvals: DataFrame, of_terms: DataFrame | None) -> DataFrame:
    current = df.withColumn(target.concept_col, lenient_id(df, target.concept_col))
    unmapped = F.col(target.concept_col) == 0
    if of_terms is not None:
        return current.join(of_terms, (F.col(target.source_col) == F.col("_term")) & unmapped, "left")
    # A column of its own: as an expression of the join, a sort would work the key out at every comparison.
    current = current.withColumn("_wanted", text.normalized_key(F.col(target.source_col)))
    same = (F.col("_wanted") == F.col("_key")) & unmapped
    return current.join(_usable(approvals, target), same, "left").drop("_wanted")


def apply_approvals(
    df: DataFrame, target: Target, approvals: DataFrame, of_terms: DataFrame | None = None
) -> DataFrame:
    """Write approved concept ids into the unmapped rows with the same normalized term.

    As in ``apply_terms``, pass staged ``approvals``.  With ``of_terms`` (from ``approvals_of_terms``)
    rows are looked up by their raw term.
    """
    joined = _with_approval(df, target, approvals, of_terms)
    return joined.withColumn(target.concept_col, F.coalesce("_concept", target.concept_col)).select(*df.columns)


def provenance_of_approvals(
    df: DataFrame, target: Target, approvals: DataFrame, run_id: str, of_terms: DataFrame | None = None
) -> DataFrame:
    """Audit rows of the events that ``apply_approvals`` changes.  ``of_terms`` as there."""
    return (
        _with_approval(df, target, approvals, of_terms)
        .where("_concept is not null")
        .select(
            F.lit(target.table).alias("target_table"),
            F.col(target.id_col).cast("bigint").alias("target_id"),
            F.col(target.source_col).alias("source_value"),
            F.col("_key").alias("normalized_value"),
            F.col("_concept").alias("assigned_concept_id"),
            F.lit(APPROVED).alias("mapping_method"),
            F.col("_score").alias("score"),
            F.col("_model").alias("model_name"),
            F.col("_version").alias("vocabulary_version"),
            F.col("_by").alias("reviewed_by"),
            F.lit(run_id).alias("run_id"),
            F.col("_decision").alias("mapping_decision_id"),
        )
    )


def apply_approved_tables(
    tables: dict[str, DataFrame],
    approved: DataFrame,
    decisions: DataFrame,
    concept: DataFrame,
    run_id: str,
    written: dict[str, DataFrame] | None = None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Apply active approvals to all target tables: (tables, provenance).  ``written`` as in ``map_tables``."""
    approvals = stage(active_approvals(approved, decisions, concept), "approvals")
    require_usable(approvals)
    targets = [TARGETS[name] for name in tables if name in TARGETS]
    of_terms = {t.table: approvals_of_terms(tables[t.table], t, approvals) for t in targets}
    audit = [provenance_of_approvals(tables[t.table], t, approvals, run_id, of_terms[t.table]) for t in targets]
    changed = written or tables
    done = {t.table: apply_approvals(changed[t.table], t, approvals, of_terms[t.table]) for t in targets}
    return {**changed, **done}, reduce(DataFrame.unionByName, audit)

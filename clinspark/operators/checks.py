"""Contracts of the raw domains.

A check is a one-row report: ``subject`` and one counter per rule.  Counters
come from one aggregation over the few columns involved.  ``require_clean``
turns a non-zero counter into an error that names the rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinspark.contracts import require_columns
from clinspark.functions import dates, numbers, text


def count_if(condition: Column, name: str) -> Column:
    """Rows where the condition holds; a null condition does not count."""
    return F.count_if(F.coalesce(condition, F.lit(False))).alias(name)


def repeated_rows(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """How many rows repeat an earlier key; nulls count as equal."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias(name))


def _report(subject: str, counters: DataFrame) -> DataFrame:
    return counters.select(F.lit(subject).alias("subject"), *counters.columns)


def check_history(mh: DataFrame) -> DataFrame:
    """MH: every date readable, every term present."""
    require_columns(mh, ["USUBJID", "MHTERM", "MHSTDTC"], "MH")
    counters = mh.agg(
        count_if(dates.clinical_date_of(mh, "MHSTDTC").isNull(), "unparseable_dates"),
        count_if(F.col("MHTERM").isNull(), "missing_terms"),
    )
    return _report("MH", counters)


def check_ecg(eg: DataFrame) -> DataFrame:
    """EG: every date readable, every result numeric."""
    require_columns(eg, ["USUBJID", "EGDTC", "EGTEST", "EGORRES", "EGORRESU"], "EG")
    counters = eg.agg(
        count_if(dates.clinical_date_of(eg, "EGDTC").isNull(), "unparseable_dates"),
        count_if(numbers.first_number(eg, "EGSTRESN", "EGORRES").isNull(), "non_numeric_results"),
    )
    return _report("EG", counters)


def check_periods(dm: DataFrame) -> DataFrame:
    """DM: subject ids, reference dates in order, one row per subject."""
    require_columns(dm, ["USUBJID", "RFSTDTC", "RFENDTC"], "DM observation-period")
    rows = dm.select(
        text.person_id(F.col("USUBJID")).alias("person_id"),
        dates.clinical_date_of(dm, "RFSTDTC").alias("start"),
        dates.clinical_date_of(dm, "RFENDTC").alias("end"),
    )
    per_person = rows.groupBy("person_id").agg(
        F.count(F.lit(1)).alias("n"),
        count_if(F.col("start").isNull(), "starts"),
        count_if(F.col("end").isNull(), "ends"),
        count_if(F.col("end") < F.col("start"), "reversed"),
    )
    counters = per_person.agg(
        _total(F.when(F.col("person_id").isNull(), F.col("n")), "missing_subject_ids"),
        _total(F.col("starts"), "invalid_starts"),
        _total(F.col("ends"), "invalid_ends"),
        _total(F.col("reversed"), "reversed_periods"),
        _total(F.col("n") - 1, "duplicate_subjects"),
    )
    return _report("DM observation-period", counters)


def check_visits(sv: DataFrame) -> DataFrame:
    """SV: nothing missing, dates in order, one row per subject and visit number."""
    require_columns(sv, ["USUBJID", "VISITNUM", "VISIT", "SVSTDTC", "SVENDTC"], "SV")
    rows = sv.select(
        text.person_id(F.col("USUBJID")).alias("person_id"),
        numbers.number_of(sv, "VISITNUM").alias("visit_num"),
        F.col("VISIT").alias("visit"),
        dates.clinical_date_of(sv, "SVSTDTC").alias("start"),
        dates.clinical_date_of(sv, "SVENDTC").alias("end"),
    )
    anything_missing = F.lit(False)
    for name in rows.columns:
        anything_missing = anything_missing | F.col(name).isNull()
    per_key = rows.groupBy("person_id", "visit_num").agg(
        F.count(F.lit(1)).alias("n"),
        count_if(anything_missing, "invalid"),
        count_if(F.col("end") < F.col("start"), "reversed"),
    )
    counters = per_key.agg(
        _total(F.col("invalid"), "invalid_required_values"),
        _total(F.col("reversed"), "reversed_visits"),
        _total(F.col("n") - 1, "duplicate_subject_visit_numbers"),
    )
    return _report("SV", counters)


def _total(value: Column, name: str) -> Column:
    return F.coalesce(F.sum(value), F.lit(0)).cast("bigint").alias(name)


def contract_report(reports: list[DataFrame]) -> DataFrame:
    """All counters of several checks as rows (subject, rule, violations)."""
    long_form = None
    for report in reports:
        rules = [name for name in report.columns if name != "subject"]
        rows = report.unpivot(["subject"], rules, "rule", "violations")
        long_form = rows if long_form is None else long_form.unionByName(rows)
    return long_form


def require_clean(report: DataFrame) -> None:
    """Raise if the one-row report has a non-zero counter."""
    row = report.first().asDict()
    subject = row.pop("subject")
    if any(row.values()):
        detail = "; ".join(f"{name.replace('_', ' ')}: {count}" for name, count in row.items())
        raise ValueError(f"{subject} does not keep its contract ({detail}).")

"""Lenient clinical dates.

Results are ``timestamp_ntz``: the source carries no zones, and a zone suffix
leaves the wall-clock time as written.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinspark.functions.text import strip

NTZ = "timestamp_ntz"
EPOCH = "1960-01-01"
# Days from EPOCH to the first day of year 1 and to the end of year 9999, what a date can be written as.
FIRST_DAY = (dt.date(1, 1, 1) - dt.date(1960, 1, 1)).days
LAST_DAY = (dt.date(9999, 12, 31) - dt.date(1960, 1, 1)).days + 1

YEAR = r"\d{4}"

ISO_DATE = rf"^{YEAR}(-\d{{1,2}}(-\d{{1,2}})?)?T?$"
ISO_MOMENT = rf"^{YEAR}-\d{{1,2}}-\d{{1,2}}[T ]\d{{1,2}}.*$"
ISO_HOUR = r"^([\d-]+[T ]\d{1,2})$"
ZONE = r"(Z|[+-]\d{2}:?\d{2})$"
OTHER_YEAR = rf"(^|\D){YEAR}(\d{{4}}(T\d{{4,6}})?|/.*)?$"
DAY_COUNT = r"^[+-]?0*([1-9]\d{4}|100000)(\.0+)?$"

# Other spellings, as formats.  In text of numbers only the month
# comes first unless the first number is above 12; ``x`` stands for such a number.
OTHER_FORMATS = [
    "yyyyMMdd",
    "yyyyMMdd'T'HHmm",
    "yyyyMMdd'T'HHmmss",
    "yyyy/M/d",
    "M/d/yyyy",
    "M.d.yyyy",
    "x/M/yyyy",
    "x.M.yyyy",
    "dMMMyyyy",
    "d-MMM-yyyy",
    "d MMM yyyy",
    "d MMMM yyyy",
    "MMM d, yyyy",
    "MMM d yyyy",
    "MMMM d, yyyy",
    "MMMM d yyyy",
    "MMMyyyy",
    "MMM yyyy",
]
DAY_FIRST = r"^(1[3-9]|2\d|3[01])([/.])"


def _shapes(fmt: str) -> list[str]:
    """What text in a format looks like once digits are 9, short months m and long months n."""
    shape = fmt.replace("'", "").replace("MMMM", "n").replace("MMM", "m")
    shape = re.sub("yyyy|HH|mm|ss|MM|dd", lambda part: "9" * len(part.group()), shape)
    shapes = [shape]
    for letter in "dM":
        shapes = [s.replace(letter, digits) for s in shapes for digits in (("9", "99") if letter in s else ("",))]
    return shapes


def _other_spelling(value: Column) -> Column:
    """The date in a spelling that is not ISO.

    The text's shape picks its format, so that this takes the same few
    operations however many spellings there are.  A chain of cases would make
    the generated code of tables with several dates too large to be compiled.
    """
    shape = F.regexp_replace(value, DAY_FIRST, "x$2")
    shape = F.regexp_replace(F.regexp_replace(shape, "[A-Za-z]{4,}", "n"), "[A-Za-z]{3}", "m")
    shape = F.translate(shape, "0123456789", "9999999999")
    pairs = [f"{known}={fmt.replace('x', 'd')}" for fmt in OTHER_FORMATS for known in _shapes(fmt)]
    formats = F.str_to_map(F.lit(";".join(pairs)), F.lit(";"), F.lit("="))  # a constant, folded by the optimizer
    parsed = F.try_to_timestamp(value, F.try_element_at(formats, shape)).cast(NTZ)
    return F.when(value.rlike(OTHER_YEAR), parsed)


def _lenient(value: Column) -> Column:
    moment = F.regexp_replace(F.regexp_replace(value, ZONE, ""), ISO_HOUR, "$1:00")
    return (
        F.when(value.rlike(ISO_DATE), F.rtrim(value, F.lit("T")).try_cast(NTZ))
        .when(value.rlike(ISO_MOMENT), moment.try_cast(NTZ))
        .otherwise(_other_spelling(value))
    )


def lenient_date(text: Column) -> Column:
    """Date text in any known spelling; null when it cannot be read."""
    return _lenient(strip(text))


def from_day_count(days: Column) -> Column:
    """Days since 1960-01-01, fraction kept; null for counts beyond the years 1 to 9999."""
    count = days.cast("double")
    seconds = (count * 86400).try_cast("decimal(18,6)")
    moment = F.lit(EPOCH).cast(NTZ) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return F.when((count >= FIRST_DAY) & (count < LAST_DAY), moment)


def clinical_date(text: Column) -> Column:
    """Clinical date text: a day count from 10000 to 100000, signed or not, or a lenient date."""
    value = strip(text)
    counted = F.date_add(F.lit(EPOCH).cast("date"), value.try_cast("double").cast("int")).cast(NTZ)
    return F.when(value.rlike(DAY_COUNT), counted).otherwise(_lenient(value))


def _typed(df: DataFrame, name: str, for_text, for_number) -> Column:
    if name not in df.columns:
        return F.lit(None).cast(NTZ)
    kind, column = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return column.cast(NTZ)
    if isinstance(kind, T.NumericType):
        return for_number(column)
    return for_text(column.cast("string"))


def clinical_date_of(df: DataFrame, name: str) -> Column:
    """Clinical date of a column of any type; null for an absent column."""
    return _typed(df, name, clinical_date, from_day_count)


def lenient_date_of(df: DataFrame, name: str) -> Column:
    """As ``clinical_date_of`` without the day-count rule."""
    return _typed(df, name, lenient_date, lambda c: lenient_date(c.cast("string")))


def vocabulary_date(text: Column) -> Column:
    """``yyyyMMdd``, else ISO, else null."""
    value = strip(text)
    compact = F.when(value.rlike(r"^\d{8}$"), F.try_to_timestamp(value, F.lit("yyyyMMdd")).cast("date"))
    return F.coalesce(compact, F.when(value.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), value.try_cast("date")))

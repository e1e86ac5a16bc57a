"""The query registry, and the SQL shorthands its DuckDB counterparts share."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.views import Views, duck_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# DuckDB-only views: what the patient tables must look like, written as SQL.
ORACLE_VIEWS: dict[str, str] = {}

MACROS = {
    "pid": r"""case when trim(X) <> '' and lower(trim(X)) <> 'nan'
                    then cast('0x' || substr(sha256(trim(X)), 1, 15) as bigint) end""",
    "lenient": r"""case when regexp_full_match(trim(X), '\d{4}') then try_cast(trim(X) || '-01-01' as timestamp)
                        when regexp_full_match(trim(X), '\d{4}-\d{1,2}') then try_cast(trim(X) || '-01' as timestamp)
                        when regexp_full_match(trim(X), '\d{4}-\d{1,2}-\d{1,2}([T ]\d{2}:\d{2}(:\d{2})?)?')
                            then try_cast(trim(X) as timestamp)
                        when regexp_full_match(trim(X), '\d{1,2}[A-Za-z]{3}\d{4}')
                            then try_strptime(trim(X), '%d%b%Y')
                        when regexp_full_match(trim(X), '\d{2}/\d{2}/\d{4}') then try_strptime(trim(X), '%m/%d/%Y')
                        when regexp_full_match(trim(X), '\d{8}') then try_strptime(trim(X), '%Y%m%d')
                   end""",
    "clinical": r"""case when regexp_full_match(trim(X), '[+-]?\d+(\.0+)?')
                              and abs(try_cast(trim(X) as double)) between 10000 and 100000
                         then timestamp '1960-01-01' + to_days(cast(try_cast(trim(X) as double) as integer))
                         else @lenient(X) end""",
    "number": r"""case when regexp_full_match(trim(X), '[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?')
                       then try_cast(trim(X) as double) end""",
    "key": r"lower(trim(regexp_replace(X, '\s+', ' ', 'g')))",
    "squash": r"regexp_replace(lower(X), '[^a-z0-9]', '', 'g')",
    "tokens": r"""list_filter(regexp_extract_all(lower(regexp_replace(
                      regexp_replace(X, '[\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}\x{370}-\x{1FFF}]', '_', 'g'),
                      '\b([a-zA-Z])[-\s]([a-zA-Z])\b', '\1\2', 'g')), '[a-z0-9]+'),
                      lambda w: length(w) >= 2 or w between '0' and '9')""",
    "informative": r"""case when len(list_filter(X, lambda w: w not in
                            ('duration', 'level', 'measurement', 'result', 'site', 'test', 'type'))) > 0
                       then list_filter(X, lambda w: w not in
                            ('duration', 'level', 'measurement', 'result', 'site', 'test', 'type')) else X end""",
    "longest": r"""list_extract(X, list_position(list_transform(X, lambda w: length(w)),
                                         list_max(list_transform(X, lambda w: length(w)))))""",
    "unit": r"""case when trim(X) <> '' then case trim(X) when 'MG/DL' then 8840 when 'mg/dL' then 8840 when 'U/L' then 8645
                    when 'beats/min' then 8541 when 'g/dL' then 8713 when 'kg' then 9529 when 'mmHg' then 8876
                    when 'msec' then 9593 else 0 end end""",
    "stamp": r"strftime(X, '%Y-%m-%d %H:%M:%S')",
    "valid": r"date '2024-01-01' between X.valid_start_date and X.valid_end_date",
    "current": r"(X.invalid_reason is null or X.invalid_reason = '')",
    "standard": r"X.standard_concept = 'S' and (X.invalid_reason is null or X.invalid_reason = '')",
}

_MACRO = re.compile(r"@(\w+)\(")


def expand(sql: str) -> str:
    """Replace every ``@name(argument)`` by its macro, innermost brackets included."""
    while found := _MACRO.search(sql):
        depth, end = 1, found.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        argument = sql[found.end() : end - 1]
        body = re.sub(r"\bX\b", lambda _: argument, MACROS[found.group(1)])
        sql = f"{sql[: found.start()]}({body}){sql[end:]}"
    return sql


def oracle_view(name: str, sql: str) -> None:
    ORACLE_VIEWS[name] = expand(sql)


def query(name: str, sql: str | None = None):
    """Register a query over the views, with its DuckDB counterpart if SQL can express it."""

    def register(build: Callable[[Views], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Views(spark, folder))
        if sql is not None:
            ORACLES[name] = duck_sql(expand(sql), ORACLE_VIEWS)
        return build

    return register


def stamped(df: DataFrame) -> DataFrame:
    """Timestamps as text, so that both engines print them alike."""
    return df.select(
        [
            F.date_format(f.name, "yyyy-MM-dd HH:mm:ss").alias(f.name)
            if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
            else F.col(f.name)
            for f in df.schema
        ]
    )

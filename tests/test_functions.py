import datetime as dt
import hashlib
import math
import random

import pandas as pd
import plain
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clinspark.functions import codes, dates, numbers, similarity, text

STAMP = dt.datetime


def column(frame, values, function, kind="string"):
    rows = frame(f"i int, x {kind}", *enumerate(values))
    return [r.y for r in rows.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()]


# --- identifiers and keys -------------------------------------------------------------------


def test_person_id_is_stable_positive_and_null_for_blank(frame):
    names = ["S-01", "S-01", " S-01\n", "S-02", None, "", "  ", "NaN", "LONG" * 30]
    ids = column(frame, names, text.person_id)
    assert ids[0] == ids[1] == ids[2] == int(hashlib.sha256(b"S-01").hexdigest()[:15], 16)
    assert ids[3] != ids[0]
    assert ids[4:8] == [None] * 4
    assert 0 < ids[8] < 2**63


def test_normalized_key_folds_blanks_and_case(frame):
    got = column(frame, ["  AMBIGUOUS   TERM ", "a\t b", "Straße", None], text.normalized_key)
    assert got == ["ambiguous term", "a b", "strasse", None]


def test_coded_term_falls_back_to_verbatim(frame):
    rows = frame("c string, v string", ("CODED", "said"), (" ", "said"), (None, "said"), (None, None))
    got = [r[0] for r in rows.select(text.coded_or_verbatim(F.col("c"), F.col("v"))).collect()]
    assert got == ["CODED", "said", "said", None]


def test_clinical_tokens(frame):
    terms = ["QT Duration", "Q-T interval", "R R x", "A1C 5 b", "%", "Test level", "é a b"]
    assert column(frame, terms, text.clinical_tokens) == [
        ["qt", "duration"],
        ["qt", "interval"],
        ["rr"],
        ["a1c", "5"],
        [],
        ["test", "level"],
        ["ab"],
    ]


def test_informative_tokens_and_longest(frame):
    tokens = [["qt", "duration"], ["test", "level"], ["heart", "rates"], []]
    assert column(frame, tokens, text.informative_tokens, "array<string>") == [
        ["qt"],
        ["test", "level"],
        ["heart", "rates"],
        [],
    ]
    assert column(frame, tokens, text.longest_token, "array<string>") == ["duration", "level", "heart", None]


def test_first_integer(frame):
    replies = ["ID: 42 or 7", "none", None, "", "0", "9" * 30]
    assert column(frame, replies, text.first_integer) == [42, None, None, None, 0, None]


# --- dates ----------------------------------------------------------------------------------

SPELLINGS = (
    "2023|2023-01|2023-1-5|2023-01-10T08:30|2023-01-10T08|2023-01-10T08:30:15.5|2023-01-10 08:30|2023-01-10T08:30Z|"
    "2023-01-10T08:30+02:00|10JAN2023|10-JAN-2023|10 Jan 2023|Jan 10, 2023|January 10 2023|01/10/2023|13/10/2023|"
    "2023/01/10|20230110|20230110T0830|202301|2023-13-01|2023-02-30|unknown|UN-UN-2023|--01-10|5|99999|123|T08:30|"
    "10.01.2023|2023-W05|2023-010|0001-01-01|9999-12-31|1600-01-01|2023-01-10T24:00| 2023-01-10 |3 days|2023-01-10T|"
    "2023-1|JAN2023|Jan 2023|2023JAN10|-2023|+2023||02/30/2023|31.12.1999"
).split("|")


def test_lenient_dates_agree_with_pandas(frame):
    got = column(frame, SPELLINGS, dates.lenient_date)
    for spelling, value in zip(SPELLINGS, got):
        wanted = pd.to_datetime(spelling, errors="coerce")
        if pd.isna(wanted):
            # That library holds the years 1678 to 2261 only.
            assert value is None or not 1678 <= value.year <= 2261, spelling
        else:
            assert pd.Timestamp(value) == wanted.tz_localize(None), spelling


def test_clinical_dates_read_day_counts(frame):
    texts = ["23020", " 23020.0 ", "2023-01-10", "21758", "9999", "100001", "-20000", "023020", None]
    day = STAMP(2023, 1, 10)
    assert column(frame, texts, dates.clinical_date) == [
        day,
        day,
        day,
        STAMP(2019, 7, 28),
        STAMP(9999, 1, 1),
        None,
        STAMP(1905, 3, 30),
        day,
        None,
    ]


def test_numeric_day_counts_keep_the_fraction(frame):
    got = column(frame, [23020.0, 23020.5, math.nan, math.inf, None, 1e9], dates.from_day_count, "double")
    assert got == [STAMP(2023, 1, 10), STAMP(2023, 1, 10, 12), None, None, None, None]


def test_typed_columns_pass_through(frame):
    df = frame("d date, t timestamp, n int", (dt.date(2023, 1, 10), STAMP(2023, 1, 10, 8), 23020))
    row = df.select(*[dates.clinical_date_of(df, c).alias(c) for c in ("d", "t", "n", "absent")]).first()
    assert tuple(row) == (STAMP(2023, 1, 10), STAMP(2023, 1, 10, 8), STAMP(2023, 1, 10), None)


def test_vocabulary_dates(frame):
    got = column(frame, ["20200101", "2099-12-31", " 20200101 ", "", "2020", "20201301", None], dates.vocabulary_date)
    assert got == [dt.date(2020, 1, 1), dt.date(2099, 12, 31), dt.date(2020, 1, 1), None, None, None, None]


# --- numbers and codes ----------------------------------------------------------------------


@pytest.mark.parametrize(
    "values",
    ["69| 69 |1e3|+5|.5|5.|inf|-Infinity|nan|0x1A|1_000|1,000|<5|True|5d|5f||1e400|--5|1 2|5L|\t7\n".split("|")],
)
def test_lenient_numbers_agree_with_pandas(frame, values):
    for value, number in zip(values, column(frame, values, numbers.lenient_number)):
        wanted = pd.to_numeric(value, errors="coerce")
        assert (number is None) == bool(pd.isna(wanted)) and (number is None or number == wanted), value


def test_first_number_skips_what_is_no_number(frame):
    df = frame("a double, b string", (None, "69"), (1.5, "69"), (math.nan, "x"), (None, None))
    got = [r[0] for r in df.select(numbers.first_number(df, "absent", "a", "b")).collect()]
    assert got == [69.0, 1.5, None, None]


def test_code_lists(frame):
    assert column(frame, ["M", "F", "U", "m", None], codes.gender_concept) == [8507, 8532, 8521, 0, 0]
    races = ["white", "Black or African American", "unknown", " asian", None]
    assert column(frame, races, codes.race_concept) == [8527, 8516, 0, 0, 0]
    units = ["mg/dL", "MG/DL", " beats/min ", "custom-unit", "Mg/dl", None, " "]
    assert column(frame, units, codes.unit_concept) == [8840, 8840, 8541, 0, 0, None, None]


def test_type_concepts(spark, frame):
    assert {t for t, *_ in codes.TYPE_CONCEPTS} >= {"measurement", "visit_occurrence"}
    assert codes.type_concept_id(" MEASUREMENT ", "eg") == 32809
    assert codes.type_concept_id("observation_period", "DERIVED") == 32880
    with pytest.raises(ValueError, match="No type concept is documented for measurement/CENTRAL_LAB"):
        codes.type_concept_id("measurement", "CENTRAL_LAB")
    required = {(r.concept_id, r.concept_name) for r in codes.required_type_concepts(spark).collect()}
    assert required == {(32809, "Case Report Form"), (32880, "Standard algorithm")}
    rows = frame("t string, d string", ("Measurement", "lb"), ("measurement", "zz"))
    got = {r.d: r.type_concept_id for r in codes.with_type_concept(rows, "t", "d").collect()}
    assert got == {"lb": 32809, "zz": None}


# --- similarity -----------------------------------------------------------------------------


NAMES = [
    "new york mets",
    "mets york new",
    "heart rate",
    "heart-rate",
    "Heart_Rate  (n)",
    "fuzzy was a bear",
    "fuzzy fuzzy was a bear",
    "",
    "%",
    "x",
    "Hypertension",
    "Essential hypertension",
    "RR Duration",
    "R-R interval",
    "caf\u00e9 \u03b2 \u6570\u5b57 \U0001f642 \u0130",
    "abc" * 30,
    "cab" * 41 + " d",
    "a" * 62,
    "a" * 63,
    "ab" * 62 + " " + "ba" * 31,
    None,
]


def test_similarity_of_all_pairs(spark, frame):
    names = frame("a string", *[(n,) for n in NAMES])
    pairs = names.join(names.toDF("b"), F.lit(True))
    got = pairs.select(
        "a", "b", similarity.token_sort_similarity(F.col("a"), F.col("b")), similarity.token_set_similarity(F.col("a"), F.col("b"))
    ).collect()
    assert len(got) == len(NAMES) ** 2
    for a, b, ordered, as_sets in got:
        assert (ordered, as_sets) == (plain.sort_similarity(a, b), plain.set_similarity(a, b)), (a, b)


@pytest.mark.parametrize("seed", range(3))
def test_common_subsequence_matches_the_textbook_one(frame, seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choice("abc d") for _ in range(rng.randrange(0, 200))) for _ in range(120)]
    pairs = frame("a string, b string", *[(rng.choice(texts), rng.choice(texts)) for _ in range(300)])
    for a, b, n in pairs.select("a", "b", similarity.common(F.col("a"), F.col("b"))).collect():
        assert n == plain.common(a, b), (a, b)


def test_confidence_values(frame):
    rows = [("Hypertension", "Essential hypertension"), ("RR Duration", "R-R interval"), (None, "x"), ("", "x")]
    df = frame("a string, b string", *rows)
    got = [r[0] for r in df.select(similarity.confidence(F.col("a"), F.col("b"))).collect()]
    assert got == [1.0, 0.38, 0.0, 0.0]  # 2 * 4 / (11 + 10)

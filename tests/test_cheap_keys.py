"""Keys and codes that are worked out once per row, and not by searching every text for rare letters."""

import re

import pytest
from clinspark.functions import codes, text
from clinspark.operators import mapping, rules
from pyspark.sql import functions as F


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plain_text_is_not_searched_for_special_letters(frame):
    key = text.folded_case(F.col("s"))
    condition = str(frame("s string", ("a",)).select(key)._jdf.queryExecution().analyzed())
    assert condition.index("octet_length") < condition.index("RLIKE")


def test_folding_is_the_full_one(frame):
    words = ["Straße", "ﬁt", "ΛΌΓΟΣ", "plain TEXT", "Ünder", "", None, "K", "ſ", "ᏸ x"]
    rows = frame("s string", *[(w,) for w in words]).select("s", text.folded_case(F.col("s")).alias("k")).collect()
    assert {r.s: r.k for r in rows} == {w: w and w.casefold() for w in words}


def test_every_blank_joins_words_and_its_neighbours_do_not(frame):
    points = sorted({ord(b) + d for b in text.BLANKS for d in (-1, 0, 1)})
    rows = frame("p int, s string", *[(p, f"a{chr(p)}{chr(p)}b") for p in points])
    found = {r.p: r.k for r in rows.select("p", text.normalized_key(F.col("s")).alias("k")).collect()}
    for p in points:
        assert (found[p] == "a b") == (chr(p) in text.BLANKS), hex(p)


@pytest.mark.parametrize("known", [codes.GENDER, codes.RACE, codes.ETHNICITY, codes.UNIT])
def test_codes_are_looked_up_once(frame, known):
    codes_seen = [*known, *[c.lower() for c in known], "", "other", None]
    df = frame("c string", *[(c,) for c in codes_seen]).select("c", codes._decode(F.col("c"), known).alias("id"))
    assert {r.c: r.id for r in df.collect()} == {c: known.get(c, 0) for c in codes_seen}
    assert df.schema["id"].dataType.simpleString() == "bigint"
    counted = frame("c string", ("x",)).select(codes._decode(F.btrim("c"), known).alias("id"))
    assert len(re.findall(r"trim\(", plan_of(counted))) == 1


def test_a_sort_never_compares_by_the_whole_key_expression(spark, frame):
    events = frame("drug_exposure_id long, drug_concept_id long, drug_source_value string", (1, 0, "A  b"), (2, 0, "c"))
    approvals = frame(
        "target_table string, normalized_value string, concept_id long, source_decision_id long, approved_by string, "
        "score double, model_name string, vocabulary_version string, problem string",
        ("drug_exposure", "a b", 7, 1, "Ann", 1.0, "m", "v", None),
    )
    target = mapping.TARGETS["drug_exposure"]
    done = mapping.apply_approvals(events, target, approvals.hint("merge"))
    assert sorted(map(tuple, done.collect())) == [(1, 7, "A  b"), (2, 0, "c")]
    sorts = [line for line in plan_of(done).splitlines() if re.search(r"\bSort \[", line)]
    assert sorts and not any("regexp_replace" in line for line in sorts)


def test_rule_keys_are_worked_out_per_term(spark, frame):
    """Rows are joined by their raw term, and give what the key of every row gives."""
    events = frame(
        "drug_exposure_id long, drug_concept_id long, drug_source_value string",
        (1, 0, "A  b"), (2, 0, "c"), (3, 5, "A  b"), (4, None, "a B"), (5, 0, None), (6, 0, "A  b"),
    )
    approvals = frame(
        "target_table string, normalized_value string, concept_id long, source_decision_id long, approved_by string, "
        "score double, model_name string, vocabulary_version string, problem string",
        ("drug_exposure", "a b", 7, 1, "Ann", 1.0, "m", "v", None),
        ("drug_exposure", "c", 8, 2, "Ann", 1.0, "m", "v", "is not standard any more"),
    )
    target = mapping.TARGETS["drug_exposure"]
    of_terms = mapping.approvals_of_terms(events, target, approvals)
    done = mapping.apply_approvals(events, target, approvals, of_terms)
    audit = mapping.provenance_of_approvals(events, target, approvals, "R", of_terms)
    assert "regexp_replace" not in plan_of(done) + plan_of(audit)
    per_row = mapping.apply_approvals(events, target, approvals)
    assert sorted(map(str, done.collect())) == sorted(map(str, per_row.collect()))
    assert {r.drug_exposure_id: r.drug_concept_id for r in done.collect()} == {1: 7, 2: 0, 3: 5, 4: 7, 5: 0, 6: 7}
    assert sorted(r.target_id for r in audit.collect()) == [1, 4, 6]


def test_new_rows_reads_its_candidates_once(spark, frame):
    rows = frame("a long, b string, c string", (1, "x", "m"), (1, "x", "l"), (None, "x", "m"), (None, "x", "m"), (2, "y", "m"))
    fresh = rules.new_rows(rows, frame("a long, b string", (2, "y"), (None, "x")), ["a", "b"])
    assert "Union" not in fresh._jdf.queryExecution().optimizedPlan().toString()
    got = sorted(map(str, ((r.a, r.b, r.c) for r in fresh.collect())))
    assert got == sorted(map(str, [(1, "x", "l"), (None, "x", "m"), (None, "x", "m")]))

"""Candidates where many concepts share a name."""

import datetime as dt

from clinspark.operators import candidates

CONCEPT = (
    "concept_id long, concept_name string, domain_id string, standard_concept string, invalid_reason string, "
    "valid_start_date date, valid_end_date date"
)
DAYS = (dt.date(1970, 1, 1), dt.date(2099, 12, 31))


def concepts(spark, *rows):
    return spark.createDataFrame([(*row, "S", None, *DAYS) for row in rows], CONCEPT)


def terms(spark, *values):
    return spark.createDataFrame([("Drug", value) for value in values], "domain_id string, source_value string")


def test_shortlist_takes_the_lowest_ids_of_a_shared_name(spark):
    shared = [(i, "hot bolt", "Drug") for i in range(400, 0, -1)]
    vocabulary = concepts(spark, *shared, (7, "hot bolt", "Condition"), (500, "warm bolt", "Drug"), (None, "hot bolt", "Drug"))
    found = candidates.shortlist(terms(spark, "hot bolt"), vocabulary, "2024-01-01", 5).orderBy("position").collect()
    assert [r.concept_id for r in found] == [1, 2, 3, 4, 5]


def test_only_the_ids_that_can_win_are_indexed(spark):
    shared = concepts(spark, *[(i, "hot bolt", "Drug") for i in range(50)], (60, "other", "Drug"), (60, "other", "Drug"))
    names = candidates._names_of(terms(spark, "bolt"), shared, "2024-01-01")
    kept = sorted(r.concept_id for r in candidates._lowest_ids(names, 3).collect())
    assert kept == [0, 1, 2, 60, 60]


def test_prefiltered_gives_every_concept_of_a_name_and_matches_it_once(spark, monkeypatch):
    seen = []
    whole = candidates.containing

    def counted(words, names, *key):
        seen.append(names.count())
        return whole(words, names, *key)

    monkeypatch.setattr(candidates, "containing", counted)
    shared = [(i, "hot bolt", "Drug") for i in (3, 1, 2, 2)] + [(9, "cold ring", "Drug"), (None, "hot bolt", "Drug")]
    found = candidates.prefiltered(terms(spark, "bolt", "a ring"), concepts(spark, *shared), "2024-01-01").collect()
    assert seen == [2]
    assert sorted((r.source_value, r.place, r.concept_id) for r in found) == [
        ("a ring", 1, 9), ("bolt", 1, 1), ("bolt", 2, 2), ("bolt", 3, 2), ("bolt", 4, 3)
    ]

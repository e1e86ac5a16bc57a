import datetime as dt
import random

import pytest
from plain import sort_similarity
from pyspark.sql import functions as F

from clinspark.operators import candidates, mapping, rules
from clinspark.session import stage

D = dt.date
CONCEPT = (
    "concept_id long, concept_name string, domain_id string, standard_concept string, invalid_reason string, "
    "valid_start_date date, valid_end_date date"
)
RELATION = (
    "concept_id_1 long, concept_id_2 long, relationship_id string, invalid_reason string, "
    "valid_start_date date, valid_end_date date"
)
ALWAYS = (D(1970, 1, 1), D(2099, 12, 31))
CONDITION = "condition_occurrence_id long, condition_source_value string, condition_concept_id long"
TODAY = "2024-01-01"
NOW = "2024-01-01 12:00:00"


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def concept(i, name, domain="Condition", standard="S", reason=None, end=D(2099, 12, 31)):
    return (i, name, domain, standard, reason, D(1970, 1, 1), end)


def terms_of(frame, *values, domain="Condition"):
    rows = [("condition_occurrence", domain, v) for v in values]
    return frame("target_table string, domain_id string, source_value string", *rows)


# --- deterministic --------------------------------------------------------------------------


def test_expired_concepts_are_ignored_and_the_lowest_id_wins(frame):
    vocabulary = frame(
        CONCEPT, concept(1, "Same term", end=D(2000, 12, 31)), concept(20, "Same term"), concept(10, "SAME term")
    )
    row = mapping.map_terms(terms_of(frame, " same TERM "), vocabulary, frame(RELATION), TODAY).first()
    assert (row.concept_id, row.concept_name, row.mapping_method) == (10, "SAME term", mapping.DIRECT)


def test_maps_to_is_second_choice(frame):
    vocabulary = frame(
        CONCEPT,
        concept(1, "Old name", standard=None),
        concept(2, "Target"),
        concept(3, "Lower target"),
        concept(4, "Elsewhere", domain="Drug"),
        concept(5, "Gone name", standard=None, reason="D"),
        concept(6, "Chained", standard=None),
    )
    relation = frame(
        RELATION,
        (1, 3, "Maps to", "", *ALWAYS),
        (1, 2, "Maps to", None, *ALWAYS),
        (1, 4, "Maps to", None, *ALWAYS),
        (5, 2, "Maps to", None, *ALWAYS),
        (2, 3, "Maps to", None, *ALWAYS),
        (6, 1, "Maps to", None, *ALWAYS),
        (4, 2, "Is a", None, *ALWAYS),
    )
    terms = terms_of(frame, "old name", "gone name", "target", "chained", "elsewhere")
    got = {r.source_value: (r.concept_id, r.mapping_method) for r in mapping.map_terms(terms, vocabulary, relation, TODAY).collect()}
    assert got == {
        "old name": (2, mapping.MAPS_TO),
        "gone name": (0, None),
        "target": (2, mapping.DIRECT),
        "chained": (0, None),
        "elsewhere": (0, None),
    }


def test_mapping_writes_back_and_audits_once(frame):
    tables = {
        "condition_occurrence": frame(
            CONDITION, (101, "Hypertension", 0), (102, "Hypertension", 7), (103, None, 0), (104, "Other", None)
        )
    }
    vocabulary = frame(CONCEPT, concept(320128, "Hypertension"))
    done, audit, mapped = mapping.map_tables(tables, vocabulary, frame(RELATION), "RUN-TEST", TODAY)
    got = {r.condition_occurrence_id: r.condition_concept_id for r in done["condition_occurrence"].collect()}
    assert got == {101: 320128, 102: 7, 103: 0, 104: 0}
    first = rules.append_provenance(audit, rules.empty(audit.sparkSession, "provenance"), now())
    row = first.collect()
    assert [(r.provenance_id, r.target_id, r.assigned_concept_id, r.run_id) for r in row] == [(1, 101, 320128, "RUN-TEST")]
    assert rules.append_provenance(audit, first, now()).count() == 0
    coverage = mapping.mapping_coverage(mapped).first()
    assert (coverage.terms, coverage.mapped_terms) == (2, 1)


# --- candidates -----------------------------------------------------------------------------


def shortlist(frame, vocabulary, *values):
    rows = candidates.shortlist(terms_of(frame, *values, domain="Measurement"), vocabulary, TODAY).collect()
    return {v: [r.concept_id for r in sorted(rows, key=lambda r: r.position) if r.source_value == v] for v in values}


def test_ecg_abbreviations_rank_first(frame):
    vocabulary = frame(
        CONCEPT,
        *[
            concept(i, name, "Measurement")
            for i, name in [
                (4116636, "ST segment duration"),
                (4116637, "QT interval duration"),
                (3025809, "Q-T interval"),
                (3013078, "R-R interval by EKG"),
            ]
        ],
    )
    got = shortlist(frame, vocabulary, "QT Duration", "RR Duration", "zzz", "%")
    assert got["QT Duration"][0] == 4116637
    assert got["RR Duration"][0] == 3013078
    assert got["zzz"] == got["%"] == []


def brute_shortlist(term, names):
    import re

    def tokens(value):
        joined = re.sub(r"\b([a-zA-Z])[-\s]([a-zA-Z])\b", r"\1\2", value).lower()
        return [t for t in re.findall("[a-z0-9]+", joined) if len(t) > 1 or t.isdigit()]

    def squash(value):
        return re.sub("[^a-z0-9]", "", value.lower())

    generic = {"duration", "level", "measurement", "result", "site", "test", "type"}
    words = tokens(term) or [term.lower()]
    informative = [w for w in words if w not in generic] or words
    primary = max(informative, key=len)
    hits = [n for n in names if any(w in n[1].lower() or w in squash(n[1]) for w in words)]
    hits.sort(key=lambda n: (primary not in squash(n[1]), len(n[1]), n[0]))
    source = set(tokens(term))
    useful = source - generic or source

    def rank(n):
        found = set(tokens(n[1]))
        return (
            len(useful & found) / max(len(useful), 1),
            len(source & found) / max(len(source), 1),
            sort_similarity(term.lower(), n[1].lower()),
            -len(n[1]),
        )

    return [n[0] for n in sorted(hits, key=rank, reverse=True)[:15]], [n[0] for n in hits]


@pytest.mark.parametrize("direct", [0, 2, 1000])
def test_candidates_against_brute_force(frame, monkeypatch, direct):
    """More than 1000 names share one word, and all of them are candidates."""
    monkeypatch.setattr(candidates, "DIRECT", direct)
    rng = random.Random(11)
    stems = ["serum", "blood", "heart", "rate", "level", "q-t", "ab", "5", "pressure", "pulse", "x", "test", "urine"]
    names = []
    for i in range(2600):
        words = [rng.choice(stems) for _ in range(rng.randint(1, 4))]
        if i % 2:
            words.append("common")
        names.append((i + 1, rng.choice([" ", "-", "  "]).join(words) + rng.choice(["", " (n)", str(i % 7)])))
    vocabulary = frame(CONCEPT, *[concept(i, n, "Measurement") for i, n in names])
    terms = ["common", "common pulse", "pulse uncommonly common", "heart common test", "QT ab", "5", "x", "test level", "-", "β"]
    rows = candidates.prefiltered(terms_of(frame, *terms, domain="Measurement"), vocabulary, TODAY).collect()
    final = shortlist(frame, vocabulary, *terms)
    for term in terms:
        best, kept = brute_shortlist(term, names)
        mine = [r.concept_id for r in sorted(rows, key=lambda r: r.place) if r.source_value == term]
        assert mine == kept, term
        assert final[term] == best, term


def test_a_token_in_every_name_adds_few_rows(frame):
    """Names that cannot be among the best of a term are not even paired with it."""
    rng = random.Random(4)
    names = [(i + 1, "common " + " ".join(rng.choice("abcdefgh") * rng.randint(2, 9) for _ in range(3))) for i in range(4000)]
    vocabulary = frame(CONCEPT, *[concept(i, n, "Measurement") for i, n in names])
    texts = ["common", "common " + names[7][1].split()[2], "common level", names[100][1]]
    split = candidates._numbered(terms_of(frame, *texts, domain="Measurement")).withColumn(
        "ordered", candidates.similarity.sorted_words(F.lower("source_value"))
    )
    split = stage(split.withColumn("masks", candidates.similarity.letter_masks(F.col("ordered"))), "terms")
    indexed = candidates._indexed_names(candidates._names_of(split, vocabulary, TODAY))
    postings = indexed.select(
        "domain_id", F.explode("name_tokens").alias("token"), "ordered_length", "concept_id", "name_tokens"
    )
    search = candidates._search_terms(split, postings)
    hits = candidates._searched(search, postings, indexed, split, 15)
    assert search.count() == 4 and search.agg(F.sum("postings")).first()[0] > 16_000
    assert hits.groupBy("term_id").count().agg(F.max("count")).first()[0] < 50 * 15
    final = shortlist(frame, vocabulary, *texts)
    for text in texts:
        assert final[text] == brute_shortlist(text, names)[0], text


def test_no_python_runs_in_retrieval(frame, capsys):
    vocabulary = frame(CONCEPT, concept(1, "Serum glucose", "Measurement"), concept(2, "Blood glucose", "Measurement"))
    found = candidates.shortlist(terms_of(frame, "glucose", domain="Measurement"), vocabulary, TODAY)
    found.explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Window" in plan


def test_picks_must_be_candidates(frame):
    offered = frame(
        "domain_id string, source_value string, concept_id long, concept_name string",
        ("Drug", "a", 5, "five"),
        ("Drug", "b", 6, "six"),
        ("Drug", "c", 7, "seven"),
        ("Drug", "e", 8, "eight"),
    )
    replies = frame(
        "domain_id string, source_value string, reply string",
        ("Drug", "a", "ID: 5."),
        ("Drug", "b", "5"),
        ("Drug", "c", "none"),
        ("Drug", "d", "5"),
        ("Drug", "e", "0"),
    )
    got = {r.source_value: r.concept_id for r in candidates.gate_picks(offered, replies).collect()}
    assert got == {"a": 5, "b": 0, "c": 0, "d": 0, "e": 0}


# --- decisions, reviews, rules --------------------------------------------------------------

PROPOSAL = (
    "run_id string, target_table string, source_value string, proposed_concept_id long, score double, "
    "minimum_score double, model_name string, vocabulary_version string"
)
ACTION = "seq long, mapping_decision_id long, action string, reviewer string, reason string, selected_concept_id long"


def proposal(value, concept_id=320128, score=0.75, minimum=0.0, run="RUN-1", table="condition_occurrence"):
    return (run, table, value, concept_id, score, minimum, "test-model", "test-vocab")


@pytest.fixture
def store(spark):
    return {name: rules.empty(spark, name) for name in rules.SCHEMAS}


@pytest.fixture
def vocabulary(frame):
    return frame(CONCEPT, concept(320128, "Essential hypertension"), concept(4223659, "Fatigue", "Observation"))


def record(frame, store, *proposals):
    new = rules.record_decisions(frame(PROPOSAL, *proposals), store["decision"], store["rejected"], now())
    store["decision"] = stage(store["decision"].unionByName(new), "decision")
    return {r.source_value: r for r in new.collect()}


def act(frame, store, vocabulary, *actions):
    batch = [(i, *a) if len(a) == 5 else (i, *a, None) for i, a in enumerate(actions)]
    reviewed = stage(rules.review(frame(ACTION, *batch), store["decision"], vocabulary), "reviewed")
    store["decision"] = stage(rules.reviewed_decisions(store["decision"], reviewed, now()), "decision")
    yes, no = rules.apply_reviews(reviewed, store["approved"], store["rejected"], now())
    store["approved"], store["rejected"] = stage(yes, "approved"), stage(no, "rejected")
    return {r.seq: r for r in reviewed.collect()}


def test_review_gate(frame, store, vocabulary):
    first = record(frame, store, proposal("Hypertension"))["Hypertension"]
    assert (first.decision_status, first.mapping_decision_id) == ("PROPOSED", 1)
    got = act(frame, store, vocabulary, (1, "approve", "QC", "wrong domain", 4223659))
    assert got[0].refusal == "concept of another domain" and store["approved"].count() == 0
    got = act(frame, store, vocabulary, (1, "reject", "QC Reviewer", "too specific"))
    assert got[0].new_status == "REJECTED"

    policy = record(frame, store, proposal(" HYPERTENSION", run="RUN-2"))[" HYPERTENSION"]
    assert (policy.decision_status, policy.reviewed_by) == ("REJECTED_BY_POLICY", "QC Reviewer")
    got = act(frame, store, vocabulary, (2, "approve", "Senior", "reconsidered"))
    assert got[0].concept_name == "Essential hypertension"
    assert store["rejected"].first().active is False
    approved = store["approved"].first()
    assert (approved.active, approved.concept_id, approved.normalized_value) == (True, 320128, "hypertension")
    assert store["decision"].where("mapping_decision_id = 2").first().selected_concept_id == 320128


def test_refusals(frame, store, vocabulary):
    record(frame, store, proposal("A"), proposal("B", 0), proposal("C", 999))
    got = act(
        frame,
        store,
        vocabulary,
        (1, "hold", "QC", "x"),
        (1, "approve", " ", "x"),
        (1, "approve", "QC", None),
        (77, "approve", "QC", "x"),
        (2, "approve", "QC", "x"),
        (3, "approve", "QC", "x"),
        (1, "approve", "QC", "x"),
        (1, "reject", "QC", "x"),
    )
    assert [got[i].refusal for i in range(8)] == [
        "neither an approval nor a rejection",
        "no reviewer or no reason",
        "no reviewer or no reason",
        "no such decision",
        "nothing to approve: no concept",
        "concept is not in the vocabulary",
        None,
        "settled before: APPROVED",
    ]
    again = act(frame, store, vocabulary, (1, "reject", "QC", "x"))
    assert again[0].refusal == "settled before: APPROVED"


def test_thresholds_conflicts_and_repeats(frame, store):
    got = record(frame, store, proposal("low", score=0.45, minimum=0.9), proposal("none", 0), proposal("fine"))
    assert {k: r.decision_status for k, r in got.items()} == {
        "low": "LOW_CONFIDENCE",
        "none": "UNRESOLVED",
        "fine": "PROPOSED",
    }
    assert record(frame, store, proposal("FINE"), proposal("more"))["more"].mapping_decision_id == 4
    with pytest.raises(ValueError, match="Two concepts are proposed"):
        record(frame, store, proposal("fine", 5))
    with pytest.raises(ValueError, match="cannot be made for visit"):
        record(frame, store, proposal("x", table="visit"))


def test_approved_rules_apply_once(frame, store, vocabulary):
    record(frame, store, proposal("Hypertension"))
    act(frame, store, vocabulary, (1, "approve", "QC Reviewer", "checked"))
    tables = {
        "condition_occurrence": frame(CONDITION, (1, " HYPERTENSION", 0), (2, "Fatigue", 0), (3, "Hypertension", 9)),
        "drug_exposure": frame("drug_exposure_id long, drug_source_value string, drug_concept_id long", (1, "Hypertension", 0)),
    }
    done, audit = mapping.apply_approved_tables(tables, store["approved"], store["decision"], vocabulary, "RUN-APPLY")
    got = {r.condition_occurrence_id: r.condition_concept_id for r in done["condition_occurrence"].collect()}
    assert got == {1: 320128, 2: 0, 3: 9} and done["drug_exposure"].first().drug_concept_id == 0
    rows = audit.collect()
    assert [(r.target_id, r.assigned_concept_id, r.reviewed_by, r.mapping_decision_id) for r in rows] == [
        (1, 320128, "QC Reviewer", 1)
    ]
    _, nothing = mapping.apply_approved_tables(done, store["approved"], store["decision"], vocabulary, "RUN-APPLY")
    assert nothing.count() == 0
    gone = vocabulary.where("concept_id <> 320128")
    with pytest.raises(ValueError, match="concept 320128 is not in the vocabulary"):
        mapping.apply_approved_tables(tables, store["approved"], store["decision"], gone, "RUN-APPLY")


def test_rules_in_force_and_listings(frame, store, vocabulary):
    record(frame, store, proposal("Hypertension"), proposal("Fatigue", score=0.5))
    ids = {r.source_value: r.mapping_decision_id for r in store["decision"].collect()}
    act(frame, store, vocabulary, (ids["Hypertension"], "approve", "QC", "fits"), (ids["Fatigue"], "reject", "QC", "no"))
    asked = frame("target_table string, source_value string", *[("condition_occurrence", v) for v in (" hyperTENSION", "fatigue  ", "new")])
    got = {r.source_value: (r.rule_status, r.rule_by) for r in rules.active_rules(asked, store["approved"], store["rejected"]).collect()}
    assert got == {" hyperTENSION": ("APPROVED", "QC"), "fatigue  ": ("REJECTED", "QC"), "new": (None, None)}
    listed = rules.list_approved(store["approved"], vocabulary).collect()
    assert [(r.source_value, r.concept_id, r.concept_name) for r in listed] == [("Hypertension", 320128, "Essential hypertension")]
    assert [r.source_value for r in rules.list_rejected(store["rejected"]).collect()] == ["Fatigue"]
    events = frame("mapping_decision_id long, target_id long", (ids["Fatigue"], 4), (ids["Fatigue"], 5))
    counted = {r.source_value: r.affected_events for r in rules.list_decisions(store["decision"], events, vocabulary, "RUN-1").collect()}
    assert counted == {"Hypertension": 0, "Fatigue": 2}


def test_event_links_are_added_once(frame, store):
    record(frame, store, proposal("Hypertension"))
    affected = frame(
        "run_id string, target_table string, mapping_method string, source_value string, target_id long",
        *[("RUN-1", "condition_occurrence", rules.PROPOSAL_METHOD, "hypertension ", i) for i in (10, 11, 11)],
    )
    first = rules.decision_events(affected, store["decision"], store["decision_event"])
    assert {(r.mapping_decision_id, r.target_id) for r in first.collect()} == {(1, 10), (1, 11)}
    assert rules.decision_events(affected, store["decision"], first).count() == 0


def test_proposals_skip_rules_and_leave_rows_alone(frame, store, vocabulary):
    names = frame(CONCEPT, concept(1, "Chest pain"), concept(2, "Chest wall pain"), concept(3, "Cough"))
    record(frame, store, proposal("Approved term", 3), proposal("Refused term", 3))
    act(frame, store, names, (1, "approve", "QC", "fits"), (2, "reject", "QC", "no"))
    df = frame(CONDITION, *[(i, v, 0) for i, v in enumerate(["chest pain", "pain in chest", "approved TERM", "Refused term", "other"])], (9, "done", 5))
    replies = frame(
        "domain_id string, source_value string, reply string",
        ("Condition", "chest pain", "1"),
        ("Condition", "pain in chest", "ID 3"),
        ("Condition", "Refused term", "3"),
    )
    got = rules.propose(df, "condition_occurrence", names, replies, store["approved"], store["rejected"], "RUN-2", "m", 0.9, as_of=TODAY)
    rows = {r.source_value: (r.proposed_concept_id, r.score) for r in got.collect()}
    assert rows == {"chest pain": (1, 1.0), "pain in chest": (0, 0.0), "Refused term": (0, 0.0), "other": (0, 0.0)}
    new = rules.record_decisions(got, store["decision"], store["rejected"], now())
    assert {r.source_value: r.decision_status for r in new.collect()} == {
        "chest pain": "PROPOSED",
        "pain in chest": "UNRESOLVED",
        "Refused term": "REJECTED_BY_POLICY",
        "other": "UNRESOLVED",
    }
    tally = {r.decision_status: r.decisions for r in rules.proposal_tally(new).collect()}
    assert tally == {"PROPOSED": 1, "UNRESOLVED": 2, "REJECTED_BY_POLICY": 1}


def test_manual_proposals(frame):
    df = frame(CONDITION, (1, "Cough", 0), (2, "Cough", 8), (3, "cough", 0))
    requests = frame("target_table string, source_value string, concept_id long", *[("condition_occurrence", v, c) for v, c in (("Cough", 5), ("cough", 0), ("Sneeze", 5))])
    proposed, events, refused = rules.manual_proposals(requests, {"condition_occurrence": df}, "RUN-1")
    assert {(r.source_value, r.proposed_concept_id, r.score, r.mapping_method) for r in proposed.collect()} == {
        ("Cough", 5, 1.0, rules.MANUAL_METHOD),
        ("cough", 0, 0.0, rules.MANUAL_METHOD),
    }
    assert {(r.source_value, r.target_id) for r in events.collect()} == {("Cough", 1), ("Cough", 2), ("cough", 3)}
    assert [r.source_value for r in refused.collect()] == ["Sneeze"]


def test_old_provenance_gets_new_columns(frame, store):
    old = frame(
        "provenance_id long, target_table string, target_id long, source_value string, normalized_value string, "
        "assigned_concept_id long, mapping_method string, score double, model_name string, vocabulary_version string, "
        "reviewed_by string, created_at timestamp_ntz",
        *[(i, "condition_occurrence", 1, "old", "old", 0, "old_method", 0.0, None, None, rules.PENDING, None) for i in (1, 2)],
    )
    evolved = rules.evolve_provenance(old)
    assert evolved.columns == store["provenance"].columns and evolved.where("run_id is null").count() == 2
    pending = evolved.withColumn("run_id", F.lit("R"))
    proposals, events = rules.import_pending(pending, "R")
    assert [(r.source_value, r.proposed_concept_id, r.prompt_version) for r in proposals.collect()] == [
        ("old", 0, rules.IMPORT_PROMPT)
    ]
    assert events.count() == 2


def test_latest_run(frame):
    runs = frame("run_id string, started_at timestamp", ("a", dt.datetime(2024, 1, 1)), ("b", dt.datetime(2024, 1, 2)))
    assert rules.latest_run(runs).first().run_id == "b"

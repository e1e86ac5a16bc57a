"""Proposals, reviews and rules: keyed appends and merges on DataFrames.

Tables (all columns in ``SCHEMAS``):

* ``decision``  one proposal per (run, table, normalized term, method)
* ``decision_event``  the events a decision concerns
* ``approved`` / ``rejected``  the rule in force per (table, normalized term)
* ``provenance``  one row per event whose concept was set

No function updates in place: each returns the rows to append, or the new state
of a rule table, for the caller to write as the next snapshot.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from clinspark.functions import text
from clinspark.functions.numbers import lenient_id
from clinspark.functions.similarity import confidence
from clinspark.operators.candidates import gate_picks, shortlist
from clinspark.operators.checks import count_if
from clinspark.operators.ids import next_id, with_dense_ids
from clinspark.operators.mapping import DEFAULT_VERSION, DOMAIN_OF, TARGETS, expected_domain, is_standard, orphan_terms
from clinspark.session import stage

SCHEMAS = {
    "decision": (
        "mapping_decision_id long, run_id string, target_table string, source_value string, "
        "normalized_value string, proposed_concept_id long, selected_concept_id long, mapping_method string, "
        "score double, model_name string, vocabulary_version string, prompt_version string, "
        "decision_status string, reviewed_by string, reviewed_at timestamp_ntz, review_reason string, "
        "created_at timestamp_ntz"
    ),
    "decision_event": "mapping_decision_id long, target_id long",
    "approved": (
        "target_table string, source_value string, normalized_value string, concept_id long, "
        "source_decision_id long, approved_by string, approval_reason string, approved_at timestamp_ntz, "
        "active boolean, updated_at timestamp_ntz"
    ),
    "rejected": (
        "target_table string, source_value string, normalized_value string, source_decision_id long, "
        "rejected_by string, rejection_reason string, rejected_at timestamp_ntz, active boolean, "
        "updated_at timestamp_ntz"
    ),
    "provenance": (
        "provenance_id long, target_table string, target_id long, source_value string, normalized_value string, "
        "assigned_concept_id long, mapping_method string, score double, model_name string, "
        "vocabulary_version string, reviewed_by string, created_at timestamp_ntz, run_id string, "
        "mapping_decision_id long"
    ),
}

RULE_KEY = ["target_table", "normalized_value"]
DECISION_KEY = ["run_id", "target_table", "normalized_value", "mapping_method"]
PROVENANCE_KEY = ["run_id", "target_table", "target_id", "mapping_method"]

# Methods, prompt versions and labels.
PROPOSAL_METHOD = "llm_zero_shot"
PROPOSAL_PROMPT = "candidate-selection-v1"
MANUAL_METHOD = "manual_vocabulary_review"
MANUAL_PROMPT = "human-vocabulary-review-v1"
MANUAL_MODEL = "Human_Vocabulary_Review"
IMPORT_PROMPT = "legacy-event-provenance-v1"
PENDING = "Pending_Human_Review"


def empty(spark, table: str) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS[table])


# --- keyed appends --------------------------------------------------------------------------


def new_rows(candidates: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key is not there yet, one per key (the lowest row wins).

    A null in the key never equals another one, so such rows are always new.
    """
    # In one pass, so that whatever made the candidates runs once: incomplete rows are groups of their own.
    apart = F.when(reduce(Column.__or__, [F.col(name).isNull() for name in key]), F.monotonically_increasing_id())
    others = [name for name in candidates.columns if name not in key]
    keyed = candidates.withColumn("_apart", apart)
    first = keyed.groupBy(*key, "_apart").agg(F.min(F.struct(*others)).alias("row")) if others else keyed.distinct()
    once = first.select(*key, "row.*") if others else first.drop("_apart")
    return once.join(existing.select(*key), key, "left_anti").select(*candidates.columns)


def append_provenance(
    rows: DataFrame, existing: DataFrame, created_at: Column, first_id: int | None = None
) -> DataFrame:
    """Provenance rows to append; events already audited by this run and method are skipped.

    The run is part of the key, so ``existing`` may be cut to the runs in ``rows`` if ``first_id``
    (the first free id of the whole table) is given.
    """
    fresh = new_rows(rows, existing, PROVENANCE_KEY).withColumn("created_at", created_at.cast("timestamp_ntz"))
    first_id = next_id(existing, "provenance_id") if first_id is None else first_id
    numbered = with_dense_ids(fresh, "provenance_id", ["target_table", "target_id", "mapping_method"], first_id)
    return numbered.select(*empty(rows.sparkSession, "provenance").columns)


def evolve_provenance(old: DataFrame) -> DataFrame:
    """Provenance written before runs and decisions were recorded, in today's columns."""
    return empty(old.sparkSession, "provenance").unionByName(old, allowMissingColumns=True)


# --- proposals ------------------------------------------------------------------------------


def decision_status(score: Column, concept_id: Column, minimum_score: Column, rejected: Column) -> Column:
    return (
        F.when(rejected, "REJECTED_BY_POLICY")
        .when(concept_id == 0, "UNRESOLVED")
        .when(score < minimum_score, "LOW_CONFIDENCE")
        .otherwise("PROPOSED")
    )


def with_status(proposals: DataFrame, rejected: DataFrame) -> DataFrame:
    """Add status and, for a term with an active rejection, that rejection's reviewer, time and reason."""
    active = rejected.where("active").select(
        *RULE_KEY,
        F.col("rejected_by").alias("reviewed_by"),
        F.col("rejected_at").alias("reviewed_at"),
        F.col("rejection_reason").alias("review_reason"),
    )
    status = decision_status(
        F.col("score"), F.col("proposed_concept_id"), F.col("minimum_score"), F.col("reviewed_by").isNotNull()
    )
    return proposals.join(active, RULE_KEY, "left").withColumn("decision_status", status)


def _normalized(proposals: DataFrame) -> DataFrame:
    defaults = {
        "mapping_method": F.lit(PROPOSAL_METHOD),
        "prompt_version": F.lit(PROPOSAL_PROMPT),
        "minimum_score": F.lit(0.0),
    }
    for name, value in defaults.items():
        if name not in proposals.columns:
            proposals = proposals.withColumn(name, value)
    return proposals.withColumn("normalized_value", text.normalized_key(F.col("source_value"))).withColumn(
        "proposed_concept_id", F.coalesce(F.col("proposed_concept_id").cast("bigint"), F.lit(0).cast("bigint"))
    )


def proposal_conflicts(proposals: DataFrame, decisions: DataFrame) -> DataFrame:
    """Keys for which different concepts are proposed, now or earlier."""
    return _conflicts(_normalized(proposals), decisions)


def _conflicts(normalized: DataFrame, decisions: DataFrame) -> DataFrame:
    mine = normalized.select(*DECISION_KEY, "proposed_concept_id")
    keys = mine.select(*DECISION_KEY).distinct()
    earlier = decisions.select(*DECISION_KEY, "proposed_concept_id").join(keys, DECISION_KEY, "left_semi")
    return (
        mine.unionByName(earlier)
        .groupBy(*DECISION_KEY)
        .agg(F.min("proposed_concept_id").alias("lowest"), F.max("proposed_concept_id").alias("highest"))
        .where("lowest <> highest")
    )


def unsupported_tables(proposals: DataFrame) -> DataFrame:
    return proposals.where(~F.col("target_table").isin(list(DOMAIN_OF))).select("target_table").distinct()


def record_decisions(
    proposals: DataFrame,
    decisions: DataFrame,
    rejected: DataFrame,
    created_at: Column,
    check: bool = True,
    first_id: int | None = None,
) -> DataFrame:
    """Decisions to append for the proposals; a key recorded before is left alone.

    The proposals are grouped by key once: each group gives its lowest row and the range of its
    concepts, and one join with the recorded decisions tells which keys are new and which
    concepts differ.  That result is staged, and what is to be checked is counted while it is written, so
    whatever made the proposals (candidate retrieval, for one) runs once.  ``first_id`` is the first
    free id, if the caller knows it; else the recorded ids are read for it.
    """
    normalized = _normalized(proposals)
    # What the lowest row of a key is found by.
    others = [
        "source_value", "proposed_concept_id", "score", "model_name", "vocabulary_version", "prompt_version", "minimum_score"
    ]
    complete = F.lit(True)
    for name in DECISION_KEY:
        complete = complete & F.col(name).isNotNull()
    # A null in the key never equals another one: such rows are groups of their own.
    apart = F.when(~complete, F.monotonically_increasing_id())
    grouped = (
        normalized.withColumns({"score": F.col("score").cast("double"), "_apart": apart})
        .groupBy(*DECISION_KEY, "_apart")
        .agg(
            F.min(F.struct(*others)).alias("row"),
            F.min("proposed_concept_id").alias("_lowest"),
            F.max("proposed_concept_id").alias("_highest"),
        )
        .select(*DECISION_KEY, "_lowest", "_highest", "row.*")
    )
    earlier = (
        decisions.select(*DECISION_KEY, "proposed_concept_id")
        .groupBy(*DECISION_KEY)
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.min("proposed_concept_id").alias("_first"),
            F.max("proposed_concept_id").alias("_last"),
        )
    )
    lowest, highest = F.least("_lowest", "_first"), F.greatest("_highest", "_last")
    checked = Observation("proposals")
    judged = stage(
        grouped.join(earlier, DECISION_KEY, "left")
        .withColumn("_known", F.col("_rows").isNotNull())
        .observe(
            checked,
            count_if(lowest < highest, "conflicts"),
            F.max(F.when(~F.col("target_table").isin(list(DOMAIN_OF)), F.col("target_table"))).alias("unsupported"),
        )
        .drop("_lowest", "_highest", "_first", "_last", "_rows"),
        "proposals",
    )
    if check:
        if checked.get["unsupported"]:
            raise ValueError(f"Proposals cannot be made for {checked.get['unsupported']}")
        if checked.get["conflicts"]:
            raise ValueError("Two concepts are proposed for one term of a run; proposal_conflicts lists them.")
    rows = with_status(judged.where("not _known").drop("_known"), rejected).select(
        *DECISION_KEY,
        "source_value",
        "proposed_concept_id",
        F.lit(None).cast("bigint").alias("selected_concept_id"),
        "score",
        "model_name",
        "vocabulary_version",
        "prompt_version",
        "decision_status",
        "reviewed_by",
        "reviewed_at",
        "review_reason",
    )
    fresh = rows.withColumn("created_at", created_at.cast("timestamp_ntz"))
    first = next_id(decisions, "mapping_decision_id") if first_id is None else first_id
    numbered = with_dense_ids(fresh, "mapping_decision_id", DECISION_KEY, first)
    return numbered.select(*empty(proposals.sparkSession, "decision").columns)


def decision_events(affected: DataFrame, decisions: DataFrame, existing: DataFrame) -> DataFrame:
    """Event links to append.  ``affected``: the decision key, plus source_value and target_id, one row per event.

    ``normalized_value`` may be absent; a caller that knows the distinct terms brings it along.
    """
    keyed = affected
    if "normalized_value" not in affected.columns:
        keyed = affected.withColumn("normalized_value", text.normalized_key(F.col("source_value")))
    links = keyed.join(decisions.select(*DECISION_KEY, "mapping_decision_id"), DECISION_KEY).select(
        "mapping_decision_id", "target_id"
    )
    return new_rows(links, existing, ["mapping_decision_id", "target_id"])


def affected_events(df: DataFrame, target_table: str, terms: DataFrame | None = None) -> DataFrame:
    """Unmapped events of a table by raw term: (target_table, source_value, target_id)."""
    target = TARGETS[target_table]
    unmapped = lenient_id(df, target.concept_col) == 0  # null counts as 0, as in orphan_terms
    rows = df.where(unmapped & F.col(target.source_col).isNotNull()).select(
        F.lit(target_table).alias("target_table"),
        F.col(target.source_col).alias("source_value"),
        F.col(target.id_col).cast("bigint").alias("target_id"),
    )
    return rows if terms is None else rows.join(terms.select("source_value").distinct(), "source_value", "left_semi")


def active_rules(terms: DataFrame, approved: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rule in force for each (target_table, source_value); an approval outranks a rejection."""
    yes = approved.where("active").select(
        *RULE_KEY, F.col("concept_id").alias("rule_concept_id"), "approved_by", "approval_reason"
    )
    no = rejected.where("active").select(*RULE_KEY, "rejected_by", "rejection_reason")
    keyed = terms.withColumn("normalized_value", text.normalized_key(F.col("source_value")))
    is_approved, is_rejected = F.col("rule_concept_id").isNotNull(), F.col("rejected_by").isNotNull()
    return (
        keyed.join(yes, RULE_KEY, "left")
        .join(no, RULE_KEY, "left")
        .withColumn("rule_status", F.when(is_approved, "APPROVED").when(is_rejected, "REJECTED"))
        .withColumn("rule_by", F.when(is_approved, F.col("approved_by")).otherwise(F.col("rejected_by")))
        .withColumn("rule_reason", F.when(is_approved, F.col("approval_reason")).otherwise(F.col("rejection_reason")))
        .drop("approved_by", "approval_reason", "rejected_by", "rejection_reason")
    )


def propose(
    df: DataFrame,
    target_table: str,
    concept: DataFrame,
    replies: DataFrame,
    approved: DataFrame,
    rejected: DataFrame,
    run_id: str,
    model_name: str,
    minimum_score: float = 0.9,
    vocabulary_version: str = DEFAULT_VERSION,
    as_of=None,
) -> DataFrame:
    """One proposal per unmapped term without an approval; clinical rows are not touched.

    Terms with an active rejection are recorded against that policy without any
    retrieval.  For the others the external pick in ``replies`` (domain_id,
    source_value, reply) counts only if it is one of the term's candidates.
    """
    terms = stage(active_rules(orphan_terms(df, TARGETS[target_table]), approved, rejected), "open-terms")
    open_terms = terms.where("rule_status is null").select("target_table", "domain_id", "source_value")
    policy = terms.where("rule_status = 'REJECTED'").select(
        "target_table", "source_value", F.lit(0).cast("bigint").alias("proposed_concept_id"), F.lit(0.0).alias("score")
    )
    # Staged: the gate reads it twice, and retrieval should run once.
    offered = stage(shortlist(open_terms, concept, as_of), "shortlist")
    picks = gate_picks(offered, replies.join(open_terms, ["domain_id", "source_value"], "left_semi"))
    scored = (
        open_terms.join(picks, ["domain_id", "source_value"], "left")
        .withColumn("proposed_concept_id", F.coalesce("concept_id", F.lit(0).cast("bigint")))
        .select(
            "target_table",
            "source_value",
            "proposed_concept_id",
            F.when(F.col("proposed_concept_id") == 0, F.lit(0.0))
            .otherwise(confidence(F.col("source_value"), F.col("concept_name")))
            .alias("score"),
        )
    )
    return scored.unionByName(policy).select(
        F.lit(run_id).alias("run_id"),
        "*",
        F.lit(model_name).alias("model_name"),
        F.lit(vocabulary_version).alias("vocabulary_version"),
        F.lit(PROPOSAL_METHOD).alias("mapping_method"),
        F.lit(PROPOSAL_PROMPT).alias("prompt_version"),
        F.lit(float(minimum_score)).alias("minimum_score"),
    )


def proposal_tally(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("target_table", "decision_status").agg(F.count(F.lit(1)).alias("decisions"))


def manual_proposals(
    requests: DataFrame,
    tables: dict[str, DataFrame],
    run_id: str,
    vocabulary_version: str = DEFAULT_VERSION,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Proposals a person asks for by raw source value: (proposals, affected events, refused).

    ``requests``: (target_table, source_value, concept_id).  A request for a
    value no event has is refused.
    """
    events = None
    for name, df in tables.items():
        target = TARGETS[name]
        rows = df.where(F.col(target.source_col).isNotNull()).select(
            F.lit(name).alias("target_table"),
            F.col(target.source_col).alias("source_value"),
            F.col(target.id_col).cast("bigint").alias("target_id"),
        )
        events = rows if events is None else events.unionByName(rows)
    key = ["target_table", "source_value"]
    hits = events.join(requests.select(*key).distinct(), key, "left_semi")
    known = hits.select(*key).distinct()
    labels = [F.lit(run_id).alias("run_id"), F.lit(MANUAL_METHOD).alias("mapping_method")]
    proposals = requests.join(known, key, "left_semi").select(
        *labels,
        *key,
        F.col("concept_id").cast("bigint").alias("proposed_concept_id"),
        F.when(F.coalesce("concept_id", F.lit(0)) != 0, 1.0).otherwise(0.0).alias("score"),
        F.lit(MANUAL_MODEL).alias("model_name"),
        F.lit(vocabulary_version).alias("vocabulary_version"),
        F.lit(MANUAL_PROMPT).alias("prompt_version"),
        F.lit(0.0).alias("minimum_score"),
    )
    return proposals, hits.select(*labels, *key, "target_id"), requests.join(known, key, "left_anti")


def pending_provenance(provenance: DataFrame, run_id: str) -> DataFrame:
    return provenance.where((F.col("run_id") == run_id) & (F.col("reviewed_by") == PENDING))


def import_pending(provenance: DataFrame, run_id: str) -> tuple[DataFrame, DataFrame]:
    """Pending event-level provenance of a run as (proposals, affected events)."""
    pending = pending_provenance(provenance, run_id)
    proposals = (
        pending.select(
            "target_table",
            "source_value",
            F.col("assigned_concept_id").alias("proposed_concept_id"),
            "score",
            "model_name",
            "vocabulary_version",
            "mapping_method",
        )
        .distinct()
        .withColumn("run_id", F.lit(run_id))
        .withColumn("prompt_version", F.lit(IMPORT_PROMPT))
        .withColumn("minimum_score", F.lit(0.0))
    )
    return proposals, pending.select("run_id", "target_table", "source_value", "mapping_method", "target_id")


# --- review ---------------------------------------------------------------------------------


def review(actions: DataFrame, decisions: DataFrame, concept: DataFrame) -> DataFrame:
    """Judge a batch of review actions.

    ``actions``: (seq, mapping_decision_id, action, reviewer, reason,
    selected_concept_id), taken in ``seq`` order.  Adds the decision's key, the
    concept an approval would set, the new status, and ``refusal`` (null when
    the action is accepted).
    """
    subject = decisions.select(
        "mapping_decision_id",
        "target_table",
        "source_value",
        "normalized_value",
        "proposed_concept_id",
        "decision_status",
    )
    verb = F.upper("action")
    wanted = F.coalesce(
        F.when(F.col("selected_concept_id") != 0, F.col("selected_concept_id")), F.col("proposed_concept_id")
    )
    facts = concept.select(
        F.col("concept_id").cast("bigint").alias("concept_id"),
        "concept_name",
        "domain_id",
        "standard_concept",
        "invalid_reason",
    )
    rows = (
        actions.join(subject, "mapping_decision_id", "left")
        .withColumn("concept_id", F.when(verb == "APPROVE", F.coalesce(wanted, F.lit(0)).cast("bigint")))
        .join(facts, "concept_id", "left")
    )
    blank = F.coalesce(text.blank_to_null(F.col("reviewer")), F.lit("")) == ""
    blank = blank | (F.coalesce(text.blank_to_null(F.col("reason")), F.lit("")) == "")
    approving = verb == "APPROVE"
    early = (
        F.when(~F.coalesce(verb.isin("APPROVE", "REJECT"), F.lit(False)), "neither an approval nor a rejection")
        .when(blank, "no reviewer or no reason")
        .when(F.col("decision_status").isNull(), "no such decision")
        .when(F.col("decision_status").isin("APPROVED", "REJECTED"), F.concat(F.lit("settled before: "), "decision_status"))
    )
    late = (
        F.when(approving & (F.col("concept_id") == 0), "nothing to approve: no concept")
        .when(approving & F.col("concept_name").isNull(), "concept is not in the vocabulary")
        .when(approving & ~F.coalesce(is_standard(), F.lit(False)), "concept is not standard")
        .when(approving & ~F.coalesce(F.col("domain_id") == expected_domain(), F.lit(False)), "concept of another domain")
    )
    judged = rows.withColumn("_early", early).withColumn("_late", late)
    judged = judged.withColumn("new_status", F.when(approving, "APPROVED").otherwise("REJECTED"))
    # The first acceptable action of a decision settles it; later ones find it settled.
    settled = (
        judged.where("_early is null and _late is null")
        .groupBy("mapping_decision_id")
        .agg(F.min(F.struct("seq", "new_status")).alias("_by"))
    )
    taken = F.col("_by").isNotNull() & (F.col("seq") > F.col("_by.seq"))
    refusal = F.coalesce("_early", F.when(taken, F.concat(F.lit("settled before: "), "_by.new_status")), "_late")
    return judged.join(settled, "mapping_decision_id", "left").select(
        "seq",
        "mapping_decision_id",
        verb.alias("action"),
        "reviewer",
        "reason",
        *["target_table", "source_value", "normalized_value", "concept_id", "concept_name"],
        F.when(refusal.isNull(), F.col("new_status")).alias("new_status"),
        refusal.alias("refusal"),
    )


def accepted(reviewed: DataFrame) -> DataFrame:
    return reviewed.where("refusal is null")


def reviewed_decisions(decisions: DataFrame, reviewed: DataFrame, reviewed_at: Column) -> DataFrame:
    """The decision table after the accepted actions."""
    done = accepted(reviewed).select(
        "mapping_decision_id",
        F.col("new_status").alias("_status"),
        F.col("concept_id").alias("_concept"),
        F.col("reviewer").alias("_reviewer"),
        F.col("reason").alias("_reason"),
    )
    changed = F.col("_status").isNotNull()
    values = {
        "decision_status": F.col("_status"),
        "selected_concept_id": F.col("_concept"),
        "reviewed_by": F.col("_reviewer"),
        "reviewed_at": reviewed_at.cast("timestamp_ntz"),
        "review_reason": F.col("_reason"),
    }
    return decisions.join(done, "mapping_decision_id", "left").select(
        *[
            F.when(changed, values[name]).otherwise(F.col(name)).alias(name) if name in values else F.col(name)
            for name in decisions.columns
        ]
    )


def _merge(rules: DataFrame, changes: DataFrame, columns: list[str]) -> DataFrame:
    """Upsert by rule key.  ``changes`` may carry a row (new content) or only the new ``active`` flag."""
    old = rules.select(*RULE_KEY, F.struct(*[c for c in columns if c not in RULE_KEY]).alias("old"))
    merged = old.join(changes, RULE_KEY, "full_outer").where("old is not null or row is not null")
    touched = F.col("now_active").isNotNull()
    parts = []
    for name in columns:
        if name in RULE_KEY:
            parts.append(F.col(name))
        elif name == "active":
            parts.append(F.coalesce("now_active", "old.active").alias(name))
        elif name == "updated_at":
            parts.append(F.when(touched, F.col("changed_at")).otherwise(F.col("old.updated_at")).alias(name))
        else:
            parts.append(F.when(F.col("row").isNotNull(), F.col(f"row.{name}")).otherwise(F.col(f"old.{name}")).alias(name))
    return merged.select(*parts)


def apply_reviews(
    reviewed: DataFrame, approved: DataFrame, rejected: DataFrame, reviewed_at: Column
) -> tuple[DataFrame, DataFrame]:
    """Both rule tables after the accepted actions, taken in ``seq`` order.

    The last approval of a key is its approved row and the last rejection its
    rejected row; whichever came last is active and switches the other one off.
    """
    moment = reviewed_at.cast("timestamp_ntz")
    approving = F.col("action") == "APPROVE"
    yes = F.struct(
        "seq",
        F.col("source_value"),
        F.col("concept_id"),
        F.col("mapping_decision_id").alias("source_decision_id"),
        F.col("reviewer").alias("approved_by"),
        F.col("reason").alias("approval_reason"),
        moment.alias("approved_at"),
    )
    no = F.struct(
        "seq",
        F.col("source_value"),
        F.col("mapping_decision_id").alias("source_decision_id"),
        F.col("reviewer").alias("rejected_by"),
        F.col("reason").alias("rejection_reason"),
        moment.alias("rejected_at"),
    )
    by_key = (
        accepted(reviewed)
        .groupBy(*RULE_KEY)
        .agg(
            F.max(F.when(approving, yes)).alias("yes"),
            F.max(F.when(~approving, no)).alias("no"),
            F.max(F.struct("seq", approving.alias("approve"))).alias("last"),
        )
        .withColumn("changed_at", moment)
    )
    kept = F.col("last.approve")
    to_approved = by_key.select(*RULE_KEY, F.col("yes").alias("row"), kept.alias("now_active"), "changed_at")
    to_rejected = by_key.select(*RULE_KEY, F.col("no").alias("row"), (~kept).alias("now_active"), "changed_at")
    return (
        _merge(approved, to_approved, approved.columns),
        _merge(rejected, to_rejected, rejected.columns),
    )


# --- listings -------------------------------------------------------------------------------


def latest_run(runs: DataFrame) -> DataFrame:
    """The run that started last, as one row."""
    return runs.orderBy(F.desc("started_at"), F.desc("run_id")).limit(1).select("run_id", "started_at")


def list_decisions(decisions: DataFrame, events: DataFrame, concept: DataFrame, run_id: str) -> DataFrame:
    """Decisions of a run with concept names and the number of events, by table and term."""
    mine = decisions.where(F.col("run_id") == run_id)
    counts = (
        events.join(mine.select("mapping_decision_id"), "mapping_decision_id", "left_semi")
        .groupBy("mapping_decision_id")
        .agg(F.count("target_id").alias("affected_events"))
    )
    names = concept.select(F.col("concept_id").cast("bigint").alias("_id"), F.col("concept_name").alias("_name"))
    proposed = names.withColumnRenamed("_name", "proposed_name")
    selected = names.withColumnRenamed("_name", "selected_name")
    return (
        mine.join(proposed, F.col("proposed_concept_id") == F.col("_id"), "left")
        .drop("_id")
        .join(selected, F.col("selected_concept_id") == F.col("_id"), "left")
        .join(counts, "mapping_decision_id", "left")
        .select(
            "mapping_decision_id",
            "target_table",
            "source_value",
            "proposed_concept_id",
            "proposed_name",
            "selected_concept_id",
            "selected_name",
            "score",
            "decision_status",
            "reviewed_by",
            F.coalesce("affected_events", F.lit(0)).cast("bigint").alias("affected_events"),
        )
        .orderBy("target_table", "source_value", "mapping_decision_id")
    )


def list_approved(approved: DataFrame, concept: DataFrame) -> DataFrame:
    names = concept.select(F.col("concept_id").cast("bigint").alias("concept_id"), "concept_name")
    return (
        approved.where("active")
        .join(names, "concept_id", "left")
        .select(
            "target_table",
            "source_value",
            "concept_id",
            "concept_name",
            "approved_by",
            "approved_at",
            "source_decision_id",
        )
        .orderBy("target_table", "source_value")
    )


def list_rejected(rejected: DataFrame) -> DataFrame:
    return (
        rejected.where("active")
        .select("target_table", "source_value", "rejected_by", "rejected_at", "source_decision_id")
        .orderBy("target_table", "source_value")
    )

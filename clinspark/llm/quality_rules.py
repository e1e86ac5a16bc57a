"""Text quality by a sparse ensemble of rules.

Each text becomes a row of statistics (column expressions over the whole text).  Trees of a
small forest are fitted on a bounded sample of labelled rows; every path from a root to a
node is a conjunctive rule over the statistics.  A logistic regression with an L1 penalty
then weighs the rules, most of them with zero, and what is left is compiled into one Spark
column, so that scoring is a projection: no shuffle, no Python, no model in the task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinspark.llm.common import BLANKS, WORD, held_out, uniform, whole
from clinspark.session import stage

SAMPLE_ROWS = 8000  # labelled rows a model is fitted on, about
TREES = 12
TREE_DEPTH = 3
LASSO = 0.002

STATISTICS = (
    "log_words",
    "word_length",
    "line_words",
    "different_share",
    "again_share",
    "capital_share",
    "digit_share",
    "mark_share",
    "odd_share",
    "stop_share",
)


def _count(pattern: str) -> Column:
    return F.regexp_count(whole(), F.lit(pattern)).cast("double")


def _share(part: Column, of: Column) -> Column:
    return F.when(of > 0, part / of).otherwise(F.lit(0.0))


def _counts() -> dict[str, Column]:
    """Plain counts, in time linear in the text whatever it holds.

    A pass costs most where it matches, so letters are counted by what is none; runs of marks and
    words are taken whole or not at all, so no pattern tries a run again from its middle.
    """
    pieces = F.split(whole(), f"[{BLANKS}]+")
    chars = F.length(whole())
    return {
        "chars": chars.cast("double"),
        "words": F.size(F.array_remove(pieces, "")).cast("double"),
        "different": F.size(F.array_distinct(pieces)).cast("double"),
        "lines": (chars - F.length(F.replace(whole(), F.lit("\n"), F.lit("")))).cast("double"),
        "letters": chars.cast("double") - _count(r"\P{L}"),
        "capitals": _count(r"\p{Lu}"),
        "digits": _count(r"\p{Nd}"),
        "marks": _count(r"[^\p{L}\p{Nd}\s]"),
        "odd_marks": _count(r"[^\p{L}\p{Nd}\s.,;:?'\"()-]"),
        "stops": _count(r"(?<![.!?])[.!?]++(?=\s|$)"),
        "again": _count(r"(?<!\S)(\S++)(?=\s\1(?!\S))"),
    }


def _ratios() -> list[Column]:
    """The statistics, in their order."""
    c = F.col
    return [
        F.log1p("words"),
        _share(c("chars"), c("words")),
        c("words") / (c("lines") + 1),
        _share(c("different"), c("words")),
        _share(c("again"), c("words")),
        _share(c("capitals"), c("letters")),
        _share(c("digits"), c("chars")),
        _share(c("marks"), c("words")),
        _share(c("odd_marks"), c("words")),
        _share(c("stops"), c("words")),
    ]


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` (columns called ``c<i>``) with the statistics; null counts as an empty text."""
    given = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    kept = [f"c{i}" for i in range(len(docs.columns))]
    counted = docs.select(*given, *[e.alias(n) for n, e in _counts().items()])
    return counted.select(*kept, *[e.alias(n) for n, e in zip(STATISTICS, _ratios(), strict=True)])


# A condition: statistic, is it "at most" (else "above"), bound.
Condition = tuple[str, bool, float]


@dataclass
class RuleModel:
    """Weights of conjunctive rules; ``score`` is a column over the statistics."""

    intercept: float
    rules: list[tuple[tuple[Condition, ...], float]] = field(default_factory=list)

    def score(self) -> Column:
        total = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            total = total + F.when(holds(rule), F.lit(float(weight))).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def holds(rule: tuple[Condition, ...]) -> Column:
    out = F.lit(True)
    for name, at_most, bound in rule:
        out = out & ((F.col(name) <= bound) if at_most else (F.col(name) > bound))
    return out


def _tightest(path: list[Condition]) -> tuple[Condition, ...]:
    """A path without bounds that later ones imply, in a fixed order."""
    best: dict[tuple[str, bool], float] = {}
    for name, at_most, bound in path:
        old = best.get((name, at_most), bound)
        best[name, at_most] = min(old, bound) if at_most else max(old, bound)
    return tuple(sorted((n, a, b) for (n, a), b in best.items()))


def tree_paths(forest) -> list[tuple[Condition, ...]]:
    """The path to every node but the roots, each once."""
    found: dict[tuple[Condition, ...], None] = {}

    def walk(node, path: list[Condition]) -> None:
        if path:
            found.setdefault(_tightest(path))
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        name, bound = STATISTICS[split.featureIndex()], split.threshold()
        walk(node.leftChild(), [*path, (name, True, bound)])
        walk(node.rightChild(), [*path, (name, False, bound)])

    for tree in forest.trees:
        walk(tree._call_java("rootNode"), [])
    return list(found)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    trees: int = TREES,
    depth: int = TREE_DEPTH,
    lasso: float = LASSO,
    seed: int = 7,
) -> RuleModel:
    """Fit on the labelled documents whose id is not held out.

    About ``sample_rows`` of them are taken, by a hash of the id (all, if there are fewer);
    the sample is the only data that does not grow with the input.  Rows without a quality
    label are no training rows; an id labelled twice counts once for each label, and an id that
    several documents have once, with the smallest statistics.  With one class, or none, the score is constant: 0.95 for label 1 only, 0.05 for label 0 only,
    0.5 without any row.
    """
    learn = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    sampled = learn.where(uniform(F.lit(seed), F.col("doc_id")) < F.lit(sample_rows / max(1, learn.count()))).select(
        F.col("doc_id").alias("label_id"), F.col("quality").cast("double").alias("label")
    )
    sampled = stage(sampled, "quality-labels")  # about sample_rows rows
    texts = docs.select("doc_id", "text").join(F.broadcast(sampled), F.col("doc_id") == F.col("label_id"))
    texts = texts.select("label_id", "text", "label")
    table = with_statistics(texts).select(
        F.col("c0").alias("doc_id"), F.col("c2").alias("label"), F.array(*STATISTICS).alias("values")
    )
    # A bounded sample, written by the tasks that read the texts, cut to one row per label and then
    # put in a fixed order in one task: fits agree from run to run.
    table = stage(table, "quality-statistics").groupBy("doc_id", "label").agg(F.min("values").alias("values"))
    table = table.select("doc_id", "label", array_to_vector("values").alias("features"))
    table = stage(table.coalesce(1).sortWithinPartitions("doc_id", "label"), "quality-sample")
    classes = {row["label"] for row in table.select("label").distinct().collect()}
    if len(classes) < 2:
        prior = {1.0: 0.95, 0.0: 0.05}.get(min(classes, default=None), 0.5)
        return RuleModel(math.log(prior / (1 - prior)))

    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, minInstancesPerNode=5, seed=seed).fit(table)
    paths = tree_paths(forest)
    if not paths:  # no statistic tells the classes apart
        prior = table.agg(F.avg("label")).first()[0]
        return RuleModel(math.log(prior / (1 - prior)))
    values = table.select("label", *_unpacked())
    marked = values.select("label", array_to_vector(F.array(*[holds(p).cast("double") for p in paths])).alias("features"))
    fitted = LogisticRegression(regParam=lasso, elasticNetParam=1.0, maxIter=60).fit(marked)
    weighed = [(p, float(w)) for p, w in zip(paths, fitted.coefficients.toArray(), strict=True) if w]
    return RuleModel(float(fitted.intercept), weighed)


def _unpacked() -> list[Column]:
    return [vector_to_array("features")[i].alias(name) for i, name in enumerate(STATISTICS)]


def scored(docs: DataFrame, model: RuleModel) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1, higher: better) of every row; empty and null texts too."""
    at = docs.columns.index("doc_id")
    return with_statistics(docs).select(F.col(f"c{at}").alias("doc_id"), model.score().alias("score"))


def accepted(docs: DataFrame, model: RuleModel, least: float) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, with their columns as they were."""
    columns = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)]
    # A row number holds the filter above the statistics.  Pushed below them it would count the
    # same things in the text again for every condition of every rule.
    rows = with_statistics(docs).withColumn("row", F.monotonically_increasing_id())
    return rows.where((model.score() >= least) & (F.col("row") >= 0)).select(columns)

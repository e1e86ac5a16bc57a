"""Ranked candidate concepts for a term no rule or exact name resolves.

A concept is a candidate when its lower-case name, or that name without
anything but letters and digits, contains one of the term's words.  Candidates
are placed by (contains the longest informative word, shorter name, lower id),
and the k best of them are taken by token overlap, similarity and place.

Words are matched once each, however many terms share them, and never by a
cross join: shared tokens come from an inverted index, and a word inside longer
words is looked up by its rarest letter triple (words of one or two letters by
themselves) among the letter groups of the names, and only those pairs are
tested.  Pairs are ids until the k best are found.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clinspark.functions import similarity, text
from clinspark.operators.mapping import standard_concepts
from clinspark.session import stage

SHORTLIST = 15  # the size of the list a reviewer or model is shown

_GRAM = 3


def term_words(terms: DataFrame) -> DataFrame:
    """Words of each (domain_id, source_value), with the primary word.

    A term without any word stands for itself, letter for letter.
    """
    tokens = F.col("tokens")
    raw = F.array(F.lower("source_value"))
    return (
        terms.select("domain_id", "source_value")
        .distinct()
        .withColumn("tokens", text.clinical_tokens(F.col("source_value")))
        .withColumn("words", F.when(F.size(tokens) > 0, F.array_distinct(tokens)).otherwise(raw))
        .withColumn("primary_word", text.longest_token(text.informative_tokens(F.col("words"))))
    )


def _grams(value: Column, size: int) -> Column:
    starts = F.when(F.length(value) >= size, F.sequence(F.lit(1), F.length(value) - (size - 1)))
    cut = F.transform(starts, lambda i: F.substring(value, i, F.lit(size)))
    return F.coalesce(F.array_distinct(cut), F.array().cast("array<string>"))


def _word_grams(word: Column) -> Column:
    """The groups a word can be looked up by: its triples, or itself when shorter."""
    return F.when(F.length(word) >= _GRAM, _grams(word, _GRAM)).otherwise(F.array(word))


def _name_grams(names: DataFrame) -> DataFrame:
    """Letter groups of each name, in its lower-case and its squashed form."""
    every = [_grams(F.col(form), size) for form in ("lower_name", "squashed_name") for size in range(1, _GRAM + 1)]
    return names.withColumn("gram", F.explode(F.array_distinct(F.concat(*every))))


def _lookup_grams(words: DataFrame, names: DataFrame) -> DataFrame:
    """Each word with the letter group of it that the fewest names contain.

    Only groups that occur in some word are counted, and counting is combined
    before the shuffle.  A word with a group no name has cannot match at all.
    """
    options = words.withColumn("gram", F.explode(_word_grams(F.col("word"))))
    wanted = options.select("domain_id", "gram").distinct()
    counts = (
        _name_grams(names)
        .select("domain_id", "gram")
        .join(wanted, ["domain_id", "gram"], "left_semi")
        .groupBy("domain_id", "gram")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    sized = options.join(counts, ["domain_id", "gram"], "left")
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("gram"))).alias("pick")
    return (
        sized.groupBy("domain_id", "word")
        .agg(rarest)
        .where("pick.n > 0")
        .select("domain_id", "word", F.col("pick.gram").alias("gram"))
    )


def _names_of(terms: DataFrame, concept: DataFrame, as_of: dt.date | str | None) -> DataFrame:
    """Standard names of the terms' domains, in the forms that are compared."""
    return (
        standard_concepts(concept, as_of)
        .select("domain_id", F.col("concept_id").cast("bigint").alias("concept_id"), "concept_name")
        .where("concept_id is not null")  # an id that is not known is no candidate
        .join(terms.select("domain_id").distinct(), "domain_id", "left_semi")
        .withColumn("lower_name", F.lower("concept_name"))
        .withColumn("squashed_name", text.squashed(F.col("concept_name")))
    )


def containing(words: DataFrame, names: DataFrame, key: str = "concept_id") -> DataFrame:
    """(domain_id, word, ``key``) for every name that contains the word."""
    # Staged so that the plan knows how few words there are: they are broadcast
    # to the names while they fit, and then no name leaves its partition unmatched.
    lookup = stage(_lookup_grams(words, names), "word-grams")
    inside = F.contains("squashed_name", F.col("word")) | F.contains("lower_name", F.col("word"))
    return _name_grams(names).join(lookup, ["domain_id", "gram"]).where(inside).select("domain_id", "word", key)


def _numbered(terms: DataFrame) -> DataFrame:
    """The terms with their words under a short id, written once: later steps carry the id alone."""
    return stage(term_words(terms).withColumn("term_id", F.monotonically_increasing_id()), "term-words")


def _words_of(split: DataFrame) -> DataFrame:
    return split.select("term_id", "domain_id", F.explode("words").alias("word"))


def _distinct_names(concepts: DataFrame) -> DataFrame:
    """Each name of a domain once, under a short id, however many concepts bear it."""
    forms = concepts.select("domain_id", "concept_name", "lower_name", "squashed_name").distinct()
    return stage(forms.withColumn("name_id", F.monotonically_increasing_id()), "names")


def _lowest_ids(concepts: DataFrame, k: int) -> DataFrame:
    """Concepts that can be among the ``k`` best: of those that share a name everything but the id is alike."""
    alike = Window.partitionBy("domain_id", "concept_name").orderBy("concept_id")
    kept = concepts.withColumn("_rank", F.rank().over(alike)).where(F.col("_rank") <= k)
    return concepts.join(kept.select("concept_id").distinct(), "concept_id", "left_semi")


PLACE = ["without_primary", "name_length", "concept_id"]


def prefiltered(terms: DataFrame, concept: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """All candidates per (domain_id, source_value), with their place."""
    split = _numbered(terms)
    concepts = _names_of(split, concept, as_of)
    names = _distinct_names(concepts)
    exploded = _words_of(split)
    hits = containing(exploded.select("domain_id", "word").distinct(), names, "name_id")
    # Terms and names are paired by ids, and texts and concepts brought back last: pairs are not shuffled as concepts.
    pairs = exploded.join(hits, ["domain_id", "word"]).select("term_id", "name_id").distinct()
    without = F.when(F.contains("squashed_name", F.col("primary_word")), 0).otherwise(1)
    named = (
        pairs.join(names.drop("lower_name"), "name_id")
        .join(split.drop("domain_id", "words"), "term_id")
        .withColumn("without_primary", without)
        .withColumn("name_length", F.length("concept_name"))
    )
    found = named.join(concepts.select("domain_id", "concept_name", "concept_id"), ["domain_id", "concept_name"])
    place = F.row_number().over(Window.partitionBy("term_id").orderBy(*PLACE))
    return found.select(
        "domain_id", "source_value", "tokens", place.alias("place"), "name_length", "concept_id", "concept_name"
    )


DIRECT = 256  # a term whose tokens have at most this many postings per wanted name is looked up in all of them


def _indexed_names(names: DataFrame) -> DataFrame:
    """Names with their distinct tokens and what similarity needs of them, each prepared once."""
    return stage(
        names.withColumn("name_ordered", similarity.sorted_words(F.lower("concept_name")))
        .withColumn("name_tokens", F.array_distinct(text.clinical_tokens(F.col("concept_name"))))
        .withColumn("name_masks", similarity.letter_masks(F.col("name_ordered")))
        .withColumn("ordered_length", F.length("name_ordered").cast("bigint")),
        "indexed-names",
    )


def _bound(own: Column, other: Column) -> Column:
    """The highest similarity that texts of these lengths can have."""
    return similarity.percent(F.least(own, other), own + other)


def _search_terms(split: DataFrame, postings: DataFrame) -> DataFrame:
    """Terms with the tokens that some name has, rarest first, and the number of their postings.

    A token weighs 1, an informative one more than all tokens of the term together, so that the
    summed weight of shared tokens ranks like (shared informative tokens, shared tokens).
    """
    useful = text.informative_tokens(F.array_distinct("tokens"))
    wanted = split.withColumn("useful", useful).select(
        "term_id",
        "domain_id",
        F.length("ordered").cast("bigint").alias("own_length"),
        F.explode(F.array_distinct("tokens")).alias("token"),
        F.size(F.array_distinct("tokens")).cast("bigint").alias("all_tokens"),
        "useful",
    )
    weight = F.when(F.array_contains("useful", F.col("token")), F.col("all_tokens") + 1).otherwise(F.lit(0)) + 1
    counts = postings.groupBy("domain_id", "token").agg(F.count(F.lit(1)).alias("names"))
    found = F.struct("names", "token", weight.alias("weight"))
    return stage(
        wanted.join(counts, ["domain_id", "token"])
        .groupBy("term_id", "domain_id", "own_length")
        .agg(F.sum("names").alias("postings"), F.array_sort(F.collect_list(found)).alias("found")),
        "search-terms",
    )


def _shared_weight(name_tokens: Column) -> Column:
    shared = F.filter("found", lambda t: F.array_contains(name_tokens, t["token"]))
    return F.aggregate(shared, F.lit(0).cast("bigint"), lambda total, t: total + t["weight"])


def _similar(pairs: DataFrame, names: DataFrame, split: DataFrame) -> DataFrame:
    """Pairs with their similarity and the columns of both sides that the ranking needs."""
    own, other = F.length("ordered").cast("bigint"), F.col("ordered_length")
    # The masks of either side serve; those of a text of one block are the fast ones.
    by_term = similarity.common_length(F.col("masks"), own, similarity.letters(F.col("name_ordered")))
    by_name = similarity.common_length(F.col("name_masks"), other, similarity.letters(F.col("ordered")))
    common = F.when(F.size("masks") <= 1, by_term).otherwise(by_name)
    return (
        pairs.join(names.drop("domain_id", "lower_name", "name_tokens"), "concept_id")
        .join(split.drop("words"), "term_id")
        .withColumn("similarity", similarity.percent(common, own + other))
        .drop("masks", "name_masks", "ordered", "name_ordered", "ordered_length")
    )


def _looked_up(search: DataFrame, postings: DataFrame) -> DataFrame:
    """(term_id, concept_id, weight) of all names that share a token with these terms."""
    return (
        search.select("term_id", "domain_id", F.explode("found").alias("t"))
        .select("term_id", "domain_id", F.col("t.token").alias("token"), F.col("t.weight").alias("weight"))
        .join(postings.select("domain_id", "token", "concept_id"), ["domain_id", "token"])
        .groupBy("term_id", "concept_id")
        .agg(F.sum("weight").alias("weight"))
    )


def _by_length(search: DataFrame, postings: DataFrame) -> DataFrame:
    """The terms' tokens with their numbers of postings for each length of the name."""
    tokens = search.select("domain_id", F.explode("found").alias("t")).select("domain_id", F.col("t.token").alias("token"))
    lengths = (
        postings.join(tokens.distinct(), ["domain_id", "token"], "left_semi")
        .groupBy("domain_id", "token", "ordered_length")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("domain_id", "token")
        .agg(F.collect_list(F.struct("ordered_length", "n")).alias("lengths"))
    )
    rows = search.select("term_id", "domain_id", F.explode("found").alias("t"))
    with_lengths = rows.withColumn("token", F.col("t.token")).join(lengths, ["domain_id", "token"])
    found = F.struct("t.names", "t.token", "t.weight", "lengths")
    lists = with_lengths.groupBy("term_id").agg(F.array_sort(F.collect_list(found)).alias("found"))
    return stage(search.drop("found").join(lists, "term_id"), "frequent-terms")


def _seeds(search: DataFrame, postings: DataFrame, k: int) -> DataFrame:
    """For each term and token of it, at least ``k`` names with the token (or all), nearest in length first."""

    def nearest(own: Column, lengths: Column) -> Column:
        by_bound = F.array_sort(
            F.transform(lengths, lambda x: F.struct(-_bound(own, x["ordered_length"]), x["ordered_length"], x["n"]))
        )
        few = F.slice(by_bound, 1, k)
        before = lambda i: F.aggregate(F.slice(few, F.lit(1), i), F.lit(0).cast("bigint"), lambda s, x: s + x["n"])
        return F.transform(F.filter(few, lambda x, i: before(i) < k), lambda x: x["ordered_length"])

    asked = search.select("term_id", "domain_id", "own_length", "found", F.explode("found").alias("t")).select(
        "term_id",
        "domain_id",
        "found",
        F.col("t.token").alias("token"),
        F.explode(nearest(F.col("own_length"), F.col("t.lengths"))).alias("ordered_length"),
    )
    key = ["domain_id", "token", "ordered_length"]
    place = F.row_number().over(Window.partitionBy(*key).orderBy("concept_id"))
    heads = (
        postings.join(asked.select(*key).distinct(), key, "left_semi").withColumn("_place", place).where(F.col("_place") <= k)
    )
    return (
        asked.join(heads, key)
        .select("term_id", "concept_id", _shared_weight(F.col("name_tokens")).alias("weight"))
        .groupBy("term_id", "concept_id")
        .agg(F.max("weight").alias("weight"))
    )


def _searched(frequent: DataFrame, postings: DataFrame, names: DataFrame, split: DataFrame, k: int) -> DataFrame:
    """(term_id, concept_id, weight) of every name that can be among the ``k`` best of these terms.

    The weight of the k-th best seed is the least that matters.  A name of at least a given
    weight holds one of the term's rarest tokens, as the others together weigh less: so only
    the postings of those tokens are read.  Names of the least weight itself matter only if
    fewer than ``k`` weigh more; then the seeds of that weight give a least similarity, only
    names whose length allows it are read, and those that have it are kept.  Terms with fewer than ``k`` seeds have them all.
    """
    search = _by_length(frequent, postings)
    seeds = stage(_seeds(search, postings, k), "seeds")
    result = ["term_id", "concept_id", "weight"]
    heaviest = Window.partitionBy("term_id").orderBy(F.desc("weight"), "concept_id")
    least = (
        seeds.withColumn("_place", F.row_number().over(heaviest))
        .where(F.col("_place") == k)
        .select("term_id", F.col("weight").alias("least_weight"))
    )
    bounded = stage(search.join(least, "term_id"), "least-weights")
    found, shared = F.col("found"), _shared_weight(F.col("name_tokens"))

    def rarest(weight: Column) -> Column:
        """Tokens that a name of that weight cannot do without."""
        left = lambda i: F.aggregate(
            F.slice(found, i + 1, F.size(found)), F.lit(0).cast("bigint"), lambda total, t: total + t["weight"]
        )
        return F.filter(found, lambda t, i: left(i) >= weight)

    # A name with several of these tokens counts at the rarest.
    first = F.get(F.filter(found, lambda t: F.array_contains(F.col("name_tokens"), t["token"])), F.lit(0))["token"]
    columns = ["term_id", "domain_id", "found", "least_weight", "token"]
    above = stage(
        bounded.withColumn("token", F.explode(F.transform(rarest(F.col("least_weight") + 1), lambda t: t["token"])))
        .select(*columns)
        .join(postings.drop("ordered_length"), ["domain_id", "token"])
        .where((shared > F.col("least_weight")) & (F.col("token") == first))
        .select("term_id", "concept_id", shared.alias("weight")),
        "heavier-names",
    )
    heavier = above.groupBy("term_id").agg(F.count(F.lit(1)).alias("n"))
    tied = bounded.join(heavier, "term_id", "left").where(F.coalesce("n", F.lit(0)) < k)
    tied = stage(tied.withColumn("room", k - F.coalesce("n", F.lit(0))).drop("n"), "tied-terms")
    level_seeds = seeds.join(tied.select("term_id", "least_weight", "room"), "term_id").where("weight = least_weight")
    similar = _similar(level_seeds.select("term_id", "concept_id", "room"), names, split)
    closest = Window.partitionBy("term_id").orderBy(F.desc("similarity"), "concept_id")
    least_similar = (
        similar.withColumn("_place", F.row_number().over(closest))
        .where(F.col("_place") == F.col("room"))
        .select("term_id", F.col("similarity").alias("least_similarity"))
    )
    near = lambda x: _bound(F.col("own_length"), x["ordered_length"]) >= F.col("least_similarity")
    level = (
        tied.join(least_similar, "term_id")
        .withColumn("t", F.explode(rarest(F.col("least_weight"))))
        .withColumn("token", F.col("t.token"))
        .withColumn("length", F.explode(F.filter("t.lengths", near)))
        .select(*columns, "least_similarity", F.col("length.ordered_length").alias("ordered_length"))
        .join(postings, ["domain_id", "token", "ordered_length"])
        .where((shared == F.col("least_weight")) & (F.col("token") == first))
        .select(*result[:2], shared.alias("weight"), "least_similarity")
    )
    level = _similar(level, names, split).where("similarity >= least_similarity").select(*result)
    return above.unionByName(level).unionByName(seeds.join(least, "term_id", "left_anti").select(*result))


def with_overlap(rows: DataFrame) -> DataFrame:
    """Add both overlaps of the name's tokens with the term's ``tokens``."""
    if "name_tokens" not in rows.columns:
        rows = rows.withColumn("name_tokens", text.clinical_tokens(F.col("concept_name")))
    informative = text.informative_tokens(F.col("tokens"))
    return rows.withColumn(
        "informative_overlap", text.overlap_ratio(informative, F.col("name_tokens"))
    ).withColumn("total_overlap", text.overlap_ratio(F.col("tokens"), F.col("name_tokens")))


def shortlist(
    terms: DataFrame, concept: DataFrame, as_of: dt.date | str | None = None, k: int = SHORTLIST
) -> DataFrame:
    """The ``k`` best candidates per (domain_id, source_value), best first (``position`` from 1).

    The search is exact and reads an inverted index of tokens.  Terms of rare tokens look all
    their postings up, which are at most ``DIRECT`` times ``k``.  For the others a few names near in
    length give a score that the k best reach, and only names that can reach it are read (see
    ``_searched``).  Similarity is computed for names that the shared tokens leave among the
    first ``k``, ties included.  A name that merely contains a word has no overlap and comes
    after every name that shares a token, so letter groups are searched only for terms with
    fewer than ``k`` names of the latter kind.
    """
    ordered = _numbered(terms).withColumn("ordered", similarity.sorted_words(F.lower("source_value")))
    split = stage(ordered.withColumn("masks", similarity.letter_masks(F.col("ordered"))), "terms")
    names = _indexed_names(_lowest_ids(_names_of(split, concept, as_of), k))
    postings = stage(
        names.select("domain_id", F.explode("name_tokens").alias("token"), "ordered_length", "concept_id", "name_tokens"),
        "postings",
    )
    search = _search_terms(split, postings)
    few = F.col("postings") <= DIRECT * k
    shared = _looked_up(search.where(few), postings)
    frequent = search.where(~few)
    if not frequent.isEmpty():
        shared = shared.unionByName(_searched(frequent, postings, names, split, k))
    by_weight = Window.partitionBy("term_id").orderBy(F.desc("weight"))
    shared = stage(shared.withColumn("_rank", F.rank().over(by_weight)).where(F.col("_rank") <= k).drop("_rank"), "token-hits")
    served = shared.groupBy("term_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
    short = stage(split.join(served, "term_id", "left_anti"), "short-terms")
    loose = _words_of(short).join(
        containing(_words_of(short).select("domain_id", "word").distinct(), names), ["domain_id", "word"]
    )
    # Terms with fewer than k names that share a token have all of them among the hits.
    loose = loose.select("term_id", "concept_id").distinct().join(shared, ["term_id", "concept_id"], "left_anti")
    pairs = shared.unionByName(loose.withColumn("weight", F.lit(0).cast("bigint")))

    useful = text.informative_tokens(F.array_distinct("tokens"))
    heavy = (F.size(F.array_distinct("tokens")) + 2).cast("bigint")  # the weight of an informative token
    informative = F.floor(F.col("weight") / heavy)
    total = informative + F.col("weight") - informative * heavy
    without = F.when(F.contains("squashed_name", F.col("primary_word")), 0).otherwise(1)
    similar = (
        _similar(pairs, names, split)
        .withColumn("without_primary", without)
        .withColumn("name_length", F.length("concept_name"))
    )
    # The place of a candidate is (without the primary word, length, id).
    final = Window.partitionBy("term_id").orderBy(F.desc("weight"), F.desc("similarity"), "name_length", *PLACE)
    share = lambda n, of: n / F.greatest(F.size(of), F.lit(1))
    return (
        similar.withColumn("position", F.row_number().over(final))
        .where(F.col("position") <= k)
        .select(
            "domain_id",
            "source_value",
            "position",
            "concept_id",
            "concept_name",
            share(informative, useful).alias("informative_overlap"),
            share(total, F.array_distinct("tokens")).alias("total_overlap"),
            "similarity",
        )
    )


def gate_picks(candidates: DataFrame, replies: DataFrame) -> DataFrame:
    """The pick in each reply, if it is one of the term's candidates; otherwise concept 0.

    ``replies``: (domain_id, source_value, reply).  Terms without a reply, or
    whose reply holds no number, also get 0.
    """
    keys = ["domain_id", "source_value"]
    picks = replies.select(*keys, text.first_integer(F.col("reply")).alias("picked_id"))
    offered = candidates.select(*keys, F.col("concept_id").alias("picked_id"), "concept_name")
    terms = picks.select(*keys).unionByName(candidates.select(*keys)).distinct()
    accepted = picks.join(offered, [*keys, "picked_id"]).groupBy(*keys).agg(
        F.min(F.struct("picked_id", "concept_name")).alias("pick")
    )
    return terms.join(accepted, keys, "left").select(
        *keys,
        F.coalesce("pick.picked_id", F.lit(0).cast("bigint")).alias("concept_id"),
        F.col("pick.concept_name").alias("concept_name"),
    )

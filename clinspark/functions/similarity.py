"""Token similarity between two names, as column expressions.

The measure is the indel similarity: twice the longest common subsequence over the
summed lengths.  Its length is found bit by bit: one name is kept as a mask of places
per letter, in blocks of 62 letters, and the other name's letters walk over a row of
bits, a handful of integer operations per letter and block.  Masks and letters belong
to a single name, so a join of many pairs prepares each name once (``letter_masks``,
``letters``) and computes only ``common_length`` per pair.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 62  # two rows and a carry still fit a signed long


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(name: Column) -> Column:
    """Lower-case words of letters, digits and underscores; letters of Latin-1 beyond ASCII are dropped."""
    plain = F.regexp_replace(F.lower(name), r"[\u0080-ÿ]", "")
    return F.filter(F.split(F.regexp_replace(plain, r"[^\p{L}\p{N}_]+", " "), " "), lambda w: w != "")


def sorted_words(name: Column) -> Column:
    """The text that names are compared by: their words in order."""
    return F.array_join(F.array_sort(words(name)), " ")


def letters(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place.cast("int"))


def _masks_of(block: Column) -> Column:
    def mask(letter: Column) -> Column:
        bits = F.transform(block, lambda x, i: F.when(x == letter, _bit(i)).otherwise(F.lit(0).cast("bigint")))
        return F.aggregate(bits, F.lit(0).cast("bigint"), lambda a, b: a + b)

    return F.map_from_entries(F.transform(F.array_distinct(block), lambda c: F.struct(c, mask(c))))


def letter_masks(text: Column) -> Column:
    """For each block of letters a map from letter to the bits of its places."""

    def blocks(found: Column) -> Column:
        last = F.floor((F.size(found) - 1) / BLOCK).cast("int")
        starts = F.when(F.size(found) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda b: _let(F.slice(found, b * BLOCK + 1, F.lit(BLOCK)), _masks_of))

    return _let(letters(text), blocks)


def _ones(row: Column) -> Column:
    return F.bit_count(row).cast("bigint")


def common_length(masks: Column, length: Column, other: Column) -> Column:
    """Length of the longest common subsequence of a text with these masks and length, and other letters."""
    none = F.lit(0).cast("bigint")

    def hit(block: Column, letter: Column, row: Column) -> Column:
        return row.bitwiseAND(F.coalesce(F.try_element_at(block, letter), none))

    full = _bit(length) - 1
    short = F.aggregate(
        F.transform(other, lambda c: F.coalesce(F.try_element_at(F.get(masks, F.lit(0)), c), none)),
        full,
        lambda row, m: (row + row.bitwiseAND(m)).bitwiseOR(row - row.bitwiseAND(m)).bitwiseAND(full),
    )

    def walk(fulls: Column) -> Column:
        def step(rows: Column, letter: Column) -> Column:
            def block(done: Column, j: Column) -> Column:
                row = F.get(rows, j)
                met = hit(F.get(masks, j), letter, row)
                total = row + met + done["carry"]
                kept = total.bitwiseOR(row - met).bitwiseAND(F.get(fulls, j))
                return F.struct(
                    F.concat(done["rows"], F.array(kept)).alias("rows"), F.shiftright(total, BLOCK).alias("carry")
                )

            start = F.struct(F.array().cast("array<bigint>").alias("rows"), none.alias("carry"))
            return F.aggregate(F.sequence(F.lit(0), F.size(fulls) - 1), start, block, lambda done: done["rows"])

        end = F.aggregate(other, fulls, step)
        return length - F.aggregate(end, none, lambda n, row: n + _ones(row))

    rest = F.pmod(length - 1, F.lit(BLOCK)) + 1
    fulls = F.transform(
        masks, lambda _, j: F.when(j == F.size(masks) - 1, _bit(rest) - 1).otherwise(F.lit((1 << BLOCK) - 1))
    )
    return (
        F.when(F.size(masks) == 0, none)
        .when(F.size(masks) == 1, length - _ones(short))
        .otherwise(_let(fulls, walk))
        .cast("bigint")
    )


def common(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two texts."""
    return _let(
        F.struct(letter_masks(a).alias("masks"), F.length(a).cast("bigint").alias("n"), letters(b).alias("other")),
        lambda p: common_length(p["masks"], p["n"], p["other"]),
    )


def percent(shared: Column, total: Column) -> Column:
    """0 to 100 from the common length and both lengths together, half to even."""
    return F.when(total > 0, F.rint(F.lit(200.0) * shared / total)).otherwise(F.lit(100.0)).cast("bigint")


def _columns(*names: Column | str) -> list[Column]:
    return [F.col(name) if isinstance(name, str) else name for name in names]


def token_sort_similarity(a: Column | str, b: Column | str) -> Column:
    """0 to 100, after sorting the words of both names; 0 if one is missing."""
    a, b = _columns(a, b)

    def compared(p: Column) -> Column:
        return percent(common(p["a"], p["b"]), F.length(p["a"]) + F.length(p["b"]))

    pair = F.struct(sorted_words(a).alias("a"), sorted_words(b).alias("b"))
    return F.when(a.isNull() | b.isNull(), F.lit(0).cast("bigint")).otherwise(_let(pair, compared))


def token_set_similarity(a: Column | str, b: Column | str) -> Column:
    """0 to 100, comparing the shared words with each side's remaining words; 0 without any word.

    Both sides begin with the shared words, so only what remains has to be compared.
    """
    a, b = _columns(a, b)

    def compared(p: Column) -> Column:
        base, rest = p["shared"], F.length(p["one"]) + F.length(p["two"])
        head = F.when(F.length(base) > 0, F.length(base) + 1).otherwise(0)
        whole = F.lit(200.0) * (head + common(p["one"], p["two"])) / (2 * head + rest)
        shared_with = [
            F.when(head > 0, F.lit(200.0) * F.length(base) / (F.length(base) + head + F.length(p[side]))).otherwise(0.0)
            for side in ("one", "two")
        ]
        done = (F.length(base) > 0) & ((F.length(p["one"]) == 0) | (F.length(p["two"]) == 0))
        return F.when(p["empty"], 0.0).when(done, 100.0).otherwise(F.rint(F.greatest(whole, *shared_with))).cast("bigint")

    def parts(w: Column) -> Column:
        text = lambda found: F.array_join(F.array_sort(found), " ")
        return F.struct(
            text(F.array_intersect(w["a"], w["b"])).alias("shared"),
            text(F.array_except(w["a"], w["b"])).alias("one"),
            text(F.array_except(w["b"], w["a"])).alias("two"),
            ((F.size(w["a"]) == 0) | (F.size(w["b"]) == 0)).alias("empty"),
        )

    both = F.struct(words(a).alias("a"), words(b).alias("b"))
    found = _let(_let(both, parts), compared)
    return F.when(a.isNull() | b.isNull(), F.lit(0).cast("bigint")).otherwise(found)


def confidence(a: Column | str, b: Column | str) -> Column:
    """0.0 to 1.0 in two decimals; 0.0 when either name is missing."""
    return F.coalesce(token_set_similarity(a, b) / F.lit(100.0), F.lit(0.0))

"""Identifiers, term keys and clinical tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that count as surrounding blank space.
BLANKS = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680]
        + [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)

# The same code points as ranges of a pattern: a class that lists them one by one is slower to match.
_BLANK_RUN = r"[\x09-\x0D\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]+"

# Words too general to identify a clinical concept.
GENERIC_TOKENS = ["duration", "level", "measurement", "result", "site", "test", "type"]


# Text that begins and ends in a visible ASCII letter or sign.
_EDGED = r"(?s)\A[!-~](.*[!-~])?\z"


def strip(text: Column) -> Column:
    """Without the blanks around it.

    Most text has none, and one match tells so several times faster than the list of blanks is searched.
    """
    return F.when(text.rlike(_EDGED), text).otherwise(F.btrim(text, F.lit(BLANKS)))


def blank_to_null(text: Column) -> Column:
    """Null for null, empty and all-blank text; otherwise the text as it was."""
    return F.when(strip(text) != "", text)


def person_id(subject: Column) -> Column:
    """60-bit positive id from the SHA-256 of the trimmed subject id."""
    name = strip(subject)
    hashed = F.conv(F.substring(F.sha2(name, 256), 1, 15), 16, 10).cast("bigint")
    return F.when((name != "") & (F.lower(name) != "nan"), hashed)


def coded_or_verbatim(coded: Column, verbatim: Column) -> Column:
    return F.coalesce(blank_to_null(coded), verbatim)


# Letters whose full case folding is not their lower case (ß, ligatures, final sigma and so on), by the
# Unicode tables of this Python.
FOLDED = {c: c.casefold() for c in map(chr, [*range(0xD800), *range(0xE000, 0x20000)]) if c.lower().casefold() != c.lower()}
_FOLDED_LOWER = {c.lower(): folded for c, folded in FOLDED.items() if len(c.lower()) == 1}


def folded_case(value: Column) -> Column:
    """Full case folding.  Only text that holds one of the special letters is taken apart.

    None of them is ASCII, so text with as many bytes as letters is not searched for them: a class of some
    hundred letters is slow to match.
    """
    lower = F.lower(value)
    beyond_ascii = F.octet_length(lower) > F.char_length(lower)
    special = F.create_map(*[F.lit(x) for pair in _FOLDED_LOWER.items() for x in pair])
    letters = F.transform(F.split(lower, ""), lambda c: F.coalesce(F.try_element_at(special, c), c))
    found = beyond_ascii & lower.rlike(f"[{''.join(_FOLDED_LOWER)}]")
    return F.when(found, F.array_join(letters, "")).otherwise(lower)


def normalized_key(value: Column) -> Column:
    """Key of the rule tables: blank runs become one space, case is folded."""
    return F.regexp_replace(folded_case(strip(value)), _BLANK_RUN, " ")


def match_key(term: Column) -> Column:
    """Key a source term is compared with: ``lower(concept_name)`` on the other side."""
    return strip(F.lower(term))


def squashed(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), "[^a-z0-9]", "")


def clinical_tokens(term: Column) -> Column:
    """Words and numbers of a term; ``Q-T`` and ``R R`` count as one token."""
    joined = F.regexp_replace(term, r"(?U)\b([a-zA-Z])[-\s]([a-zA-Z])\b", "$1$2")
    words = F.regexp_extract_all(F.lower(joined), F.lit("([a-z0-9]+)"), F.lit(1))
    return F.filter(words, lambda w: (F.length(w) >= 2) | w.between("0", "9"))


def informative_tokens(tokens: Column) -> Column:
    """Tokens without the generic words, or all of them when nothing else is left."""
    kept = F.filter(tokens, lambda w: ~w.isin(GENERIC_TOKENS))
    return F.when(F.size(kept) > 0, kept).otherwise(tokens)


def longest_token(tokens: Column) -> Column:
    """First token of the greatest length; null for an empty list."""
    return F.aggregate(
        tokens,
        F.lit(None).cast("string"),
        lambda best, w: F.when(F.length(w) > F.coalesce(F.length(best), F.lit(0)), w).otherwise(best),
    )


def overlap_ratio(wanted: Column, found: Column) -> Column:
    """Share of the distinct wanted tokens that were found."""
    total = F.greatest(F.size(F.array_distinct(wanted)), F.lit(1))
    return F.size(F.array_intersect(wanted, found)) / total


def first_integer(reply: Column) -> Column:
    """First run of digits in a free-text reply; null if there is none."""
    return F.regexp_extract(reply, r"(\d+)", 1).try_cast("bigint")

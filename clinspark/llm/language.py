"""Language by cross-parsing.

For each language a suffix automaton holds a bounded sample of its labelled text.  A text is
cut, greedily from the left, into the longest phrases that occur in a language's sample; the
language whose sample needs the fewest phrases per symbol describes the text best and wins.

An automaton is a dense table: from a state and a symbol to the next state and the number of
phrases that end.  Tasks parse many pieces of texts at the same time, one table look-up per
symbol and language.  Texts are cut into pieces of 256 symbols for that, and each piece begins a
new phrase; whole texts are parsed, and the result of a text does not depend on what else is in
the batch.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinspark.llm.common import held_out, small_batches, uniform

SAMPLE_ROWS = 64  # labelled documents per language, about
SAMPLE_CHARS = 1000  # of each of them, from all over the text
SAMPLE_PIECES = 5  # into which they are split, if the text is longer
PIECE = 256
LETTER = r"\p{L}"
UNDECIDED = "und"


class Alphabet:
    """Symbols: 0 for a run of anything but letters, then the letters of the samples, then one for all others."""

    def __init__(self, texts: list[str]):
        letters = sorted({c for t in texts for c in t.lower() if c.isalpha() and ord(c) < 0x10000})
        self.size = len(letters) + 2
        self.table = np.zeros(0x10000, np.uint16)
        self.table[[c for c in range(0x10000) if chr(c).isalpha()]] = self.size - 1
        self.table[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)

    def symbols(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        out = self.table[np.minimum(codes, 0xFFFF)]
        for at in np.flatnonzero(codes > 0xFFFF):
            out[at] = self.size - 1 if chr(codes[at]).isalpha() else 0
        keep = np.ones(len(out), bool)
        keep[1:] = (out[1:] != 0) | (out[:-1] != 0)
        return out[keep]


def automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the root."""
    following: list[dict[int, int]] = [{}]
    suffix, length, last = [-1], [0], 0
    for c in symbols:
        new = len(following)
        following.append({})
        length.append(length[last] + 1)
        suffix.append(0)
        p = last
        while p >= 0 and c not in following[p]:
            following[p][c] = new
            p = suffix[p]
        if p >= 0:
            q = following[p][c]
            if length[q] == length[p] + 1:
                suffix[new] = q
            else:
                copy = len(following)
                following.append(dict(following[q]))
                length.append(length[p] + 1)
                suffix.append(suffix[q])
                while p >= 0 and following[p].get(c) == q:
                    following[p][c] = copy
                    p = suffix[p]
                suffix[q] = suffix[new] = copy
        last = new
    return following


@dataclass
class CrossParser:
    languages: list[str]
    alphabet: Alphabet
    roots: np.ndarray  # state of each language's root
    table: np.ndarray  # state * symbols + symbol -> 4 * next state + phrases that end

    @classmethod
    def fit(cls, samples: dict[str, str]) -> CrossParser:
        """``samples`` in order of preference: the first of equally good languages wins."""
        languages = list(samples)
        alphabet = Alphabet(list(samples.values()))
        tables, roots, base = [], [], 0
        for language in languages:
            following = automaton(alphabet.symbols(samples[language]).tolist())
            start = np.full(alphabet.size, -1)
            start[list(following[0])] = list(following[0].values())
            unseen = start < 0
            # A phrase ends before a symbol that does not continue it; a symbol never seen is a phrase.
            restart = (np.where(unseen, 0, start) + base) * 4 + unseen
            table = np.tile(restart + 1, (len(following), 1))
            table[0] = restart
            for state, moves in enumerate(following):
                table[state, list(moves)] = [(to + base) * 4 for to in moves.values()]
            tables.append(table.astype(np.int32))
            roots.append(base)
            base += len(following)
        table = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)
        return cls(languages, alphabet, np.array(roots, np.int64), table)

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Number of phrases of each text (its symbols) in each language."""
        total = np.zeros((len(texts), len(self.languages)), np.int64)
        pieces = [(i, t[a : a + PIECE]) for i, t in enumerate(texts) for a in range(0, len(t), PIECE)]
        pieces.sort(key=lambda p: -len(p[1]))
        for at in range(0, len(pieces), 4096):
            some = pieces[at : at + 4096]
            sizes = np.array([len(p) for _, p in some])
            grid = np.zeros((sizes[0], len(some)), np.int32)
            for lane, (_, piece) in enumerate(some):
                grid[: len(piece), lane] = piece
            state = np.repeat(self.roots[:, None], len(some), 1)
            count = np.zeros(state.shape, np.int64)
            for step in range(sizes[0]):
                lanes = int(np.searchsorted(-sizes, -step, "left"))  # the pieces longer than ``step``
                moved = self.table.take(state[:, :lanes] * self.alphabet.size + grid[step, :lanes])
                count[:, :lanes] += moved & 3
                state[:, :lanes] = moved >> 2
            count += state != self.roots[:, None]  # the phrase a piece ends in
            np.add.at(total, np.array([i for i, _ in some]), count.T)
        return total

    def classify(self, texts: list[str]) -> tuple[list[str], list[float]]:
        symbols = [self.alphabet.symbols(t) for t in texts]
        total = self.phrases(symbols) if self.languages else np.zeros((len(texts), 0))
        names, scores = [], []
        for one, counts in zip(symbols, total, strict=True):
            if not one.any() or not len(counts):
                names.append(UNDECIDED)
                scores.append(0.0)
                continue
            best = int(counts.argmin())  # the first of equals
            names.append(self.languages[best])
            scores.append(float((1 / counts[best]) / (1 / counts).sum()))
        return names, scores


def _spread(chars: int, seed: str) -> Column:
    """At most ``chars`` characters of ``text``, from its beginning to its end, with runs of other than letters as one blank."""
    text = F.regexp_replace("text", f"[^{LETTER}]+", " ")
    pieces = min(SAMPLE_PIECES, chars)
    size, part = chars // pieces, F.floor(F.length(text) / pieces)
    starts = [
        F.lit(i) * part + F.floor(uniform(F.lit(seed), F.lit(i), F.col("doc_id"), F.xxhash64("text")) * (part - size + 1))
        for i in range(pieces)
    ]
    taken = F.concat_ws(" ", *[F.substr(text, (s + 1).cast("int"), F.lit(size)) for s in starts])
    return F.when(F.length(text) <= chars, text).otherwise(taken)


def learn(docs: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS, seed: str = "language") -> CrossParser:
    """Fit on text and ``lang`` of documents that are not held out.

    Of each language about ``rows`` documents are taken, by a hash of the id (all, if there are
    fewer), and ``chars`` characters of each: the sample is bounded by the number of languages.
    The characters are counted with runs of anything but letters as one; of a longer text they are
    pieces, one from each of equal parts of it, at places chosen by a hash.  Rows without id, language or letters teach nothing.
    """
    known = docs.where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").rlike(LETTER)
    )
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # one row per language
    if not counts:
        return CrossParser.fit({})
    share = F.element_at(F.create_map(*[F.lit(x) for l, n in counts.items() for x in (l, rows / n)]), F.col("lang"))
    mark = uniform(F.lit(seed), F.col("doc_id"))
    # Of a language with few rows every one is taken; of others a share that gives ``rows`` of them.
    sample = known.where(mark < share).select("lang", mark.alias("mark"), "doc_id", _spread(chars, seed).alias("text"))
    found: dict[str, list[str]] = {}
    for row in sorted(sample.collect(), key=lambda r: (-counts[r["lang"]], r["lang"], r["mark"], r["doc_id"], r["text"])):
        found.setdefault(row["lang"], []).append(row["text"])
    return CrossParser.fit({language: " ".join(texts) for language, texts in found.items()})


def predict(docs: DataFrame, model: CrossParser) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (0 to 1) of every row of ``docs``.

    The score is the winner's share of the inverse phrase counts.  A text that is null or has no
    letter, and any text if nothing was learned, is ``und`` with score 0.  Ties go to the
    language with more labelled documents, then to the one that sorts first.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            names, scores = shared.value.classify([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, lang_pred string, score double"
    )

"""Ids of plain words straight from a byte-level BPE model of the tokenizers library.

A whole tokenizer spends most of its time on a word's offsets and on rules that do not touch a
run of Latin letters.  Such a run is one piece for the model, so the model alone gives its ids.
"""

from __future__ import annotations

import re

# Letters of one code point that normalisation leaves alone: of ASCII and of Latin-1.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"

is_letters = re.compile(f"[{LETTERS}]+").fullmatch


class ByteModel:
    def __init__(self, tokenizer):
        from tokenizers import pre_tokenizers

        self.model = tokenizer.model
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        name = lambda c: as_bytes.pre_tokenize_str(c)[0][0]
        self.space = name(" ")
        self.byte_names = str.maketrans({chr(c): name(chr(c)) for c in range(0xC0, 0x100)})

    def ids(self, word: str, behind_space: bool = False) -> list[int]:
        """Ids of a run of letters, by itself or behind a space."""
        if not word.isascii():
            word = word.translate(self.byte_names)
        return [token.id for token in self.model.tokenize(self.space + word if behind_space else word)]

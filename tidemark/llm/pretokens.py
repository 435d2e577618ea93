"""Splitting texts into the pre-tokens of a vocabulary file, as its library does.

The patterns run in the `regex` module. Its character tables are newer than the
library's, so a text holding a character on which the two may differ is split (and, where
the file has a normalizer, lower-cased) by the library's own rule object; all other texts
take the fast way. Special strings are cut out first, as the library does by default.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np
import regex
from tokenizers import Tokenizer

#: Texts whose UTF-8 bytes all lie below this hold characters up to U+053F only, on
#: which every version of the character tables agrees.
RARE_BYTE = 0xD5

# ---------------------------------------------------------------------------
# The split rules of the two kinds of vocabulary files.
# ---------------------------------------------------------------------------
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
# ---------------------------------------------------------------------------


class Splitter:
    """Pre-tokens of a text; special strings come as themselves."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.lowers = self.library.normalizer is not None
        self.find = regex.compile(WORD_LEVEL if self.lowers else BYTE_LEVEL).findall
        specials = [re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("(" + "|".join(specials) + ")") if specials else None
        self._foreign = None

    def foreign(self):
        """Finds a character that the two tables class differently."""
        if self._foreign is None:
            rule, found = self.library.pre_tokenizer.pre_tokenize_str, []
            for code in range(0x110000):
                c = chr(code)
                if unicodedata.category(c) == "Cn" and regex.match(r"[\p{L}\p{N}\s]", c):
                    sample = f"a{c}b 1{c} {c}! {c}"
                    if len(rule(sample)) != len(self.find(sample)):
                        found.append(c)
            self._foreign = re.compile("[" + "".join(found) + "]") if found else re.compile("(?!)")
        return self._foreign

    def split(self, text: str, rare: bool) -> list[str]:
        """`rare`: the text has a byte of RARE_BYTE or more."""
        if self.special and "<|" in text:
            parts = self.special.split(text)  # odd places hold the special strings
            out: list[str] = []
            for i, part in enumerate(parts):
                out += [part] if i % 2 else self._plain(part, rare)
            return out
        return self._plain(text, rare)

    def _plain(self, text: str, rare: bool) -> list[str]:
        if not rare:
            if self.lowers:
                # each character by itself: no special form at the end of a word
                text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
            return self.find(text)
        if self.lowers:
            text = self.library.normalizer.normalize_str(text)
        if self.foreign().search(text):
            spans = self.library.pre_tokenizer.pre_tokenize_str(text)
            return [text[a:b] for _, (a, b) in spans]
        return self.find(text)


def rare_texts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text, whether it has a byte of RARE_BYTE or more."""
    seen = np.zeros(len(data) + 1, np.int64)
    np.cumsum(data >= RARE_BYTE, out=seen[1:])
    return seen[offsets[1:]] > seen[offsets[:-1]]


@lru_cache(maxsize=4)
def splitter(path: str) -> Splitter:
    return Splitter(path)

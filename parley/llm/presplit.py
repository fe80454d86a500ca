"""Pre-splitting for the word-level BPE vocabulary.

The vocabulary file states its normaliser (NFC, white space runs to one
space, lower case) and its split pattern (contractions, letter runs, single
digits, symbol runs; white space dropped).  For texts made only of
characters below U+0250 both are one lower-casing and one regular
expression over explicit character classes, taken from the Unicode
categories; every other text, and one with a capital whose lower case lies
from U+0250 on, goes through the tokenizers library's own normaliser and
splitter, so that its Unicode tables decide.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

from tokenizers import Tokenizer

_SIMPLE_END = 0x250
# Contraction suffixes of the vocabulary's split pattern.
_CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
_SPACES = "\t\n\x0b\x0c\r \x85\xa0"


def _char_class(first_letter: str) -> str:
    chars = (chr(c) for c in range(_SIMPLE_END) if unicodedata.category(chr(c))[0] == first_letter)
    return "".join(map(re.escape, chars))


def byte_alphabet() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte.

    Printable Latin-1 bytes stand for themselves; the rest take the code
    points from U+0100 on, in order.
    """
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Presplitter:
    """Callable: text to its list of words, lower-cased.

    Words are plain text; the strings of special tokens are kept whole and
    as they are.  Null and empty texts have no words.
    """

    def __init__(self, vocabulary: str):
        self.tokenizer = Tokenizer.from_file(vocabulary)
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = {t.content: i for i, t in added.items()}
        self._special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        letters, digits = _char_class("L"), _char_class("N")
        self._words = re.compile("|".join(
            # letters first: no contraction begins with one
            [f"[{letters}]+", *_CONTRACTIONS, f"[{digits}]",
             f"[^{re.escape(_SPACES)}{letters}{digits}]+"])).findall
        # Some capitals (U+0130, U+018F, ...) have a lower case above the simple range.
        simple = (chr(c) for c in range(_SIMPLE_END) if max(chr(c).lower()) < chr(_SIMPLE_END))
        self._odd = re.compile(f"[^{''.join(map(re.escape, simple))}]").search
        self._alphabet = byte_alphabet()
        self._bytes = {c: b for b, c in enumerate(self._alphabet)}
        self._model = self.tokenizer.model

    def _segment(self, text: str) -> list[str]:
        if not self._odd(text):
            return self._words(text.lower())
        normal = self.tokenizer.normalizer.normalize_str(text)
        pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)
        byte = self._bytes
        return [bytes(byte[c] for c in piece).decode("utf-8") for piece, _ in pieces]

    def ids(self, word: str) -> list[int]:
        """The library's ids of one word that this splitter gave."""
        if word in self.special:
            return [self.special[word]]
        if not word.isascii():
            word = "".join([self._alphabet[b] for b in word.encode("utf-8")])
        return [t.id for t in self._model.tokenize(word)]

    def __call__(self, text: str | None) -> list[str]:
        if not text:
            return []
        if "<|" not in text:
            return self._segment(text)
        words: list[str] = []
        for part in self._special.split(text):
            if part in self.special:
                words.append(part)
            elif part:
                words.extend(self._segment(part))
        return words


class WordCache(dict):
    """word -> encoding, filled by ``encode`` and emptied when full.

    Natural text repeats most of its words, so nearly every word is one
    dictionary lookup.  ``limit`` bounds the bytes held, as entries of a
    short word and its encoding with their overhead; it changes no result.
    """

    ENTRY = 200         # bytes of an entry beside its characters

    def __init__(self, encode: Callable[[str], object], limit: int = 96 << 20):
        super().__init__()
        self.encode, self.limit, self.held = encode, limit, 0

    def __missing__(self, word: str):
        value = self.encode(word)
        if len(word) <= 64:
            if self.held >= self.limit:
                self.clear()
                self.held = 0
            self[word] = value
            self.held += self.ENTRY + len(word) + (len(value) if isinstance(value, bytes) else 0)
        return value

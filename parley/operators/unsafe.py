"""Unsafe terms by one multi-pattern automaton.

All terms, single words and phrases, are compiled into one Aho-Corasick table.
A batch of texts is folded to classes (letters without case or accents,
look-alike letters and digits read as the letters they imitate, any run of
other symbols as one break) and runs through the table in lanes: the text is
cut into pieces of equal length, and one array step moves every piece on by
one symbol.  A state depends on no more symbols than the longest term has, so
each lane first reads that many of the symbols before it, and no match is
lost or seen twice.

A term matches whole words only.  Words of a phrase may be apart by any
symbols but not by other words, and no phrase reaches from one text into the
next.  A look-alike digit or sign is a letter only before a letter (``m0ron``,
``1diot``), so ``idiot$$$`` is the word ``idiot``.  Null texts have a null
result, texts without words none.  Rows are independent of each other.
"""

from __future__ import annotations

import unicodedata
from collections import deque
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.functions.batches import by_pieces

# ---- fixed values ----------------------------------------------------------
UNSAFE_TERMS = (
    "clown", "clowns", "disgusting", "dumb", "filth", "filthy", "garbage", "hate", "idiot", "idiotic", "idiots",
    "imbecile", "kill", "loser", "losers", "moron", "moronic", "morons", "pathetic", "scum", "scumbag",
    "shut up", "stupid", "trash", "vermin", "worthless", "drop dead", "go to hell", "piece of garbage",
    "abschaum", "dummkopf", "halt die klappe", "trottel", "vollidiot",
    "abruti", "connard", "ferme la", "ordure",
    "callate", "estupido", "idiota", "imbecil",
)
# Signs read as letters when a letter follows, and letters of other scripts.
LOOKALIKE_SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
LOOKALIKE_LETTERS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
    "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
}
INVISIBLE = "­​‌‍⁠﻿"
# ----------------------------------------------------------------------------

_BREAK, _OTHER, _SKIP, _END = 0, 27, 28, 29      # 1-26 are the letters a-z
_SYMBOLS = 30
_SIGN = 32                                       # added to the letter a sign may be

_SCHEMA = T.StructType([T.StructField("n_hits", T.LongType()), T.StructField("terms", T.StringType())])


def _letter(char: str) -> int:
    base = unicodedata.normalize("NFKD", char)[0].lower()[:1]
    base = LOOKALIKE_LETTERS.get(base, base)
    return ord(base) - 96 if "a" <= base <= "z" else _OTHER


@lru_cache(1)
def _classes() -> np.ndarray:
    """Class of every code point."""
    table = np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            table[code] = _letter(char)
        elif code >= 0x300 and unicodedata.category(char)[0] == "M":
            table[code] = _SKIP
    for char in INVISIBLE:
        table[ord(char)] = _SKIP
    for char, letter in LOOKALIKE_SIGNS.items():
        table[ord(char)] = _SIGN + ord(letter) - 96
    return table


def fold(texts: list[str]) -> np.ndarray:
    """Classes of the texts one after the other, each as end, words, break.

    Runs of breaks are one break; skipped symbols and the sign flag are gone.
    """
    joined = "".join(f"\x00{t.replace(chr(0), ' ')} " for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    found = _classes()[codes]
    found[codes == 0] = _END
    found = found[found != _SKIP]
    sign = found >= _SIGN
    # What follows a run of signs decides it: the next place that is no sign.
    after = np.where(sign, len(found), np.arange(len(found)))
    after = np.minimum.accumulate(after[::-1])[::-1]
    follows = np.append(found, _BREAK)[after]
    letter = (follows > _BREAK) & (follows <= _OTHER)
    found = np.where(sign, np.where(letter, found - _SIGN, _BREAK), found)
    space = (found == _BREAK) | (found == _END)
    return found[~((found == _BREAK) & np.append(False, space[:-1]))]


class Automaton:
    """Terms as a table of next states, and the terms that end in each state."""

    def __init__(self, terms: tuple[str, ...]):
        self.terms = sorted({" ".join(t.split()) for t in terms if t.strip()})
        patterns = [fold([t])[1:] for t in self.terms]       # word symbols and a break
        patterns = [np.append(_BREAK, p) for p in patterns]  # from a break on
        self.longest = max((len(p) for p in patterns), default=1)
        children: list[dict[int, int]] = [{}]
        ends: list[list[int]] = [[]]
        for number, pattern in enumerate(patterns):
            state = 0
            for symbol in pattern.tolist():
                if symbol not in children[state]:
                    children[state][symbol] = len(children)
                    children.append({})
                    ends.append([])
                state = children[state][symbol]
            ends[state].append(number)
        table = np.zeros((len(children), _SYMBOLS), np.int32)
        fail = [0] * len(children)
        queue = deque([0])
        while queue:
            state = queue.popleft()
            if state:
                table[state] = table[fail[state]]
                ends[state] = ends[state] + ends[fail[state]]
            for symbol, child in children[state].items():
                fail[child] = int(table[state, symbol]) if state else 0
                table[state, symbol] = child
                queue.append(child)
        table[:, _END] = table[0, _BREAK]        # a new text starts at a break
        self.table = table.ravel()
        self.n_ends = np.array([len(e) for e in ends], np.int64)
        self.first_end = np.cumsum(self.n_ends) - self.n_ends
        self.ended = np.array([e for some in ends for e in some], np.int64)

    def hits(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places where terms end, and the terms."""
        n, warm = len(symbols), self.longest
        width = max(warm, int(n ** 0.5))
        lanes = -(-n // width)
        padded = np.full(lanes * width, _END, np.uint8)
        padded[:n] = symbols
        columns = np.ascontiguousarray(padded.reshape(lanes, width).T)
        state = np.zeros(lanes, np.int32)
        for column in columns[width - warm:]:                # the end of the lane before
            state[1:] = self.table[state[1:] * _SYMBOLS + column[:-1]]
        places, states = [], []
        for step, column in enumerate(columns):
            state = self.table[state * _SYMBOLS + column]
            ending = np.flatnonzero(self.n_ends[state])
            places.append(ending * width + step)
            states.append(state[ending])
        place, state = np.concatenate(places), np.concatenate(states)
        many = self.n_ends[state]
        index = np.repeat(self.first_end[state], many) + np.arange(many.sum()) - np.repeat(
            np.cumsum(many) - many, many)
        return np.repeat(place, many), self.ended[index]

    def scan(self, texts: pd.Series) -> pd.DataFrame:
        """Per text: number of matches, and the distinct terms, sorted, comma-separated."""
        texts = texts.reset_index(drop=True)
        present = texts.notna().to_numpy()
        hits = np.zeros(len(texts), np.int64)
        named = np.full(len(texts), "", object)
        if present.any() and self.terms:
            symbols = fold(texts[present].tolist())
            place, term = self.hits(symbols)
            where = np.flatnonzero(present)[np.searchsorted(np.flatnonzero(symbols == _END), place, "right") - 1]
            hits = np.bincount(where, minlength=len(texts))
            pairs = np.unique(where * len(self.terms) + term)
            for row, some in pd.Series(pairs % len(self.terms)).groupby(pairs // len(self.terms)):
                named[row] = ", ".join(self.terms[i] for i in some)
        named[~present] = None
        return pd.DataFrame({"n_hits": pd.Series(hits, dtype="Int64").where(pd.Series(present)), "terms": named})


@lru_cache(8)
def automaton(terms: tuple[str, ...]) -> Automaton:
    """The compiled terms, once a worker."""
    return Automaton(terms)


def with_unsafe_terms(df: DataFrame, text_col: str = "transcription_text",
                      terms: tuple[str, ...] = UNSAFE_TERMS) -> DataFrame:
    """Adds (or replaces) ``n_hits`` and ``terms`` (distinct, sorted, comma-separated)."""
    fixed = tuple(terms)

    @F.pandas_udf(_SCHEMA)
    def scan(texts: pd.Series) -> pd.DataFrame:
        return by_pieces(texts, automaton(fixed).scan, pd.DataFrame({"n_hits": [], "terms": []}))

    found = df.withColumn("_unsafe", scan.asNondeterministic()(F.col(text_col)))
    return found.withColumns({"n_hits": F.col("_unsafe.n_hits"),
                              "terms": F.col("_unsafe.terms")}).drop("_unsafe")


def unsafe_sql(source: str, key: str, text: str, terms: tuple[str, ...] = UNSAFE_TERMS) -> str:
    """The same matches as DuckDB SQL (accents as DuckDB strips them)."""
    signs, letters = "".join(LOOKALIKE_SIGNS), "".join(LOOKALIKE_SIGNS.values())
    folded = (f"translate(strip_accents(regexp_replace(lower({text}), '[\\p{{M}}{INVISIBLE}]', '', 'g')), "
              f"'{''.join(LOOKALIKE_LETTERS)}', '{''.join(LOOKALIKE_LETTERS.values())}')")
    listed = ", ".join(f"('{t}', {len(t.split())})" for t in terms)
    return f"""
WITH unsafe(term, size) AS (VALUES {listed}),
ws AS (SELECT {key}, list_filter(list_transform(regexp_extract_all({folded}, '[\\p{{L}}{signs}]+'),
    lambda x: translate(regexp_replace(x, '[{signs}]+$', ''), '{signs}', '{letters}')), lambda x: x <> '') AS ws FROM {source}),
tok AS (SELECT {key}, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM ws),
grams AS (SELECT {key}, w AS a, w || ' ' || lead(w) OVER p AS b,
    w || ' ' || lead(w) OVER p || ' ' || lead(w, 2) OVER p AS c FROM tok WINDOW p AS (PARTITION BY {key} ORDER BY i)),
hit AS (SELECT {key}, term FROM grams JOIN unsafe ON (size = 1 AND term = a) OR (size = 2 AND term = b) OR (size = 3 AND term = c)),
per AS (SELECT {key}, count(*) AS n, string_agg(DISTINCT term, ', ' ORDER BY term) AS terms FROM hit GROUP BY {key})
SELECT d.{key}, CASE WHEN d.{text} IS NOT NULL THEN coalesce(n, 0) END AS n_hits,
       CASE WHEN d.{text} IS NOT NULL THEN coalesce(terms, '') END AS terms
FROM {source} d LEFT JOIN per ON per.{key} = d.{key}"""

"""Topics from corpus statistics.

*Heavy terms* are words that more than a share of all texts hold: the function
words of whatever languages the corpus has.  They are found exactly in two
passes: every task keeps a Misra-Gries summary of its words, summaries merge
in a tree, and the words that survive are counted exactly.

*Topics* of a text are its best phrases of one to three words between heavy
words, symbols and short words, by C-value: a phrase counts as often as it
occurs, less the mean count of the longer phrases around it, times a weight
for its length.  Phrases of several words must occur twice.

Null and empty texts have no words.  They count as texts in the shares, and
their topics are an empty string.  Repeated rows count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.batches import by_pieces
from parley.operators.enrich import TOPIC_COUNT

# ---- fixed values ----------------------------------------------------------
HEAVY_PERCENT = 10           # heavy: in more than this share of all texts
COUNTERS = 4096              # of one Misra-Gries summary; more when words need it
MERGE_SLOTS = (4096, 64, 1) # summaries merge into so many, level by level
MIN_LETTERS = 3              # shorter words end a phrase
LENGTH_WEIGHTS = (1000, 1585, 2000)     # log2(words + 1), in thousandths
# ----------------------------------------------------------------------------

_BREAK = "."
_SUMMARY = "slot long, term string, n long"


def word_string(text: str | Column) -> Column:
    """Lower-cased words joined by one space, each run of symbols as a full stop."""
    c = F.lower(F.col(text) if isinstance(text, str) else text)
    spaced = F.regexp_replace(c, r"[^\p{L} \t\n\r]+", f" {_BREAK} ")
    return F.trim(F.regexp_replace(spaced, r"[ \t\n\r]+", " "))


def _words_of(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(word_string(text), " "),
                                     lambda w: (w != F.lit("")) & (w != F.lit(_BREAK))))


def shrink(counts: pd.Series, counters: int) -> pd.Series:
    """A summary of at most ``counters`` words.

    Each word loses the count of the first one beyond the limit, so no count
    is lowered by more than (counts taken away) / (counters + 1) in all.
    """
    if len(counts) <= counters:
        return counts
    cut = np.partition(counts.to_numpy(), -counters - 1)[-counters - 1]
    return counts[counts > cut] - cut


def _summaries(counters: int):
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        kept = pd.Series(dtype=np.int64)
        texts = words = 0
        for batch in batches:
            arrays = batch.column(0)
            flat = arrays.flatten()
            texts += len(arrays)
            words += len(flat)
            found = flat.value_counts()
            seen = pd.Series(found.field("counts").to_numpy(), found.field("values").to_pylist(), dtype=np.int64)
            kept = shrink(kept.add(seen, fill_value=0).astype(np.int64), counters)
        slot = TaskContext.get().partitionId()
        # Two more rows carry the totals: no word is empty or a space.
        yield pa.RecordBatch.from_pydict({
            "slot": pa.array([slot] * (len(kept) + 2), pa.int64()),
            "term": pa.array([*kept.index, "", " "], pa.string()),
            "n": pa.array([*kept.tolist(), texts, words], pa.int64())})
    return summarise


def _merge(counters: int):
    def merge(key: tuple, table: pa.Table) -> pa.Table:
        total = table.group_by("term").aggregate([("n", "sum")])
        counts = pd.Series(total["n_sum"].to_numpy(), total["term"].to_pylist(), dtype=np.int64)
        sums = counts[["", " "]]
        kept = pd.concat([shrink(counts.drop(["", " "]), counters), sums])
        return pa.table({"slot": pa.array([key[0].as_py()] * len(kept), pa.int64()),
                         "term": pa.array(kept.index.tolist(), pa.string()),
                         "n": pa.array(kept.tolist(), pa.int64())})
    return merge


def _exact(listed: list[str]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = pa.array(listed, pa.string())
        n = np.zeros(len(listed), np.int64)
        for batch in batches:
            place = pc.index_in(batch.column(0).flatten(), terms).drop_null().to_numpy()
            n += np.bincount(place, minlength=len(listed))
        yield pa.RecordBatch.from_arrays([terms, pa.array(n)], names=["term", "n"])
    return count


def candidates(words: DataFrame, counters: int) -> tuple[int, int, list[str]]:
    """Texts, distinct words summed over texts, and every word that more than
    ``words / (counters + 1)`` texts hold (with others).

    ``words``: one array column.  The list has at most ``counters`` words.
    """
    summary = words.mapInArrow(_summaries(counters), _SUMMARY)
    for slots in MERGE_SLOTS:
        summary = (summary.withColumn("slot", F.col("slot") % slots)
                          .groupBy("slot").applyInArrow(_merge(counters), _SUMMARY))
    found = {r.term: r.n for r in summary.collect()}
    texts, total = found.pop("", 0), found.pop(" ", 0)
    return texts, total, sorted(found)


def heavy_terms(df: DataFrame, text_col: str = "transcription_text",
                percent: int = HEAVY_PERCENT, counters: int = COUNTERS) -> DataFrame:
    """Columns term, n_docs: words that more than ``percent`` % of all rows hold.

    Exact.  The driver holds at most as many candidates as a summary has
    counters: ``counters``, or where texts have so many words that this is too
    few, 100 / ``percent`` times the mean number of distinct words of a text.
    """
    words = df.select(F.coalesce(_words_of(F.col(text_col)), F.array().cast("array<string>")).alias("words"))
    texts, total, found = candidates(words, counters)
    need = -(-100 * total // max(1, percent * texts))
    if need > counters:
        texts, total, found = candidates(words, need)
    return (words.mapInArrow(_exact(found), "term string, n long").groupBy("term")
                 .agg(F.sum("n").alias("n_docs"))
                 .filter(F.col("n_docs") * 100 > F.lit(percent * texts)))


def _distinct(row: np.ndarray, *codes: np.ndarray):
    """Unique (row, codes...) and the place of each entry among them, with counts."""
    if not len(row):
        return np.zeros((0, 1 + len(codes)), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys = np.column_stack((row, *codes))
    order = np.lexsort(keys.T[::-1])
    new = np.any(np.diff(keys[order], axis=0, prepend=keys[order][:1] - 1) != 0, axis=1)
    place = np.empty(len(row), np.int64)
    place[order] = np.cumsum(new) - 1
    return keys[order][new], place, np.bincount(place)


def best_phrases(texts: pd.Series, heavy: frozenset[str], n_topics: int) -> pd.Series:
    """The topics of each text of a batch, from its :func:`word_string`."""
    n = len(texts)
    tokens = texts.reset_index(drop=True).fillna("").str.split(" ").explode()
    row = tokens.index.to_numpy().astype(np.int64)
    code, names = pd.factorize(tokens.to_numpy(), sort=True)
    good = np.array([len(w) >= MIN_LETTERS and w not in heavy for w in names], bool)[code]

    # Start places of phrases of one, two, three words; ids among the distinct ones.
    starts = [np.flatnonzero(good)]
    for size in (2, 3):
        s = starts[-1]
        s = s[s + size - 1 < len(row)]
        starts.append(s[good[s + size - 1] & (row[s] == row[s + size - 1])])
    kinds, inner = [], []                     # distinct phrases, and (phrase, one around it)
    base, ids = 0, []
    for size, s in enumerate(starts, 1):
        keys, place, count = _distinct(row[s], *(code[s + j] for j in range(size)))
        often = np.ones(len(count), bool) if size == 1 else count >= 2
        here = np.full(len(row), -1, np.int64)
        here[s] = np.where(often, np.cumsum(often) - 1 + base, -1)[place]
        full = np.full((int(often.sum()), 5), -1, np.int64)
        full[:, :1 + size], full[:, 4] = keys[often], count[often]
        kinds.append(full)
        for shorter, held in enumerate(ids, 1):
            for j in range(size - shorter + 1):
                a, b = held[s + j], here[s]
                both = (a >= 0) & (b >= 0)
                inner.append(np.column_stack((a[both], b[both])))
        ids.append(here)
        base += len(full)
    phrases = np.concatenate(kinds)
    count = phrases[:, 4]
    pairs = np.unique(np.concatenate(inner), axis=0)
    around = np.bincount(pairs[:, 0], minlength=base).astype(np.int64)
    outer = np.zeros(base, np.int64)
    np.add.at(outer, pairs[:, 0], count[pairs[:, 1]])
    size = (phrases[:, 1:4] >= 0).sum(axis=1)
    many = np.maximum(around, 1)
    score = np.array(LENGTH_WEIGHTS)[size - 1] * (count * many - outer) // many

    order = np.lexsort((phrases[:, 3], phrases[:, 2], phrases[:, 1], -score, phrases[:, 0]))
    ranked = phrases[order, 0]
    top = order[np.arange(base) - np.searchsorted(ranked, ranked) < n_topics]
    named = [" ".join(names[c] for c in p if c >= 0) for p in phrases[top, 1:4]]
    bounds = np.searchsorted(phrases[top, 0], np.arange(n + 1))
    return pd.Series([", ".join(named[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)], dtype=object)


def with_topics(df: DataFrame, heavy: list[str], text_col: str = "transcription_text",
                n_topics: int = TOPIC_COUNT, into: str = "main_topics") -> DataFrame:
    """Adds (or replaces) the column ``into``: the topics, comma-separated.

    ``heavy``: the terms of :func:`heavy_terms`, a list of bounded size.
    """
    stop = frozenset(heavy)

    @F.pandas_udf("string")
    def topics(words: pd.Series) -> pd.Series:
        return by_pieces(words, lambda piece: best_phrases(piece, stop, n_topics), pd.Series([], dtype=object))

    return df.withColumn(into, topics.asNondeterministic()(word_string(text_col)))


def _tokens_sql(source: str, key: str, text: str) -> str:
    return f"""
words AS (SELECT {key}, string_split(trim(regexp_replace(regexp_replace(lower(coalesce({text}, '')),
    '[^\\p{{L}} \\t\\n\\r]+', ' {_BREAK} ', 'g'), '[ \\t\\n\\r]+', ' ', 'g')), ' ') AS ws FROM {source}),
tok AS MATERIALIZED (SELECT {key}, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM words),
heavy AS MATERIALIZED (SELECT w AS term, count(DISTINCT {key}) AS n_docs FROM tok WHERE w NOT IN ('', '{_BREAK}')
  GROUP BY w HAVING count(DISTINCT {key}) * 100 > {HEAVY_PERCENT} * (SELECT count(*) FROM {source}))"""


def heavy_sql(source: str, key: str, text: str) -> str:
    return f"WITH {_tokens_sql(source, key, text)}\nSELECT term, n_docs FROM heavy"


def topics_sql(source: str, key: str, text: str, n_topics: int = TOPIC_COUNT) -> str:
    """The topics as DuckDB SQL; ``key`` is unique in ``source``."""
    one, two, three = LENGTH_WEIGHTS
    return f"""
WITH {_tokens_sql(source, key, text)},
good AS MATERIALIZED (SELECT {key}, i, w FROM tok WHERE length(w) >= {MIN_LETTERS}
  AND w NOT IN (SELECT term FROM heavy)),
near AS MATERIALIZED (SELECT {key}, w AS a,
    CASE WHEN lead(i) OVER p = i + 1 THEN lead(w) OVER p END AS b,
    CASE WHEN lead(i, 2) OVER p = i + 2 THEN lead(w, 2) OVER p END AS c
  FROM good WINDOW p AS (PARTITION BY {key} ORDER BY i)),
f1 AS MATERIALIZED (SELECT {key}, a, count(*) AS n FROM near GROUP BY ALL),
f2 AS MATERIALIZED (SELECT {key}, a, b, count(*) AS n FROM near WHERE b IS NOT NULL GROUP BY ALL HAVING count(*) > 1),
f3 AS MATERIALIZED (SELECT {key}, a, b, c, count(*) AS n FROM near WHERE b IS NOT NULL AND c IS NOT NULL
  GROUP BY ALL HAVING count(*) > 1),
inn AS (
  SELECT {key}, a AS ph, a || ' ' || b AS longer, n FROM f2 UNION SELECT {key}, b, a || ' ' || b, n FROM f2
  UNION SELECT {key}, a, a || ' ' || b || ' ' || c, n FROM f3
  UNION SELECT {key}, b, a || ' ' || b || ' ' || c, n FROM f3
  UNION SELECT {key}, c, a || ' ' || b || ' ' || c, n FROM f3
  UNION SELECT {key}, a || ' ' || b, a || ' ' || b || ' ' || c, n FROM f3
  UNION SELECT {key}, b || ' ' || c, a || ' ' || b || ' ' || c, n FROM f3),
around AS (SELECT {key}, ph, count(*) AS m, CAST(sum(n) AS BIGINT) AS s FROM inn GROUP BY ALL),
cand AS (SELECT {key}, a AS ph, n, {one} AS lw FROM f1
  UNION ALL SELECT {key}, a || ' ' || b, n, {two} FROM f2
  UNION ALL SELECT {key}, a || ' ' || b || ' ' || c, n, {three} FROM f3),
ranked AS (SELECT {key}, ph, lw * (n * coalesce(m, 1) - coalesce(s, 0)) // coalesce(m, 1) AS score
  FROM cand LEFT JOIN around USING ({key}, ph)),
top AS (SELECT * FROM ranked
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY score DESC, ph) <= {n_topics})
SELECT d.{key}, coalesce(string_agg(ph, ', ' ORDER BY score DESC, ph), '') AS topics
FROM {source} d LEFT JOIN top ON top.{key} = d.{key} GROUP BY d.{key}"""

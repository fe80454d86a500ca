"""Extractive summaries by sentence centrality.

The sentences of one text form a graph: two of them are joined by the cosine
of their distinct content words, rarer words weighing more.  The centrality
of a sentence is the damped power iteration over that graph.  The graph is
never laid out as pairs: each round goes from sentences to words and back,
so the work is linear in the words of the text.  A sentence's own share is
taken out on the way, and the cosine removes the bias to long sentences.

All sums are integers (weights are scaled by ``2 ** SCALE_BITS``), so the
result does not depend on the order of rows, batches or additions.  All
texts of a piece of an Arrow batch go through each round at once.

Sentences are picked by centrality, then position.  One that shares more
than half of the words of the shorter of the two with a picked sentence is
redundant and skipped, so a summary can hold fewer than ``k`` sentences.

Null texts and texts without a sentence give a null summary; a text none of
whose sentences has a content word gives its first sentence.  Nothing is
grouped across rows: repeated rows each get the same answer.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.functions.batches import by_pieces
from parley.operators import enrich

# ---- fixed values ----------------------------------------------------------
SCALE_BITS = 15
ROUNDS = 8
DAMPING_PERCENT = 85
# ----------------------------------------------------------------------------

_SCHEMA = T.StructType([
    T.StructField("positions", T.ArrayType(T.IntegerType()), True),
    T.StructField("lead_weight", T.IntegerType(), True)])


def _sums(values: np.ndarray, groups: np.ndarray, n: int) -> np.ndarray:
    """Integer sums per group; ``groups`` ascend."""
    out = np.zeros(n, np.int64)
    if len(values):
        starts = np.flatnonzero(np.diff(groups, prepend=-1))
        out[groups[starts]] = np.add.reduceat(values, starts)
    return out


def _incidences(lines: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row of every sentence, and the distinct (sentence, word-of-row) incidences.

    Returns (row per sentence, sentence per incidence, term per incidence,
    row per term); a term is a word within one row.
    """
    split = lines.str.split("\n").explode()
    row = split.index.to_numpy()
    words = pd.Series(split.str.split(" ").to_numpy()).explode()
    words = words[words.to_numpy() != ""]
    code, names = pd.factorize(words.to_numpy())
    width = max(1, len(names))
    pairs = np.unique(words.index.to_numpy().astype(np.int64) * width + code)
    sentence, word = pairs // width, pairs % width
    terms, term = np.unique(row[sentence] * width + word, return_inverse=True)
    return row, sentence, term, terms // width


def centrality(row: np.ndarray, sentence: np.ndarray, term: np.ndarray, term_row: np.ndarray,
               rounds: int = ROUNDS) -> np.ndarray:
    """Integer centrality of every sentence, at most ``2 ** SCALE_BITS``."""
    n_sent, n_rows = len(row), int(row.max()) + 1
    full = 1 << SCALE_BITS
    holders = np.bincount(term, minlength=len(term_row))            # sentences a term is in
    share = np.bincount(row, minlength=n_rows)[term_row] // np.maximum(holders, 1)
    rarity = np.frexp(share.astype(np.float64))[1].astype(np.int64)  # 1 + floor(log2(share))
    weight = (rarity * rarity)[term]
    norm = _sums(weight, sentence, n_sent)
    unit = np.where(norm > 0, np.floor(full / np.sqrt(np.maximum(norm, 1))), 0).astype(np.int64)
    by_term = np.argsort(term, kind="stable")
    x = np.full(n_sent, full, np.int64)
    for _ in range(rounds):
        sent = (unit * x)[sentence]
        total = _sums(sent[by_term], term[by_term], len(term_row))
        z = unit * _sums(weight * ((total[term] - sent) >> SCALE_BITS), sentence, n_sent)
        top = np.zeros(n_rows, np.int64)
        np.maximum.at(top, row, z)
        near = np.floor(z / np.maximum(top, 1)[row] * full).astype(np.int64)
        x = ((100 - DAMPING_PERCENT) * full + DAMPING_PERCENT * near) // 100
    return x


def _first_of_rows(row: np.ndarray, x: np.ndarray, open_: np.ndarray) -> np.ndarray:
    """The open sentence of the greatest ``x`` of each row, earliest on ties."""
    at = np.flatnonzero(open_)
    order = at[np.lexsort((at, -x[at], row[at]))]
    return order[np.flatnonzero(np.diff(row[order], prepend=-1))]


def pick_central(lines: pd.Series, k: int) -> pd.DataFrame:
    """``lines``: per text one line of content words a sentence.

    Sentence positions in text order, and the centrality of the leading one.
    """
    n = len(lines)
    out = {"positions": [None] * n, "lead_weight": pd.array([pd.NA] * n, dtype="Int32")}
    present = lines.reset_index(drop=True).dropna()
    if present.empty:
        return pd.DataFrame(out)
    row, sentence, term, term_row = _incidences(present)
    n_sent = len(row)
    x = centrality(row, sentence, term, term_row)
    size = np.bincount(sentence, minlength=n_sent)
    first = np.searchsorted(row, row)
    wordless = np.bincount(row, size, int(row.max()) + 1)[row] == 0
    open_ = (size > 0) | (wordless & (np.arange(n_sent) == first))
    picked = []
    for _ in range(k):                       # k picks of every row at once
        best = _first_of_rows(row, x, open_)
        if not len(best):
            break
        picked.append(best)
        open_[best] = False
        chosen = np.zeros(n_sent, bool)
        chosen[best] = True
        held = np.zeros(len(term_row), bool)  # terms of the row's new pick
        held[term[chosen[sentence]]] = True
        shared = _sums(held[term].astype(np.int64), sentence, n_sent)
        pick_size = np.zeros(int(row.max()) + 1, np.int64)
        pick_size[row[best]] = size[best]
        open_ &= 2 * shared <= np.minimum(size, pick_size[row])
    lead = picked[0]
    all_picked = np.sort(np.concatenate(picked))
    bounds = np.searchsorted(row[all_picked], np.arange(n + 1))
    place = (all_picked - first[all_picked]).tolist()
    here = np.zeros(n, bool)
    here[present.index] = True
    out["positions"] = [place[a:b] if h else None
                        for a, b, h in zip(bounds, bounds[1:], here, strict=False)]
    weights = np.zeros(n, np.int64)
    weights[row[lead]] = x[lead]
    out["lead_weight"] = pd.Series(weights, dtype="Int32").where(pd.Series(here))
    return pd.DataFrame(out)


def with_central_summary(df: DataFrame, text_col: str = "transcription_text",
                         k: int = enrich.SUMMARY_SENTENCES) -> DataFrame:
    """Adds ``summary`` and ``lead_weight``, the centrality of its best sentence.

    Columns of these names in ``df`` are replaced.
    """
    @F.pandas_udf(_SCHEMA)
    def central(lines: pd.Series) -> pd.DataFrame:
        none = pd.DataFrame({"positions": [], "lead_weight": []})
        return by_pieces(lines, lambda piece: pick_central(piece, k), none)

    # Non-deterministic by mark only: a filter on the summary must not run it twice.
    sents = enrich.sentences(text_col)
    staged = df.withColumn("_sents", sents)
    staged = staged.withColumn("_central", central.asNondeterministic()(
        enrich.content_token_lines(F.col("_sents"))))
    positions = F.coalesce(F.col("_central.positions"), F.array().cast("array<int>"))
    return staged.withColumns({"summary": enrich._pick(F.col("_sents"), positions),
                               "lead_weight": F.col("_central.lead_weight")}).drop("_sents", "_central")


def summary_sql(source: str, keys: str, text: str, k: int = enrich.SUMMARY_SENTENCES) -> str:
    """The same summaries as DuckDB SQL: one row a text of ``source``.

    ``keys`` names one unique key column.
    """
    full = 1 << SCALE_BITS
    rounds = [f"""x0 AS MATERIALIZED (SELECT {keys}, si, CAST({full} AS BIGINT) AS x FROM s)"""]
    for i in range(ROUNDS):
        rounds.append(f"""
m{i} AS MATERIALIZED (SELECT inc.*, u.unit, u.unit * x.x AS sent FROM inc JOIN u USING ({keys}, si) JOIN x{i} x USING ({keys}, si)),
y{i} AS MATERIALIZED (SELECT {keys}, w, CAST(sum(sent) AS BIGINT) AS total FROM m{i} GROUP BY ALL),
z{i} AS MATERIALIZED (SELECT {keys}, si, any_value(unit) * CAST(sum(weight * ((total - sent) // {full})) AS BIGINT) AS z
  FROM m{i} JOIN y{i} USING ({keys}, w) GROUP BY {keys}, si),
t{i} AS MATERIALIZED (SELECT {keys}, max(z) AS top FROM z{i} GROUP BY {keys}),
x{i + 1} AS MATERIALIZED (SELECT s.{keys}, s.si,
    CAST(({100 - DAMPING_PERCENT} * {full} + {DAMPING_PERCENT}
          * CAST(floor(coalesce(z, 0) / greatest(coalesce(top, 0), 1) * {full}) AS BIGINT)) // 100 AS BIGINT) AS x
  FROM s LEFT JOIN z{i} USING ({keys}, si) LEFT JOIN t{i} ON t{i}.{keys} = s.{keys})""")
    picks = [f"""
open0 AS MATERIALIZED (SELECT s.{keys}, s.si, x, coalesce(size, 0) AS size FROM s JOIN x{ROUNDS} USING ({keys}, si)
  LEFT JOIN u USING ({keys}, si)
  WHERE size > 0 OR (s.si = 0 AND s.{keys} NOT IN (SELECT {keys} FROM u)))"""]
    for i in range(k):
        picks.append(f"""
p{i} AS MATERIALIZED (SELECT {keys}, si, x, size FROM open{i}
  QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY x DESC, si) = 1),
sh{i} AS MATERIALIZED (SELECT a.{keys}, a.si, count(*) AS shared FROM inc a JOIN p{i} p ON p.{keys} = a.{keys}
  JOIN inc b ON b.{keys} = p.{keys} AND b.si = p.si AND b.w = a.w GROUP BY ALL),
open{i + 1} AS MATERIALIZED (SELECT o.* FROM open{i} o JOIN p{i} p ON p.{keys} = o.{keys}
  LEFT JOIN sh{i} sh ON sh.{keys} = o.{keys} AND sh.si = o.si
  WHERE o.si <> p.si AND 2 * coalesce(shared, 0) <= least(o.size, p.size))""")
    taken = " UNION ALL ".join(f"SELECT {keys}, si, x, {i} AS turn FROM p{i}" for i in range(k))
    return f"""
WITH ss AS (
  SELECT {keys}, list_filter(list_transform(regexp_extract_all({text}, '{enrich.SENTENCE_PATTERN}'),
                                            lambda x: trim(x)), lambda x: x <> '') AS sents FROM {source}),
s AS MATERIALIZED (SELECT {keys}, unnest(sents) AS sent, generate_subscripts(sents, 1) - 1 AS si FROM ss),
ct AS (SELECT {keys}, si, unnest(regexp_extract_all(lower(sent), '\\p{{L}}{{{enrich.CONTENT_MIN_LEN},}}')) AS w FROM s),
di AS MATERIALIZED (SELECT DISTINCT {keys}, si, w FROM ct),
ns AS (SELECT {keys}, count(*) AS n FROM s GROUP BY {keys}),
ts AS (SELECT {keys}, w, count(*) AS holders FROM di GROUP BY ALL),
inc AS MATERIALIZED (SELECT {keys}, si, w, length(bin(n // holders)) * length(bin(n // holders)) AS weight
  FROM di JOIN ts USING ({keys}, w) JOIN ns USING ({keys})),
u AS MATERIALIZED (SELECT {keys}, si, count(*) AS size,
    CAST(floor({full} / sqrt(CAST(sum(weight) AS BIGINT))) AS BIGINT) AS unit FROM inc GROUP BY ALL),
{",".join(rounds)},
{",".join(picks)},
taken AS ({taken})
SELECT d.{keys}, string_agg(s.sent, ' ' ORDER BY s.si) AS summary,
       CAST(max(taken.x) FILTER (WHERE turn = 0) AS INTEGER) AS lead_weight
FROM {source} d LEFT JOIN taken ON taken.{keys} = d.{keys}
LEFT JOIN s ON s.{keys} = taken.{keys} AND s.si = taken.si
GROUP BY d.{keys}"""

"""Rule-based enrichment of transcripts: sentiment, summary, analysis.

These re-aim hosted model calls at deterministic, reproducible Spark
operators with the same inputs and outputs:

* sentiment  – lexicon hits counted per row with a literal map (no join,
  no shuffle); label positive / negative / mixed / neutral.
* summary    – extractive: sentences scored by the document frequency of
  their content words, best ``k`` kept in original order.
* analysis   – speakers (names introduced in the text, else Speaker 1/2),
  main topics (most frequent content words), tone, one-sentence summary, as
  the columns that a structured model response is parsed into.

All per-row work runs on the text of one row; nothing is grouped across
rows, so a large share of rows under one key costs nothing extra.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley import config
from parley.functions import json as jfn
from parley.functions.batches import by_pieces
from parley.functions.time import run_timestamp

# ---- fixed values ----------------------------------------------------------
# Sentiment lexicon (en, de, fr, es): term -> weight.
POSITIVE_TERMS = {
    "good": 1, "great": 2, "excellent": 2, "thanks": 1, "thank": 1, "happy": 2, "glad": 1,
    "perfect": 2, "yes": 1, "love": 2, "nice": 1, "helpful": 2, "resolved": 2, "appreciate": 2,
    "gut": 1, "danke": 1, "ja": 1, "super": 1, "toll": 1, "prima": 1, "gerne": 1,
    "bien": 1, "bon": 1, "merci": 1, "oui": 1, "parfait": 2,
    "bueno": 1, "gracias": 1, "perfecto": 2, "excelente": 2,
}
NEGATIVE_TERMS = {
    "bad": 1, "terrible": 2, "problem": 1, "issue": 1, "wrong": 1, "angry": 2, "no": 1,
    "not": 1, "never": 1, "cancel": 2, "complaint": 2, "unhappy": 2, "broken": 1, "refund": 1,
    "schlecht": 1, "nein": 1, "nicht": 1, "leider": 1, "falsch": 1, "kein": 1,
    "mal": 1, "non": 1, "pas": 1, "jamais": 1, "mauvais": 1, "problème": 1,
    "malo": 1, "problema": 1, "nunca": 1,
}
# Phrases that introduce a speaker's name, followed by a capitalised word.
NAME_INTRO_PATTERN = (r"(?:[Mm]y name is|[Tt]his is|[Ii] am|[Ii]ch bin|[Jj]e suis|"
                      r"[Jj]e m'appelle|[Mm]e llamo|[Ss]oy) (\p{Lu}\p{Ll}+)")
NAME_INTRO_LOOKAHEAD = "(?=[IJMSTijmst])"   # first letters of the phrases above
# Sentences: a run without terminators, plus its terminators.
SENTENCE_PATTERN = r"[^.!?\n]+[.!?]*"
CONTENT_MIN_LEN = 4          # content words have at least four letters
SUMMARY_SENTENCES = 2
TOPIC_COUNT = 3
TONE_QUESTIONS = 3           # >= 3 question marks: inquisitive
TONE_FORMAL_WORDS = 15       # >= 15 words per sentence on average: formal
# ----------------------------------------------------------------------------


def _literal_map(d: dict[str, int]) -> Column:
    items = []
    for k in sorted(d):
        items += [F.lit(k), F.lit(int(d[k]))]
    return F.create_map(*items)


def _word_regex(words) -> str:
    """Whole lower-cased tokens equal to one of ``words``: a letter run
    bounded by non-letters, i.e. exactly the tokens of :func:`tokens`.  The
    leading lookahead on first letters lets the engine reject most positions
    with one class test instead of trying every alternative."""
    import re
    alt = "|".join(re.escape(w) for w in sorted(words, key=lambda w: (-len(w), w)))
    firsts = "".join(sorted({re.escape(w[0]) for w in words}))
    return rf"(?<!\p{{L}})(?=[{firsts}])(?:{alt})(?!\p{{L}})"


def lexicon_tokens(text: Column, positive: dict[str, int], negative: dict[str, int]) -> Column:
    """Every lexicon token in ``text`` (a handful per text), in one regex
    scan over the lower-cased text."""
    return F.regexp_extract_all(F.lower(text), F.lit(_word_regex({**positive, **negative})), 0)


def weight_sum(tokens: Column, terms: dict[str, int]) -> Column:
    """Sum of the weights of ``tokens`` found in ``terms``."""
    m = _literal_map(terms)
    return F.aggregate(tokens, F.lit(0), lambda a, w: a + F.coalesce(F.try_element_at(m, w), F.lit(0)))


def sentiment_label(pos: Column, neg: Column) -> Column:
    """neutral: no hits; mixed: both present and neither twice the other."""
    return (F.when((pos == 0) & (neg == 0), F.lit("neutral"))
             .when((pos > 0) & (neg > 0) & (pos < neg * 2) & (neg < pos * 2), F.lit("mixed"))
             .when(pos > neg, F.lit("positive"))
             .otherwise(F.lit("negative")))


def with_sentiment(df: DataFrame, text_col: str = "transcription_text",
                   positive: dict[str, int] = POSITIVE_TERMS,
                   negative: dict[str, int] = NEGATIVE_TERMS,
                   keep_scores: bool = False) -> DataFrame:
    """Adds ``sentiment`` (and ``pos_hits``/``neg_hits`` when asked).

    The lexicon is a fixed, small literal map: no broadcast, join or shuffle.
    """
    text = F.col(text_col)
    # The token array is its own column: both sums read it, and Catalyst
    # keeps a non-trivial expression used twice in its own projection, so the
    # scan runs once per row.
    out = (df.withColumn("_lex", lexicon_tokens(text, positive, negative))
             .withColumns({"pos_hits": F.coalesce(weight_sum(F.col("_lex"), positive), F.lit(0)),
                           "neg_hits": F.coalesce(weight_sum(F.col("_lex"), negative), F.lit(0))})
             .drop("_lex"))
    out = out.withColumn("sentiment", F.when(text.isNotNull(),
                                             sentiment_label(F.col("pos_hits"), F.col("neg_hits"))))
    return out if keep_scores else out.drop("pos_hits", "neg_hits")


def sentences(text: str | Column) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    raw = F.regexp_extract_all(c, F.lit(SENTENCE_PATTERN), 0)
    return F.filter(F.transform(raw, lambda s: F.trim(s)), lambda s: s != F.lit(""))


# --- the one Python step: term counting, vectorised over Arrow batches -------
_RANK_SCHEMA = T.StructType([
    T.StructField("top_sentences", T.ArrayType(T.IntegerType()), True),
    T.StructField("topics", T.ArrayType(T.StringType()), True),
    T.StructField("best_sentence", T.IntegerType(), True)])


def _rank_batch(sent_tokens: pd.Series, k: int, n_topics: int) -> pd.DataFrame:
    """A whole Arrow batch at once: one line per sentence, its content tokens
    separated by single spaces (letters only, so splitting is exact).

    Tokens of all rows are counted per row by one sort; sentence scores are
    sums of those counts; the best of each row are picked by one more sort.
    """
    n = len(sent_tokens)
    out = pd.DataFrame({"top_sentences": [None] * n, "topics": [None] * n,
                        "best_sentence": pd.array([pd.NA] * n, dtype="Int32")})
    present = sent_tokens.reset_index(drop=True).dropna()
    if present.empty:
        return out
    lines = present.str.split("\n").explode()
    row = lines.index.to_numpy()
    first = np.searchsorted(row, row)                       # rows ascend
    position = np.arange(len(row)) - first
    tokens = pd.Series(lines.str.split(" ").to_numpy()).explode()
    tokens = tokens[tokens.to_numpy() != ""]
    sentence = tokens.index.to_numpy()
    code, words = pd.factorize(tokens.to_numpy(), sort=True)
    pairs, place, count = np.unique(row[sentence] * max(1, len(words)) + code,
                                    return_inverse=True, return_counts=True)
    score = np.bincount(sentence, count[place], len(row)).astype(np.int64)

    def per_row(rows: np.ndarray, *sort_by: np.ndarray, most: int) -> np.ndarray:
        """The first ``most`` entries of each row in the order of ``sort_by``."""
        order = np.lexsort((*reversed(sort_by), rows))
        ranked = rows[order]
        return order[np.arange(len(order)) - np.searchsorted(ranked, ranked) < most]

    def lists(rows: np.ndarray, values) -> list:
        bounds = np.searchsorted(rows, np.arange(n + 1))
        return [list(values[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]

    best = per_row(row, -score, position, most=k)
    lead = per_row(row, -score, position, most=1)
    in_text = best[np.lexsort((position[best], row[best]))]
    topic_row, topic = pairs // max(1, len(words)), pairs % max(1, len(words))
    top = per_row(topic_row, -count, topic, most=n_topics)
    here = present.index.to_numpy()
    tops = lists(row[in_text], position[in_text].tolist())
    names = lists(topic_row[top], [words[t] for t in topic[top]])
    for i in here:
        out.at[i, "top_sentences"], out.at[i, "topics"] = tops[i], names[i]
    out.loc[row[lead], "best_sentence"] = position[lead]
    return out


def _make_ranker(k: int, n_topics: int):
    @F.pandas_udf(_RANK_SCHEMA)
    def rank(sent_tokens: pd.Series) -> pd.DataFrame:
        # A batch is bounded in rows; a piece is in letters too, and counting
        # takes many times the letters.
        return by_pieces(sent_tokens, lambda piece: _rank_batch(piece, k, n_topics),
                         _rank_batch(sent_tokens.iloc[:0], k, n_topics))
    # Marked non-deterministic so Catalyst never copies the call into a
    # pushed-down filter: a filter on summary / topics would otherwise run
    # the Python step twice.  (The function itself is deterministic.)
    return rank.asNondeterministic()


def content_token_lines(sents: Column) -> Column:
    """Sentences -> one string: per sentence its content tokens (lower-cased
    letter runs of at least ``CONTENT_MIN_LEN``) joined by spaces, sentences
    joined by newlines.  A flat string crosses to Python far cheaper than
    nested arrays."""
    pattern = rf"\p{{L}}{{{CONTENT_MIN_LEN},}}"
    per_sentence = F.transform(sents, lambda s: F.array_join(
        F.regexp_extract_all(F.lower(s), F.lit(pattern), 0), " "))
    return F.when(F.size(sents) > 0, F.array_join(per_sentence, "\n"))


def with_text_stats(df: DataFrame, text_col: str = "transcription_text",
                    k: int = SUMMARY_SENTENCES, n_topics: int = TOPIC_COUNT) -> DataFrame:
    """Adds ``_sents`` (array), ``_stats`` (top sentence positions, topics).

    Sentence splitting and tokenising stay in the JVM; only counting terms
    of one row happens in Python, on Arrow batches.
    """
    sents = sentences(text_col)
    ranker = _make_ranker(k, n_topics)
    with_sents = df.withColumn("_sents", sents)
    stats = ranker(content_token_lines(F.col("_sents")))
    # No sentences: no summary, no topics.
    return with_sents.withColumn("_stats", F.when(F.size("_sents") > 0, stats).otherwise(
        F.struct(F.array().cast("array<int>").alias("top_sentences"),
                 F.array().cast("array<string>").alias("topics"),
                 F.lit(None).cast("int").alias("best_sentence"))))


def _pick(sents: Column, positions: Column, sep: str = " ") -> Column:
    picked = F.transform(positions, lambda i: F.element_at(sents, i + F.lit(1)))
    return F.when(F.size(positions) > 0, F.array_join(picked, sep))


def introduced_names(text: str | Column) -> Column:
    """Capitalised names following an introduction phrase, in order."""
    c = F.col(text) if isinstance(text, str) else text
    # The lookahead only skips positions that cannot start an introduction.
    return F.regexp_extract_all(c, F.lit(NAME_INTRO_LOOKAHEAD + NAME_INTRO_PATTERN), 1)


def speaker_names(names: Column) -> tuple[Column, Column]:
    """Speaker 1 / 2 from :func:`introduced_names` (a column, so the scan is
    not repeated for the second speaker)."""
    first = F.try_element_at(names, F.lit(1))
    second = F.try_element_at(F.filter(names, lambda x: x != first), F.lit(1))
    return (F.coalesce(first, F.lit(config.DEFAULT_SPEAKERS[0])),
            F.coalesce(second, F.lit(config.DEFAULT_SPEAKERS[1])))


def tone(sentiment: Column, text: Column, n_sents: Column) -> Column:
    questions = F.length(text) - F.length(F.replace(text, F.lit("?"), F.lit("")))
    n_words = F.regexp_count(text, F.lit(r"\p{L}+"))   # = number of tokens
    return (F.when(sentiment == "negative", F.lit("tense"))
             .when(sentiment == "positive", F.lit("friendly"))
             .when(sentiment == "mixed", F.lit("mixed"))
             .when(questions >= TONE_QUESTIONS, F.lit("inquisitive"))
             .when(n_words >= n_sents * TONE_FORMAL_WORDS, F.lit("formal"))
             .otherwise(F.lit("casual")))


def with_tone(df: DataFrame, text_col: str = "transcription_text") -> DataFrame:
    """Adds ``sentiment`` and ``conversation_tone``: counts only, no ranking
    and so no Python step."""
    df = with_sentiment(df, text_col).withColumn("_sents", sentences(text_col))
    return df.withColumn("conversation_tone", tone(F.col("sentiment"), F.col(text_col),
                                                   F.size("_sents"))).drop("_sents")


def enrich(transcripts: DataFrame, run_ts: Column | None = None,
           text_col: str = "transcription_text") -> DataFrame:
    """Gold rows: transcripts with text, plus sentiment, summary, the five
    analysis fields (see :data:`jfn.ANALYSIS_FIELDS`) and a timestamp."""
    base = transcripts.filter(F.col(text_col).isNotNull())
    cols = base.columns
    df = with_sentiment(base, text_col)
    df = with_text_stats(df, text_col)
    df = df.withColumn("_names", introduced_names(text_col))
    sents, top = F.col("_sents"), F.col("_stats.top_sentences")
    s1, s2 = speaker_names(F.col("_names"))
    analysis = dict(zip(jfn.ANALYSIS_FIELDS, (
        s1, s2, F.array_join(F.col("_stats.topics"), ", "),
        tone(F.col("sentiment"), F.col(text_col), F.size(sents)),
        F.try_element_at(sents, F.col("_stats.best_sentence") + F.lit(1))), strict=True))
    df = df.withColumns({"summary": _pick(sents, top), **analysis})
    ts = run_timestamp(run_ts)
    return df.select(*cols, "sentiment", "summary", *jfn.ANALYSIS_FIELDS,
                     ts.alias("enriched_timestamp"))

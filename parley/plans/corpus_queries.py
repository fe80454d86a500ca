"""Registered queries that learn from the whole corpus first, and their SQL.

Unlike those of ``catalog`` they run Spark jobs while their DataFrame is built:
a list of bounded size, or the rounds of a fixed point, must be known before
the last step can be planned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from parley.operators import polarity, topics
from parley.plans.catalog import Query, t

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str):
    def deco(fn: Query) -> Query:
        QUERIES[name], ORACLES[name] = fn, oracle.strip()
        return fn
    return deco


@register("heavy_terms", topics.heavy_sql("documents", "doc_id", "text"))
def q_heavy_terms(spark, root):
    return topics.heavy_terms(t(spark, root, "documents").select("text"), "text")


@register("topic_phrases", topics.topics_sql("documents", "doc_id", "text"))
def q_topic_phrases(spark, root):
    docs = t(spark, root, "documents").select("doc_id", "text")
    heavy = [r.term for r in topics.heavy_terms(docs, "text").collect()]
    return topics.with_topics(docs, heavy, "text", into="topics").select("doc_id", "topics")


def _lexicon(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    heavy = [r.term for r in topics.heavy_terms(docs, "text").collect()]
    return polarity.induce(polarity.word_graph(docs, heavy, "text")), heavy


@register("induced_lexicon", polarity.lexicon_sql("documents", "doc_id", "text"))
def q_induced_lexicon(spark, root):
    return _lexicon(t(spark, root, "documents").select("doc_id", "text"))[0]


@register("induced_sentiment", polarity.scores_sql("documents", "doc_id", "text"))
def q_induced_sentiment(spark, root):
    docs = t(spark, root, "documents").select("doc_id", "text")
    lexicon, heavy = _lexicon(docs)
    return polarity.score_texts(docs, lexicon, heavy, ("doc_id",), "text")

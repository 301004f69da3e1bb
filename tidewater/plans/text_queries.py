"""Word-count family over ``documents.text``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.text import java_split
from tidewater.operators import keyed
from tidewater.plans.registry import query, table

STOPWORD = "the"

_TOKENS_SQL = """
select doc_id, unnest(string_split(rtrim(text, ' '), ' ')) as word
from documents
where not (text <> '' and rtrim(text, ' ') = '')
"""


def doc_tokens(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", F.explode(java_split("text")).alias("word"))


@query("flatmap_words", f"select doc_id, word from ({_TOKENS_SQL})")
def flatmap_words(spark, sf):
    return doc_tokens(spark, sf)


@query("flatmap_word_one", f"select word, cast(1 as bigint) as one from ({_TOKENS_SQL})")
def flatmap_word_one(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select(F.explode(java_split("text")).alias("word"), F.lit(1).cast("long").alias("one"))


@query("wordcount", f"select word, cast(count(*) as bigint) as n from ({_TOKENS_SQL}) group by word")
def wordcount(spark, sf):
    return keyed.keyed_count(doc_tokens(spark, sf), "word", out="n")


@query("filter_stopword", f"select doc_id, word from ({_TOKENS_SQL}) where word <> '{STOPWORD}'")
def filter_stopword(spark, sf):
    return doc_tokens(spark, sf).where(F.col("word") != F.lit(STOPWORD))


@query("keyed_reduce",
       f"select word, cast(count(*) as bigint) as n from ({_TOKENS_SQL}) where word <> '{STOPWORD}' group by word")
def keyed_reduce(spark, sf):
    ones = filter_stopword(spark, sf).select("word", F.lit(1).cast("long").alias("one"))
    return keyed.reduce_sum(ones, "word", "one", "n")

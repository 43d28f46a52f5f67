"""Searches of all texts and vectors for many questions at once: every row whose id is divisible by 100 asks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import identity, patterns
from .registry import query, read

_STOP = ("what", "is", "the", "of", "in", "an", "a", "and", "to", "la", "de", "der", "die")
_WORDS = rf"""
with w as (select doc_id as question, unnest(ws) as word, generate_subscripts(ws, 1) as i from (select doc_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') as ws from documents where doc_id % 100 = 0)),
f as (select question, word, min(i) as i from w where length(word) > 1 and word not in {_STOP} group by 1, 2),
q as (select question, word from (select *, row_number() over (partition by question order by i) as r from f) where r <= 3),
k as (select question, doc_id, count(*) as n_words from q join (select doc_id, lower(text) as t from documents) d on contains(t, word) group by 1, 2),
kr as (select *, row_number() over (partition by question order by n_words desc, doc_id) as rank from k)
"""


def _words(docs: DataFrame) -> DataFrame:
    return patterns.question_words(docs.where("doc_id % 100 = 0"), "doc_id", "text", _STOP)


@query(_WORDS + "select question, doc_id, n_words, rank from kr where rank <= 20")
def question_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three words of each question, and the 20 texts that hold most of them; one pass over the texts for all questions."""
    docs = read(spark, sf_dir, "documents")
    return patterns.answers(_words(docs), docs, "doc_id", "text", 20)


@query(_WORDS + """
, v as (select question, id, rank from (select a.vec_id as question, b.vec_id as id, row_number() over (partition by a.vec_id order by round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 9) desc, b.vec_id) as rank
  from embeddings a, embeddings b where a.vec_id % 100 = 0) where rank <= 50),
u as (select question, doc_id as id, 1.0 / (60 + rank) as s, 'keyword' as m from kr where rank <= 50 union all select question, id, 1.0 / (60 + rank), 'vector' from v)
select question, id, round(sum(s), 9) as score, case when count(*) = 2 then 'hybrid' else min(m) end as method from u group by 1, 2
""")
def hybrid_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each question the 50 best texts by words and the 50 nearest vectors to its own, fused by their ranks; what both have is hybrid."""
    docs, e = read(spark, sf_dir, "documents"), read(spark, sf_dir, "embeddings")
    by_word = patterns.answers(_words(docs), docs, "doc_id", "text", 50).select("question", F.col("doc_id").alias("id"), "rank", F.lit("keyword").alias("method"))
    near = identity.nearest_rows(e.where("vec_id % 100 = 0"), e, "vec_id", "embedding", 50)
    by_vector = near.select(F.col("vec_id").alias("question"), F.col("nearest_id").alias("id"), "rank", F.lit("vector").alias("method"))
    fused = by_word.unionByName(by_vector).groupBy("question", "id").agg(F.round(F.sum(1 / (60 + F.col("rank"))), 9).alias("score"), F.count("*").alias("k"), F.min("method").alias("m"))
    return fused.select("question", "id", "score", F.when(F.col("k") == 2, "hybrid").otherwise(F.col("m")).alias("method"))


@query("""
with v as (select distinct lower(w) as pattern, kind, name from (select unnest(string_split(p_name, ' ')) as w, 'thing' as kind, p_name as name from part union all select p_type, 'type', p_type from part
  union all select left(n_name, 3), 'nation', n_name from nation)),
d as (select doc_id, lower(text) as t from documents where text is not null)
select doc_id, kind, string_agg(distinct name, ',' order by name) as names, sum((length(t) - length(replace(t, pattern, ''))) // length(pattern))::bigint as n from d join v on contains(t, pattern) group by 1, 2
""")
def text_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of a vocabulary made of names each text holds, by kind, found in one pass."""
    words = read(spark, sf_dir, "part").select(F.explode(F.split("p_name", " ")).alias("pattern"), F.lit("thing").alias("kind"), F.col("p_name").alias("name"))
    types = read(spark, sf_dir, "part").select(F.col("p_type").alias("pattern"), F.lit("type").alias("kind"), F.col("p_type").alias("name"))
    nations = read(spark, sf_dir, "nation").select(F.substring("n_name", 1, 3).alias("pattern"), F.lit("nation").alias("kind"), F.col("n_name").alias("name"))
    return patterns.fingerprints(read(spark, sf_dir, "documents"), "doc_id", "text", words.unionByName(types).unionByName(nations))

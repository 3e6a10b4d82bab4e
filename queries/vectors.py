"""Page concatenation, embeddings, nearest chunks and answer prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagesmith.cluster import spread
from pagesmith.functions.replies import ANSWER_PROMPT
from pagesmith.functions.replies import build_answer_prompt
from pagesmith.operators import vectors as V
from pagesmith.plans import answer as A

from .common import quote, table
from .extraction import _chunks_sql


def concat_pages(spark, sf):
    joined = V.concat_pages(table(spark, sf, "conversations"), "conv_id", "turn")
    return joined.select("conv_id", "part", "text")


def _documents(spark, sf):
    return spread(table(spark, sf, "documents").select("doc_id", "text"))


def embed_chunks(spark, sf):
    rows = V.hashed_words(_documents(spark, sf), "doc_id")
    return rows.select("doc_id", "dim", F.round("weight", 9).alias("weight"))


def _length_vectors(texts: list[str]) -> list[list[float]]:
    return [[float(len(t)), float(t.count(" ")), float(t.count("\n"))] for t in texts]


def embed_provider(spark, sf):
    """A Python embedding function called batch by batch over all partitions."""
    out = V.embed_with(_documents(spark, sf), _length_vectors)
    return out.select("doc_id", *[F.col("embedding")[i].alias(f"d{i}") for i in range(3)])


def _centroids(vectors):
    """One question per label: the mean vector of the label."""
    cells = vectors.select("label", F.posexplode("embedding").alias("i", "x"))
    means = cells.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.sort_array(F.collect_list(F.struct("i", "x")))
    whole = means.groupBy("label").agg(F.transform(ordered, lambda c: c["x"]).alias("embedding"))
    return whole.select(F.col("label").alias("question_id"), "embedding")


def vector_topk(spark, sf):
    vectors = table(spark, sf, "embeddings")
    hits = V.vector_topk(vectors, _centroids(vectors), k=10)
    return hits.withColumn("distance", F.round("distance", 6))


def _benchmark_questions(spark, sf):
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("question_id"), F.col("text").alias("question"))


def _document_vectors(spark, sf):
    docs = _documents(spark, sf).withColumnRenamed("doc_id", "vec_id")
    return docs, V.embedded(docs, "vec_id")


def stuff_context(spark, sf):
    """Whole documents as chunks: the four nearest to each benchmark text, as a filled prompt."""
    docs, vectors = _document_vectors(spark, sf)
    questions = _benchmark_questions(spark, sf)
    asked = V.embedded(questions, "question_id", "question")
    context = V.stuff_context(V.vector_topk(vectors, asked), docs)
    prompt = build_answer_prompt(F.col("context"), F.col("question"))
    return context.join(questions, "question_id").select("question_id", F.md5(prompt).alias("prompt_md5"))


def answer_documents(spark, sf):
    """The whole answer job with default chunking."""
    index = A.index_documents(_documents(spark, sf))
    return A.answer_prompts(index, _benchmark_questions(spark, sf))


def _odd_texts(every: str = "") -> str:
    """SQL: whole texts, a quarter of them without any word and half of them beginning with other scripts."""
    return f"""CASE doc_id % 4 WHEN 0 THEN regexp_replace(text, '[\\p{{L}}\\p{{N}}]+', '+'{every}) WHEN 1 THEN '日本語 ' || text
WHEN 2 THEN 'Über ' || text ELSE text END"""


def index_all_texts(spark, sf):
    """Texts without an ASCII word, or without any word, stay in the index."""
    docs = table(spark, sf, "documents").select("doc_id", F.expr(_odd_texts().replace("\\", "\\\\")).alias("text"))
    used = F.size(F.filter("embedding", lambda x: x > 0))
    length = F.round(F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x * x), 9)
    return A.index_documents(docs).select("doc_id", "chunk_idx", used.alias("n_dims"), length.alias("length"))


QUERIES = {
    f.__name__: f
    for f in (concat_pages, index_all_texts, embed_chunks, embed_provider, vector_topk, stuff_context, answer_documents)
}


def _hashed_sql(name: str, source: str, key: str) -> str:
    return f"""{name}_w AS (SELECT {key} AS k, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS w FROM {source}),
{name}_h AS (SELECT k, substr(md5(w), 1, 3) AS h FROM {name}_w),
{name}_d AS (SELECT k, ((instr('0123456789abcdef', h[1]) - 1) * 256 + (instr('0123456789abcdef', h[2]) - 1) * 16
                + instr('0123456789abcdef', h[3]) - 1) % 64 AS dim, count(*) AS n FROM {name}_h GROUP BY ALL),
{name} AS (SELECT k, dim, n / sqrt(sum(n * n) OVER (PARTITION BY k)) AS weight FROM {name}_d)"""


def _pairs_sql(vectors: str) -> str:
    """Ranked pairs. A text without a word has a vector of zeros, so its squared length is 0, not 1."""
    return f"""pairs AS (SELECT item_id AS question_id, vec_id,
    CAST(item_id IN (SELECT k FROM q) AS INTEGER) + CAST(vec_id IN (SELECT k FROM v) AS INTEGER) AS lengths FROM benchmark, {vectors} AS all_v),
r AS (SELECT question_id, vec_id, row_number() OVER (PARTITION BY question_id ORDER BY round(lengths - 2 * coalesce(s, 0), 9), vec_id) AS rank
      FROM pairs LEFT JOIN dot USING (question_id, vec_id))"""


_CHUNKS = _chunks_sql(10_000, 1_000)
_ANSWER = f"""
WITH {_CHUNKS}, c AS (SELECT doc_id * 16777216 + chunk_idx AS vec_id, text FROM chunks),
{_hashed_sql('v', 'c', 'vec_id')}, {_hashed_sql('q', 'benchmark', 'item_id')},
dot AS (SELECT q.k AS question_id, v.k AS vec_id, sum(q.weight * v.weight) AS s FROM q JOIN v USING (dim) GROUP BY 1, 2),
{_pairs_sql('c')},
x AS (SELECT question_id, string_agg(text, chr(10) || chr(10) ORDER BY rank) AS context FROM r JOIN c USING (vec_id) WHERE rank <= 4 GROUP BY 1)
SELECT question_id, {quote(ANSWER_PROMPT)} || context || chr(10) || chr(10) || 'Question:' || chr(10) || text AS prompt
FROM x JOIN benchmark ON item_id = question_id"""

ORACLE = {
    "index_all_texts": f"""
WITH {_chunks_sql(10_000, 1_000, f"SELECT doc_id, {_odd_texts(", 'g'")} AS text FROM documents")},
c AS (SELECT doc_id * 16777216 + chunk_idx AS vec_id, doc_id, chunk_idx, text FROM chunks), {_hashed_sql('v', 'c', 'vec_id')}
SELECT doc_id, chunk_idx, count(dim) AS n_dims, CASE WHEN count(dim) > 0 THEN 1.0 ELSE 0.0 END AS length
FROM c LEFT JOIN v ON k = vec_id GROUP BY doc_id, chunk_idx""",
    "concat_pages": """
SELECT conv_id, turn // 256 AS part, string_agg(text, '' ORDER BY turn) AS text FROM conversations GROUP BY 1, 2""",
    "embed_chunks": f"""
WITH {_hashed_sql('v', 'documents', 'doc_id')} SELECT k AS doc_id, dim, round(weight, 9) AS weight FROM v""",
    "embed_provider": """
SELECT doc_id, length(text) AS d0, len(string_split(text, ' ')) - 1 AS d1, len(string_split(text, chr(10))) - 1 AS d2 FROM documents""",
    "vector_topk": """
WITH x AS (SELECT vec_id, label, unnest(embedding) AS v, unnest(range(len(embedding))) AS i FROM embeddings),
c AS (SELECT label AS question_id, i, avg(CAST(v AS DOUBLE)) AS m FROM x GROUP BY 1, 2),
d AS (SELECT question_id, vec_id, sum((CAST(v AS DOUBLE) - m) * (CAST(v AS DOUBLE) - m)) AS distance FROM x JOIN c USING (i) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY round(distance, 9), vec_id) AS rank FROM d)
SELECT question_id, rank, vec_id, round(distance, 6) AS distance FROM r WHERE rank <= 10""",
    "answer_documents": _ANSWER,
    "stuff_context": f"""
WITH {_hashed_sql('v', 'documents', 'doc_id')}, {_hashed_sql('q', 'benchmark', 'item_id')},
dot AS (SELECT q.k AS question_id, v.k AS vec_id, sum(q.weight * v.weight) AS s FROM q JOIN v USING (dim) GROUP BY 1, 2),
{_pairs_sql('(SELECT doc_id AS vec_id FROM documents)')},
c AS (SELECT question_id, string_agg(text, chr(10) || chr(10) ORDER BY rank) AS context FROM r JOIN documents ON doc_id = vec_id WHERE rank <= 4 GROUP BY 1)
SELECT question_id, md5({quote(ANSWER_PROMPT)} || context || chr(10) || chr(10) || 'Question:' || chr(10) || text) AS prompt_md5
FROM c JOIN benchmark ON item_id = question_id""",
}

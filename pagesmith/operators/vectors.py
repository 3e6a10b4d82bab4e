"""Embedding of chunks and exact nearest-neighbour search over a table of vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..cluster import explode_array

# Fixed value: how many chunks a question gets when the caller does not say.
TOP_K = 4
# Up to this many questions are sent to all tasks at once; beyond it both sides are cut in blocks.
MAX_SHARED_QUESTIONS = 4096
VECTORS_PER_BLOCK = 50_000
# Distances bounded at once in a task.
PAIRS_PER_STEP = 4_000_000
# Distances are compared to nine digits, so equal vectors tie and the tie goes to the smaller id.
DIGITS = 9

RESULT = "question_id bigint, vec_id bigint, distance double"


# --- embeddings --------------------------------------------------------------------------------


def embedding(text: str | Column, dims: int = 64) -> Column:
    """Bag-of-words vector of a text, of unit length; all zeros for a text without a word.

    Words are runs of letters and digits of any script; a word's dimension comes from its MD5. It is an
    expression of the row alone: nothing is exploded, shuffled or joined."""
    lower = F.lower(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))
    words = F.regexp_extract_all(lower, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    code = lambda w: F.conv(F.substring(F.md5(w), 1, 3), 16, 10).cast("int") % dims
    every = F.sequence(F.lit(0), F.lit(dims - 1))
    # one pass over the sorted codes finds where each run of equal ones ends; counts are what lies between
    codes = F.transform(F.array(F.sort_array(F.transform(words, code))), lambda s: F.struct(s.alias("s"), F.when(
        F.size(s) > 0, F.filter(F.sequence(F.lit(1), F.size(s)), lambda i: F.coalesce(F.get(s, i - 1) != F.get(s, i), F.lit(True)))
    ).otherwise(F.array().cast("array<int>")).alias("ends")))
    runs = F.transform(codes, lambda c: F.map_from_arrays(
        F.transform(c["ends"], lambda e: F.get(c["s"], e - 1)),
        F.transform(c["ends"], lambda e, j: e - F.coalesce(F.get(c["ends"], j - 1), F.lit(0)))))
    counted = F.transform(runs, lambda m: F.transform(
        every, lambda d: F.coalesce(F.try_element_at(m, d), F.lit(0)).cast("double")))
    unit = F.transform(counted, lambda n: F.transform(F.array(F.sqrt(F.aggregate(
        n, F.lit(0.0), lambda total, x: total + x * x))), lambda length: F.transform(
            n, lambda x: F.when(length > 0, x / length).otherwise(F.lit(0.0)))))
    return F.get(F.get(unit, F.lit(0)), F.lit(0))


def hashed_words(texts: DataFrame, key: str, text: str = "text", dims: int = 64) -> DataFrame:
    """Sparse form of :func:`embedding`: ``key, dim, weight``, no row for a text without a word."""
    cells = explode_array(texts, [key], embedding(text, dims), "weight", "dim")
    return cells.where("weight > 0").select(key, "dim", "weight")


def embedded(texts: DataFrame, key: str, text: str = "text", dims: int = 64) -> DataFrame:
    """``key, embedding`` of every text, also of those without words."""
    return texts.select(key, embedding(text, dims).alias("embedding"))


def embed_with(chunks: DataFrame, provider: Callable[[list[str]], Sequence[Sequence[float]]],
               batch_size: int = 64) -> DataFrame:
    """Adds ``embedding`` by calling a batch embedding function over all partitions in parallel."""
    vector = T.StructField("embedding", T.ArrayType(T.DoubleType()))
    schema = T.StructType([*chunks.schema.fields, vector])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), batch_size):
                part = batch.iloc[start : start + batch_size]
                vectors = provider(part["text"].tolist())
                yield part.assign(embedding=[list(map(float, v)) for v in vectors])

    return chunks.mapInPandas(run, schema)


# --- search ------------------------------------------------------------------------------------


def _nearest(q_ids, q_vecs, v_ids, v_vecs, k: int) -> pd.DataFrame:
    """The k nearest vectors of every question within one block.

    A matrix product bounds all distances, each with the slack that its own two lengths call for, so one
    long vector doesn't loosen the bounds of the others. Candidates are worked out exactly in slices, and
    equal vectors are cut down to the k smallest ids beforehand: memory stays bounded under any ties."""
    v_vecs, v_ids = _first_of_equals(v_vecs, v_ids, k)
    norms = (v_vecs**2).sum(1)
    kth = min(k, len(v_ids)) - 1
    step = max(1, PAIRS_PER_STEP // len(v_ids))
    parts = []
    for start in range(0, len(q_ids), step):
        ids, vecs = q_ids[start : start + step], q_vecs[start : start + step]
        own = (vecs**2).sum(1)[:, None]
        slack = 1e-9 + 1e-12 * (own + norms[None, :])
        rough = own - 2.0 * (vecs @ v_vecs.T) + norms[None, :]
        bound = np.partition(rough + slack, kth, axis=1)[:, kth]
        rows, cols = np.nonzero(rough - slack <= bound[:, None])
        exact = np.empty(len(rows))
        for i in range(0, len(rows), 1 << 14):
            part = slice(i, i + (1 << 14))
            exact[part] = ((vecs[rows[part]] - v_vecs[cols[part]]) ** 2).sum(1)
        found = pd.DataFrame({"question_id": ids[rows], "vec_id": v_ids[cols], "distance": exact.round(DIGITS)})
        parts.append(_best(found, k))
    return pd.concat(parts)


def _first_of_equals(vecs: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of equal vectors, those with the k smallest ids; the others can't be among the k nearest."""
    raw = np.ascontiguousarray(vecs + 0.0).view(np.dtype((np.void, vecs.shape[1] * 8))).reshape(-1)
    order = np.lexsort((ids, np.unique(raw, return_inverse=True)[1]))
    group = np.unique(raw, return_inverse=True)[1][order]
    first = np.concatenate([[True], group[1:] != group[:-1]])
    place = np.arange(len(group)) - np.maximum.accumulate(np.where(first, np.arange(len(group)), 0))
    kept = order[place < k]
    return vecs[kept], ids[kept]


def _best(found: pd.DataFrame, k: int) -> pd.DataFrame:
    ordered = found.sort_values(["question_id", "distance", "vec_id"], kind="stable")
    return ordered.groupby("question_id", sort=False).head(k)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.vstack(column.to_numpy()).astype(np.float64)


def vector_topk(vectors: DataFrame, questions: DataFrame, k: int = TOP_K,
                max_shared: int = MAX_SHARED_QUESTIONS, block: int = VECTORS_PER_BLOCK) -> DataFrame:
    """Exact k nearest vectors (squared L2) of each question: ``question_id, rank, vec_id, distance``.

    Tasks emit only their best k per question, never pairs; a window keeps the overall best. How the
    questions reach the tasks depends on their counted number: see ``max_shared``."""
    vectors = vectors.select(F.col("vec_id").cast("bigint"), "embedding")
    questions = questions.select(F.col("question_id").cast("bigint"), "embedding")
    head = questions.limit(max_shared + 1).collect()
    if not head:
        best = vectors.limit(0).selectExpr("vec_id question_id", "vec_id", "0D distance")
    elif len(head) <= max_shared:
        best = _topk_shared(vectors, head, k)
    else:
        best = _topk_blocks(vectors, questions, k, max_shared, block)
    order = Window.partitionBy("question_id").orderBy("distance", "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("question_id", "rank", "vec_id", "distance")


def _topk_shared(vectors: DataFrame, questions: list, k: int) -> DataFrame:
    ids = np.array([q["question_id"] for q in questions], dtype=np.int64)
    matrix = np.array([q["embedding"] for q in questions], dtype=np.float64)
    shared = vectors.sparkSession.sparkContext.broadcast((ids, matrix))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        q_ids, q_vecs = shared.value
        best = None
        for batch in batches:
            if batch.empty:
                continue
            found = _nearest(q_ids, q_vecs, batch["vec_id"].to_numpy(), _matrix(batch["embedding"]), k)
            best = found if best is None else _best(pd.concat([best, found]), k)
        if best is not None:
            yield best

    return vectors.mapInPandas(scan, RESULT)


def _topk_blocks(vectors: DataFrame, questions: DataFrame, k: int, q_block: int,
                 v_block: int) -> DataFrame:
    """Many questions: a grid of bounded (question block, vector block) cells."""
    q_parts = max(1, -(-questions.count() // q_block))
    v_parts = max(1, -(-vectors.count() // v_block))
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = questions.withColumn("qb", deal("question_id", q_parts)).withColumn("vb", every(v_parts))
    v = vectors.withColumn("vb", deal("vec_id", v_parts)).withColumn("qb", every(q_parts))

    def cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame(columns=["question_id", "vec_id", "distance"])
        return _nearest(
            left["question_id"].to_numpy(), _matrix(left["embedding"]),
            right["vec_id"].to_numpy(), _matrix(right["embedding"]), k,
        )

    grid = q.groupBy("qb", "vb").cogroup(v.groupBy("qb", "vb"))
    return grid.applyInPandas(cell, RESULT)


# --- context for an answer ---------------------------------------------------------------------


def stuff_context(hits: DataFrame, texts: DataFrame, joiner: str = "\n\n") -> DataFrame:
    """``question_id, context``: the k texts of each question joined in rank order (k rows a group)."""
    found = hits.join(texts.select("vec_id", "text"), "vec_id")
    ordered = F.sort_array(F.collect_list(F.struct("rank", "text")))
    return found.groupBy("question_id").agg(
        F.array_join(F.transform(ordered, lambda r: r["text"]), joiner).alias("context")
    )


def concat_pages(pages: DataFrame, doc: str, page: str, text: str = "text",
                 pages_per_part: int = 256) -> DataFrame:
    """Text of a document's pages in order, no separator. Documents up to ``pages_per_part`` pages
    give one row; longer ones give consecutive parts, so no group grows without bound."""
    part = F.floor(F.col(page) / pages_per_part).cast("bigint").alias("part")
    ordered = F.sort_array(F.collect_list(F.struct(page, text)))
    return pages.groupBy(doc, part).agg(
        F.array_join(F.transform(ordered, lambda p: p[text]), "").alias("text")
    )

"""Answer job: documents -> chunks -> vectors; questions -> nearest chunks -> filled prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..cluster import cut_lineage
from ..functions.chunks import CHUNK_OVERLAP, CHUNK_SIZE
from ..functions.replies import build_answer_prompt
from ..operators.listings import chunk_rows
from ..operators.vectors import TOP_K, embedded, embedding, stuff_context, vector_topk


# More chunks than the longest possible text value can give.
MAX_CHUNKS = 1 << 24


def index_documents(documents: DataFrame, size: int = CHUNK_SIZE,
                    overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """``doc_id, text`` -> ``vec_id, doc_id, chunk_idx, text, embedding``, checkpointed.

    ``vec_id`` packs (doc_id, chunk_idx), so it is the same on every run and never collides; an
    id that does not fit fails the job instead of wrapping around."""
    chunks = chunk_rows(documents.select("doc_id", "text"), size, overlap)
    packed = F.col("doc_id") * F.lit(MAX_CHUNKS).cast("bigint") + F.col("chunk_idx")
    keyed = chunks.withColumn("vec_id", packed)
    return cut_lineage(keyed.withColumn("embedding", embedding("text")))


def answer_prompts(index: DataFrame, questions: DataFrame, k: int = TOP_K) -> DataFrame:
    """``question_id, question`` -> ``question_id, prompt`` with the k nearest chunks as context."""
    asked = embedded(questions, "question_id", "question")
    context = stuff_context(vector_topk(index, asked, k), index)
    return context.join(questions, "question_id").select(
        "question_id", build_answer_prompt(F.col("context"), F.col("question")).alias("prompt")
    )

"""Helpers shared by the operators: exact columns in, row streams, document keys, salted joins."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MASK = (1 << 64) - 1


def rows_of(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples of Python values."""
    for batch in batches:
        yield from zip(*[batch.column(n).to_pylist() for n in names], strict=True)


def utf8(column: str) -> Column:
    """A text as bytes, so that Python gets it without decoding; a null text is empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


class Rows:
    """Collects result rows and gives them back in Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema, rows: int = 20_000, size: int = 8 << 20):
        self.schema, self.rows, self.size = schema, rows, size
        self.columns: list[list] = [[] for _ in schema]
        self.bytes = 0

    def add(self, *values, size: int = 0) -> bool:
        """Take a row; true if the batch is full."""
        for column, value in zip(self.columns, values, strict=True):
            column.append(value)
        self.bytes += size
        return len(self.columns[0]) >= self.rows or self.bytes >= self.size

    def take(self) -> pa.RecordBatch:
        arrays = [pa.array(c, f.type) for c, f in zip(self.columns, self.schema, strict=True)]
        self.columns, self.bytes = [[] for _ in self.schema], 0
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.columns[0]:
            yield self.take()


class Numbers(dict):
    """word -> number, worked out once per distinct word; emptied when it holds ``bound`` words."""

    def __init__(self, number, bound: int = 400_000):
        super().__init__()
        self.number, self.bound = number, bound

    def __missing__(self, word):
        value = self[word] = self.number(word)
        return value

    def of(self, words: list, dtype=np.uint64) -> np.ndarray:
        if len(self) > self.bound:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), dtype=dtype, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (xor-shift and multiply), so that every bit depends on every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_columns(id_column: str = "doc_id", text_column: str = "text") -> list[Column]:
    """``_id`` and ``_hash``: rows that agree in both are the same document; a null id is an id of its own."""
    whole = F.coalesce(F.col(id_column).cast("long"), F.lit(-(2**63)))
    return [whole.alias("_id"), F.xxhash64(F.lit(1), F.col(text_column)).alias("_hash")]


def keyed(docs: DataFrame) -> DataFrame:
    """``_id``, ``_hash``, ``_text`` of every row."""
    return docs.select(*key_columns(), utf8("text").alias("_text"))


def whole_row(docs: DataFrame) -> Column:
    """All columns as one, ``_row``, so that no name of theirs can clash; ``_row.*`` gives them back."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")


def dealt_by_file(rows: DataFrame, files: int, most: int = 20_000) -> DataFrame:
    """Rows dealt by ``file``, about one file a task. The number is given, as Spark would otherwise put
    many small rows, and all the files they name, in one task."""
    return rows.repartitionByRange(max(1, min(files, most)), "file")


def clean(id_value: Column) -> Column:
    """The id that a key stands for."""
    return F.when(id_value != F.lit(-(2**63)), id_value)


def first_of_each(found: DataFrame) -> DataFrame:
    """``_id, _hash`` of one row of each ``root``: the smallest id, and the smallest text hash that goes with it.
    Plain minima, so that a component's rows collapse before they are shuffled."""
    ids = found.groupBy("root", "_id").agg(F.min("_hash").alias("_hash"))
    least = ids.groupBy("root").agg(F.min("_id").alias("_id"))
    return ids.join(least, ["root", "_id"]).select("_id", "_hash")

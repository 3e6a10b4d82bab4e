"""The splitter against a piece-by-piece brute force of the same rule, and its invariants."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagesmith.functions.chunks import chunk_text, split_text


def brute_force(text, size, overlap, separators=("\n\n", "\n", " ", "")):
    sep = next((s for s in separators if s in text), separators[-1])
    finer = separators[separators.index(sep) + 1 :]
    if sep:
        first, *rest = text.split(sep)
        pieces = [p for p in [first, *[sep + r for r in rest]] if p]
    else:
        pieces = list(text)
    out, queue = [], []

    def flush():
        window = []
        for piece in queue:
            if window and len("".join(window)) + len(piece) > size:
                out.append("".join(window).strip())
                while window and (
                    len("".join(window)) > overlap or len("".join(window)) + len(piece) > size
                ):
                    window.pop(0)
            window.append(piece)
        out.append("".join(window).strip())
        queue.clear()

    for piece in pieces:
        if len(piece) < size:
            queue.append(piece)
        else:
            flush()
            out.extend(brute_force(piece, size, overlap, finer) if finer else [piece])
    flush()
    return [c for c in out if c]


texts = st.text(alphabet="ab é\n", max_size=120)


@settings(max_examples=400, deadline=None)
@given(texts, st.integers(1, 20), st.integers(0, 20))
def test_same_as_brute_force(text, size, overlap):
    overlap = min(size, overlap)
    assert split_text(text, size, overlap) == brute_force(text, size, overlap)


@settings(max_examples=200, deadline=None)
@given(texts, st.integers(2, 20), st.integers(0, 20))
def test_invariants(text, size, overlap):
    chunks = split_text(text, size, min(size, overlap))
    assert all(0 < len(c) <= size and c in text and c == c.strip() for c in chunks)
    visible = lambda t: "".join(t.split())
    assert set(visible(text)) <= set("".join(map(visible, chunks)))
    if min(size, overlap) == 0:
        assert "".join(map(visible, chunks)) == visible(text)


def test_spark_matches_brute_force_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for size, overlap in ((500, 50), (10_000, 1_000)):
        rows = docs.select("text", chunk_text(F.col("text"), size, overlap).alias("c")).collect()
        for row in rows:
            assert [c["text"] for c in row["c"]] == brute_force(row["text"], size, overlap)
            assert [c["chunk_idx"] for c in row["c"]] == list(range(len(row["c"])))


def test_edge_cases(spark):
    cases = [("short text", ["short text"]), ("x" * 12, ["xxxxx", "xxxxx", "xx"]), ("\n\n \n", []), ("", [])]
    df = spark.createDataFrame([(t,) for t, _ in cases], "t string")
    got = [[c["text"] for c in r[0]] for r in df.select(chunk_text(F.col("t"), 5, 0)).collect()]
    assert got == [["short", "text"], cases[1][1], [], []]


def test_chunk_rows_bounds_python_batches_by_bytes(spark):
    """Long texts reach the splitter in Arrow batches bounded by bytes, not by ten thousand rows alone."""
    from pagesmith.operators.listings import chunk_rows

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = spark.conf.get(name, None)
    spark.conf.unset(name)
    try:
        text = ("word " * 300 + "\n") * 40
        docs = spark.createDataFrame([(i, text) for i in range(3)], "doc_id long, text string")
        got = chunk_rows(docs, 500, 50).where("doc_id = 0").orderBy("chunk_idx").select("text").collect()
        assert spark.conf.get(name, None) == "8m"
        assert [r.text for r in got] == split_text(text, 500, 50)
    finally:
        spark.conf.unset(name) if own is None else spark.conf.set(name, own)

"""Token counts by dynamic programming over a trie of distinct pre-tokens.

Texts are split at ASCII white space; each word, with the word mark in front, is a pre-token. How many
tokens it has under a unigram vocabulary is the number of pieces in its best segmentation: the largest
sum of scores, of equal ones the fewest pieces. A task puts the distinct pre-tokens of its documents
into a trie. The forward score of a node (a prefix) is worked out once, from its ancestors' scores,
however many words share the prefix; the count at a word's terminal node is looked up for each
occurrence. Where no piece ends, a character counts as its UTF-8 bytes (byte fallback).

The trie is emptied when it has ``NODES`` nodes, and words longer than ``LONG`` characters are worked
out without it, with the same result, so memory is bounded for any text. Null and empty texts have no
tokens; a null id stays null; repeated rows are counted each for itself; extra columns are ignored; no
documents give no rows. Nothing is shuffled."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
NODES, LONG = 400_000, 64
#: What a character without a piece costs, below the worst piece's score.
UNKNOWN_COST = 10.0


def read_pieces(model_path: str) -> dict[str, float]:
    """Pieces and scores of a sentencepiece model file; control, unknown and byte pieces left out."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_path)
    return {
        model.id_to_piece(i): model.get_score(i) for i in range(model.vocab_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}


class PieceTrie:
    """The vocabulary backwards: from a place in a word, which pieces end there."""

    def __init__(self, pieces: dict[str, float]):
        self.root: dict = {}
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN_COST
        for piece, score in pieces.items():
            node = self.root
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[""] = score

    def forward(self, text: str, scores: list, counts: list) -> tuple[float, int]:
        """Best score and least count of ``text``, given those of all its shorter prefixes."""
        best, fewest = scores[-1] + self.unknown, counts[-1] + len(text[-1].encode())
        node = self.root
        for start in range(len(text) - 1, -1, -1):
            node = node.get(text[start])
            if node is None:
                break
            score = node.get("")
            if score is not None:
                whole = scores[start] + score
                if whole > best or whole == best and counts[start] + 1 < fewest:
                    best, fewest = whole, counts[start] + 1
        return best, fewest


class PrefixTrie:
    """Pre-tokens seen so far. A node: its children, and the forward score and count of its prefix."""

    def __init__(self, pieces: PieceTrie, nodes: int = NODES, long: int = LONG):
        self.pieces, self.most, self.long = pieces, nodes, long
        self.clear()

    def clear(self) -> None:
        self.children: list[dict] = [{}]
        self.scores, self.counts, self.terminal = [0.0], [0], {}

    def tokens(self, word: bytes) -> int:
        known = self.terminal.get(word)
        if known is not None:
            return known
        text = MARK + word.decode()
        if len(text) > self.long:
            return self.plain(text)
        if len(self.children) > self.most:
            self.clear()
        node, scores, counts = 0, [0.0], [0]
        for i, c in enumerate(text, 1):
            below = self.children[node].get(c)
            if below is None:
                score, count = self.pieces.forward(text[:i], scores, counts)
                below = self.children[node][c] = len(self.children)
                self.children.append({})
                self.scores.append(score)
                self.counts.append(count)
            node = below
            scores.append(self.scores[node])
            counts.append(self.counts[node])
        self.terminal[word] = counts[-1]
        return counts[-1]

    def plain(self, text: str) -> int:
        """The same for one long word, in one go: what ``forward`` looks at is bounded by the longest piece."""
        scores, counts = [0.0], [0]
        root, unknown = self.pieces.root, self.pieces.unknown
        for i, c in enumerate(text):
            best, fewest = scores[i] + unknown, counts[i] + len(c.encode())
            node, start = root, i
            while start >= 0 and (node := node.get(text[start])) is not None:
                score = node.get("")
                if score is not None:
                    whole = scores[start] + score
                    if whole > best or whole == best and counts[start] + 1 < fewest:
                        best, fewest = whole, counts[start] + 1
                start -= 1
            scores.append(best)
            counts.append(fewest)
        return counts[-1]


def _count(model_path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PrefixTrie(PieceTrie(read_pieces(model_path)))
        for batch in batches:
            words, tokens = [], []
            for text in batch.column("text").to_pylist():
                parts = text.encode().split()
                words.append(len(parts))
                tokens.append(sum(map(trie.tokens, parts)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                ["doc_id", "n_words", "n_tokens"])

    return run


def token_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, n_words, n_tokens`` of every row."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    key = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_count(model_path), f"doc_id {key}, n_words long, n_tokens long")

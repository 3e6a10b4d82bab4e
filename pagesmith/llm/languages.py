"""Language identification in two steps: the family first, then the language within it.

A text is the counts of its runs of 1 to 4 letters, hashed into ``BUCKETS``; letters are lower-cased,
everything between words is one space. Both steps are one-versus-one linear support vector machines
without a constant: every pair of families, and every pair of languages of a family, has a hyperplane, the
side that most hyperplanes choose wins, and the sum of margins decides ties. So closely related languages
are told apart by what distinguishes just these two. A hyperplane is fitted by one task, by dual coordinate
descent over a bounded sample: at most ``PER_LANGUAGE`` texts of a language, chosen by the hash of the text,
each distinct text once.

The score is the probability (logistic in the margin) of the chosen family against its closest rival times
that of the chosen language against its own. Null texts and texts without a letter are ``und`` with score
0, and so is every text if nothing can be learned. Whole texts are read. A null id counts as an empty one:
it is held out. Repeated rows are predicted alike; other columns, and the language and the id themselves, are
never looked at for a prediction; no documents give no rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagesmith.cluster import cut_lineage
from pagesmith.llm.common import mix, utf8

BITS = 14
BUCKETS = 1 << BITS
ORDERS = 4
#: Texts of a language that a hyperplane between languages is fitted on; between families, this many of each family.
PER_LANGUAGE = 1500
FOLDS = 5
ROUNDS, COST = 12, 10.0
UNKNOWN = "und"
#: Characters worked on at once: longer texts are counted in stretches.
STRETCH = 1 << 20
#: Families of languages by ISO 639-1 code.
FAMILIES = {
    "Germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "Romance": "an ca es fr gl it la oc pt rm ro sc wa",
    "Slavic": "be bg bs cs hr mk pl ru sh sk sl sr uk",
    "Baltic": "lt lv",
    "Celtic": "br cy ga gd gv kw",
    "Hellenic": "el",
    "Indo-Aryan": "bn gu hi mr ne or pa sa si ur",
    "Iranian": "fa ku ps tg",
    "Uralic": "et fi hu se",
    "Turkic": "az ba kk ky tk tr tt ug uz",
    "Semitic": "am ar he mt ti",
    "Sinitic": "zh",
    "Austronesian": "id jv mg mi ms sm su tl",
    "Dravidian": "kn ml ta te",
    "Bantu": "rw sn st sw xh zu",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family(language: str) -> str:
    """The family of a language code or tag; a language that isn't listed is a family of its own."""
    return _FAMILY.get(language.lower().replace("_", "-").split("-")[0], language)


@cache
def _letters() -> np.ndarray:
    """For every code point: the lower-case letter, or a space for what isn't a letter."""
    table = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        if not 0xD800 <= c < 0xE000 and chr(c).isalpha():
            low = chr(c).lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def letters_of(text: str) -> np.ndarray:
    """A text's letters with one space before, between and after words; empty without a letter."""
    points = _letters()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    letter = points != 32
    kept = letter.copy()
    kept[1:] |= letter[:-1]  # the first space after a word
    points = points[kept]
    if not len(points):
        return points
    ends = [np.array([32], np.uint32)] if points[-1] != 32 else []
    return np.concatenate([np.array([32], np.uint32), points, *ends])


def counts_of(letters: np.ndarray) -> np.ndarray:
    """Counts of all runs of 1 to ``ORDERS`` letters by bucket; runs reach over a space, but spaces alone don't count."""
    found = np.zeros(BUCKETS, np.float64)
    for i in range(0, len(letters), STRETCH):
        part = letters[i : i + STRETCH + ORDERS - 1].astype(np.uint64)
        own = min(STRETCH, len(letters) - i)
        code = np.zeros(len(part), np.uint64)
        for order in range(1, ORDERS + 1):
            n = len(part) - order + 1
            if n <= 0:
                break
            code = code[:n] * np.uint64(0x110003) + part[order - 1 :]
            used = code[:own]
            used = used[part[: len(used)] != 32] if order == 1 else used
            bucket = mix(used + np.uint64(order)) & np.uint64(BUCKETS - 1)
            found += np.bincount(bucket.astype(np.int64), minlength=BUCKETS)
    return found


def features(text: str | None) -> np.ndarray | None:
    """Counts of a text divided by their length as a vector; None without a letter."""
    letters = letters_of(text) if text else np.zeros(0, np.uint32)
    if not len(letters):
        return None
    counts = counts_of(letters)
    return counts / np.sqrt(counts @ counts)


def _decoded(column: pa.Array) -> list[str]:
    return [t.decode("utf-8", "replace") for t in column.to_pylist()]


def _sparse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, len(batch), 200):
            part = batch.slice(i, 200)
            rows = [features(t) for t in _decoded(part.column("text"))]
            rows = [np.zeros(BUCKETS) if r is None else r for r in rows]
            at = [np.flatnonzero(r) for r in rows]
            ends = np.zeros(len(rows) + 1, np.int32)
            np.cumsum([len(a) for a in at], out=ends[1:])
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(v))) for v in (
                [a.astype(np.int32) for a in at], [r[a].astype(np.float32) for r, a in zip(rows, at, strict=True)])]
            yield pa.RecordBatch.from_arrays(
                [part.column("lang"), part.column("hash"), *lists], ["lang", "hash", "buckets", "shares"])


def held_out(doc_id: str = "doc_id", folds: int = FOLDS) -> Column:
    """Whether a row is kept from learning, by the CRC-32 of its id as text."""
    named = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(named.cast("binary")) % folds == 0


def training_sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``lang, hash, text``: at most ``per_language`` distinct texts of each language, those with the smallest
    hashes. A share of the hashes that holds somewhat more than that is cut off first, so that only a bounded
    number of rows of a language meet, however many it has."""
    known = docs.where(~held_out() & F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN) & F.col("text").isNotNull())
    hashed = known.select("lang", F.xxhash64("text").alias("hash"), utf8("text").alias("text"))
    sizes = hashed.groupBy("lang").agg(F.approx_count_distinct("hash").alias("distinct"))  # a row per language
    place = (F.col("hash").cast("double") + 2.0**63) / 2.0**64
    some = hashed.join(F.broadcast(sizes), "lang").where(place * F.col("distinct") <= 2.0 * per_language)
    some = some.dropDuplicates(["lang", "hash"])
    number = F.row_number().over(Window.partitionBy("lang").orderBy("hash"))
    return some.select("lang", "hash", "text", number.alias("number")).where(F.col("number") <= per_language).drop("number")


def hyperplane(rows: list[tuple[np.ndarray, np.ndarray]], sides: np.ndarray, rounds: int = ROUNDS, cost: float = COST) -> np.ndarray:
    """Weights of a linear support vector machine (hinge loss, no constant): dual coordinate descent over
    sparse rows of length one, in a fixed order. Both sides have the same weight, whatever their numbers."""
    weights, alpha = np.zeros(BUCKETS), np.zeros(len(rows))
    several = np.array([(sides == 1).sum(), (sides == -1).sum()])
    most = np.where(sides == 1, cost * several.max() / several[0], cost * several.max() / several[1])
    norms = np.array([float(v @ v) for _, v in rows])
    order = np.random.default_rng(0)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(rows)):
            at, values = rows[i]
            if not norms[i]:
                continue
            step = (1.0 - sides[i] * (weights[at] @ values)) / norms[i]
            new = min(max(alpha[i] + step, 0.0), most[i])
            if new != alpha[i]:
                weights[at] += (new - alpha[i]) * sides[i] * values
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return weights


def _fit(key: tuple, table: pa.Table) -> pa.Table:
    table = table.sort_by([("side", "ascending"), ("lang", "ascending"), ("hash", "ascending")])
    columns = [table.column(c).combine_chunks() for c in ("buckets", "shares")]
    rows = [(at.values.to_numpy(zero_copy_only=False), values.values.to_numpy(zero_copy_only=False).astype(float))
            for at, values in zip(*columns, strict=True)]
    weights = hyperplane(rows, table.column("side").to_numpy())
    return pa.table({"pair": pa.array([key[0].as_py()], pa.int32()), "weights": pa.array([weights.astype(np.float32)])})


class Contest(NamedTuple):
    """Hyperplanes between all pairs of some classes; columns of ``weights`` follow ``combinations(classes)``."""

    classes: list[str]
    weights: np.ndarray

    def decide(self, row: np.ndarray) -> tuple[str, float]:
        """The class that most hyperplanes choose, by the sum of margins among equals, and its probability
        against its closest rival."""
        if len(self.classes) == 1:
            return self.classes[0], 1.0
        n = len(self.classes)
        margins = np.zeros((n, n))
        a, b = np.triu_indices(n, 1)
        margins[a, b] = row @ self.weights
        margins[b, a] = -margins[a, b]
        order = np.lexsort((np.clip(margins, -1, 1).sum(axis=1), (margins > 0).sum(axis=1)))
        best = order[-1]
        return self.classes[best], float(1 / (1 + np.exp(-2 * np.delete(margins[best], best).min())))


class Model(NamedTuple):
    families: Contest
    languages: dict[str, Contest]

    def predict(self, text: str | None) -> tuple[str, float]:
        row = features(text)
        if row is None:
            return UNKNOWN, 0.0
        chosen, sure = self.families.decide(row)
        language, surer = self.languages[chosen].decide(row)
        return language, sure * surer


def fit_languages(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """The hyperplanes, each fitted by a task of its own; None if no text with a letter has a language."""
    sample = training_sample(docs, per_language)
    rows = sample.mapInArrow(_sparse, "lang string, hash long, buckets array<int>, shares array<float>")
    rows = cut_lineage(rows.where(F.size("buckets") > 0))
    languages = sorted(r.lang for r in rows.select("lang").distinct().collect())  # a row per language
    if not languages:
        return None
    members: dict[str, list[str]] = {}
    for language in languages:
        members.setdefault(family(language), []).append(language)
    groups = [sorted(members), *(members[f] for f in sorted(members))]
    pairs = [(g, a, b) for g, classes in enumerate(groups) for a, b in combinations(classes, 2)]
    sides = []
    for p, (g, a, b) in enumerate(pairs):
        for name, side in ((a, 1), (b, -1)):
            own = members[name] if g == 0 else [name]
            # of a family's languages each gives the same share, so that a family's rows are bounded, too
            sides += [(p, language, side, -(-per_language // len(own))) for language in own]
    found = {}
    if sides:
        table = docs.sparkSession.createDataFrame(sides, "pair int, lang string, side int, most int")
        number = F.row_number().over(Window.partitionBy("lang").orderBy("hash"))  # at most per_language rows
        dealt = rows.withColumn("number", number).join(F.broadcast(table), "lang").where("number <= most")
        fitted = dealt.select("pair", "side", "lang", "hash", "buckets", "shares").groupBy("pair").applyInArrow(_fit, "pair int, weights array<float>")
        found = {r.pair: np.array(r.weights, np.float32) for r in fitted.collect()}  # a row per pair
    contests = [Contest(classes, np.stack([found[p] for p, (h, _, _) in enumerate(pairs) if h == g], axis=1) if len(classes) > 1 else np.zeros((BUCKETS, 0)))
                for g, classes in enumerate(groups)]
    return Model(contests[0], dict(zip(sorted(members), contests[1:], strict=True)))


def _predict(model: Model | None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(UNKNOWN, 0.0) if model is None else model.predict(t) for t in _decoded(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("held_out"), pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row; learned from the rows that aren't held out."""
    model = fit_languages(docs, per_language)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), utf8("text").alias("text"))
    return rows.mapInArrow(_predict(model), "doc_id long, held_out boolean, lang_pred string, score double")

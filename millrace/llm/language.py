"""Language identification by the nearest of several centroids per language.

A text is a vector of hashed character n-grams (lengths one to three, lower
case, runs of other characters as one blank), weighted by TF-IDF and scaled to
length one. Every language has a few centroids found by spherical clustering of
a bounded sample of labelled texts; the nearest by cosine decides. Each
centroid knows how near its own texts of a length come; a text much farther
away than those is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm import ragged
from millrace.llm.frames import map_texts

DIMENSIONS = 4096
CENTROIDS = 4
# Labelled texts per language on which centroids are fitted, about.
FIT_PER_LANGUAGE = 300
# Texts whose vectors are held at a time.
ROWS = 512
# A text is rejected if its similarity is below this part of what its nearest centroid's own texts of like length have.
REJECT_PART = 0.3
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """Lower-case code point of every letter, a blank for everything else."""
    letters = ragged.char_classes() == ragged.LETTER
    out = np.full(0x110000, 0x20, np.uint32)
    for point in np.flatnonzero(letters).tolist():
        low = chr(point).lower()
        out[point] = ord(low) if len(low) == 1 else point
    return out


def gram_counts(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed n-grams of every text, and the number of letters of each."""
    texts = len(offsets) - 1
    points, firsts, _ = ragged.code_points(buf, offsets)
    points = _folded()[points]
    owner = np.repeat(np.arange(texts), np.diff(firsts))
    letters = points != 0x20
    # A run of blanks is one blank.
    kept = letters.copy()
    kept[1:] |= letters[:-1] | (owner[1:] != owner[:-1])
    kept[:1] = True
    points, owner, letters = points[kept], owner[kept], letters[kept]
    counts = np.zeros((texts, DIMENSIONS), np.float32)
    if len(points):
        value = points.copy()
        place = owner * DIMENSIONS
        full = letters.copy()
        for length in (1, 2, 3):
            n = len(points) - length + 1
            if n <= 0:
                break
            if length > 1:
                value = value[:n] * np.uint32(0x01000193) ^ points[length - 1 :]
                full = full[:n] | letters[length - 1 :]
            good = full & (owner[:n] == owner[length - 1 :])
            gram = value * np.uint32(0x9E3779B1) + np.uint32(length * 0x05EBCA6B)
            gram = (gram ^ gram >> np.uint32(15)) * np.uint32(0x2C1B3C6D)
            gram = (gram >> np.uint32(20)).astype(np.int64) & (DIMENSIONS - 1)
            counts += np.bincount((place[:n] + gram)[good], minlength=texts * DIMENSIONS).reshape(texts, DIMENSIONS)
    return counts, np.bincount(owner[letters], minlength=texts)


def batches_of_vectors(batch: pa.RecordBatch, idf: np.ndarray | None) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Rows, unit vectors (counts without ``idf``) and letters, a bounded number of texts at a time."""
    for start in range(0, batch.num_rows, ROWS):
        part = batch.slice(start, ROWS)
        counts, letters = gram_counts(*ragged.column_bytes(part["text"]))
        if idf is not None:
            np.log1p(counts, out=counts)
            counts *= idf
            norms = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
            counts /= np.where(norms > 0, norms, 1)
        yield slice(start, start + part.num_rows), counts, letters


@dataclass(frozen=True)
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    # Language of each centroid.
    owner: np.ndarray
    # Usual similarity of a centroid's texts, by length class.
    usual: np.ndarray

    def nearest(self, vectors: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number, similarity, and whether the text is too far from every centroid."""
        near = vectors @ self.centroids.T
        best = near.argmax(axis=1)
        score = np.clip(near[np.arange(len(near)), best], 0, 1)
        return self.owner[best], score, score < REJECT_PART * self.usual[best, length_class(letters)]


def length_class(letters: np.ndarray) -> np.ndarray:
    """Texts of like length: below 8, 32, 128, 512, 2048 letters, and longer."""
    return np.searchsorted([8, 32, 128, 512, 2048], letters, "right")


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", per_language: int = FIT_PER_LANGUAGE) -> Model:
    """Learn from rows with a language; rows without text or language count for nothing.

    Document frequencies cover all rows. Centroids are fitted on about
    ``per_language`` texts of each language, chosen by a hash.
    """
    rows = labelled.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    rows = rows.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.col("lang") != UNKNOWN))
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    none = np.zeros((0, DIMENSIONS), np.float32)
    if not languages:
        return Model([], np.zeros(DIMENSIONS, np.float32), none, np.zeros(0, np.int64), np.zeros((0, 6)))

    def frequencies(batches):
        total = np.zeros(DIMENSIONS, np.int64)
        for batch in ragged.slices(batches, "text"):
            for _, counts, _ in batches_of_vectors(batch, None):
                total += (counts > 0).sum(axis=0)
        yield pa.record_batch([pa.array(np.arange(DIMENSIONS), pa.int32()), pa.array(total)], ["gram", "n"])

    found = rows.select("text").mapInArrow(frequencies, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    frequency = np.zeros(DIMENSIONS)
    for row in found.collect():
        frequency[row.gram] = row.n
    idf = np.log((1 + sum(sizes.values())) / (1 + frequency)).astype(np.float32) + np.float32(0.05)

    share = F.create_map(*[x for name in languages for x in (F.lit(name), F.lit(min(1.0, per_language / sizes[name])))])
    # Equal texts are told apart by their place, so that a frequent one is sampled like any other.
    draw = F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.lit(1_000_003)) / 1_000_003
    sample = rows.filter(draw < F.element_at(share, F.col("lang")))

    def vectors(batches):
        for batch in ragged.slices(batches, "text"):
            for at, held, letters in batches_of_vectors(batch, idf):
                packed = pa.array([row.astype(np.float16).tobytes() for row in held], pa.binary())
                yield pa.record_batch([batch["lang"].slice(at.start, len(held)), packed, pa.array(letters)], ["lang", "vec", "letters"])

    taken = sample.mapInArrow(vectors, "lang string, vec binary, letters long").toArrow().to_pydict()
    names = np.array(taken["lang"])
    held = np.stack([np.frombuffer(x, np.float16).astype(np.float32) for x in taken["vec"]]) if len(names) else none
    letters = np.array(taken["letters"], np.int64)
    centroids, owner, usual = [], [], []
    for number, name in enumerate(languages):
        own, sizes_own = held[names == name], letters[names == name]
        if not len(own):
            continue
        for centroid, members in clustered(own[np.argsort(-sizes_own, kind="stable")], CENTROIDS):
            centroids.append(centroid)
            owner.append(number)
            usual.append(_usual(own, sizes_own, centroid))
    return Model(languages, idf, np.array(centroids, np.float32).reshape(-1, DIMENSIONS), np.array(owner, np.int64), np.array(usual).reshape(-1, 6))


def clustered(vectors: np.ndarray, parts: int, rounds: int = 10) -> list[tuple[np.ndarray, np.ndarray]]:
    """Spherical k-means: unit centroids with the members of each."""
    centroids = vectors[np.linspace(0, len(vectors) - 1, min(parts, len(vectors))).astype(int)].copy()
    for _ in range(rounds):
        nearest = (vectors @ centroids.T).argmax(axis=1)
        for k in range(len(centroids)):
            total = vectors[nearest == k].sum(axis=0)
            norm = np.sqrt((total * total).sum())
            if norm > 0:
                centroids[k] = total / norm
    return [(c, nearest == k) for k, c in enumerate(centroids)]


def _usual(vectors: np.ndarray, letters: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Median similarity by length class; a class without texts has that of the next shorter one, the shortest none."""
    near, classes, out, last = vectors @ centroid, length_class(letters), [], 0.0
    for k in range(6):
        if (classes == k).any():
            last = float(np.median(near[classes == k]))
        out.append(last)
    return np.array(out)


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row.

    ``score`` is the cosine to the nearest centroid. A null text or one without
    a letter, or any text if nothing was learned, is ``und`` with score 0 and
    rejected. Repeated ids stay one row each; other columns are not read.
    """
    names = np.array([*model.languages, UNKNOWN], object)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        language = np.full(batch.num_rows, len(model.languages))
        score = np.zeros(batch.num_rows)
        rejected = np.ones(batch.num_rows, bool)
        if len(model.centroids):
            for at, vectors, letters in batches_of_vectors(batch, model.idf):
                best, near, far = model.nearest(vectors, letters)
                some = letters > 0
                language[at] = np.where(some, best, len(model.languages))
                score[at] = np.where(some, near, 0)
                rejected[at] = far | ~some
        return pa.record_batch(
            [batch["id"], pa.array(names[language].tolist(), pa.string()), pa.array(score), pa.array(rejected)],
            ["doc_id", "lang_pred", "score", "rejected"],
        )

    kind = docs.schema[doc_id].dataType.simpleString()
    return map_texts(docs, {"id": doc_id, "text": text}, run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text is not rejected."""

    def run(batches):
        for batch in ragged.slices(batches, text):
            kept = np.zeros(batch.num_rows, bool)
            if len(model.centroids):
                renamed = pa.record_batch([batch[text]], ["text"])
                for at, vectors, letters in batches_of_vectors(renamed, model.idf):
                    kept[at] = ~model.nearest(vectors, letters)[2] & (letters > 0)
            yield batch.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % 5 == 0, F.lit(False))

"""A quality classifier by nearest-neighbour voting in a latent-semantic space.

Texts become hashed counts of words, of word shapes (classes of characters) and of
a few figures of the whole text; counts are damped, weighted by rarity and
projected onto the leading singular vectors of a labelled sample. The sample's
vectors are broadcast, every document's cosine with all of them is computed in
blocks, and its nearest vote with weights that grow with similarity. The sample
is the only thing fitted and has a fixed bound (``LABELLED`` rows by hash order).
"""

from __future__ import annotations

import itertools
import re
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docindex.llm.common import VOCABULARY, Batches, first_by_hash, per_process, utf8

LABELLED = 6_000
WORD_BUCKETS, SHAPE_BUCKETS, FIGURE_BUCKETS = 1024, 768, 256
BUCKETS = WORD_BUCKETS + SHAPE_BUCKETS + FIGURE_BUCKETS
# How much of a text's vector each group of buckets makes up.
WEIGHTS = ((0, WORD_BUCKETS, 0.3), (WORD_BUCKETS, WORD_BUCKETS + SHAPE_BUCKETS, 1.0), (WORD_BUCKETS + SHAPE_BUCKETS, BUCKETS, 1.0))
LATENT = 48
NEIGHBOURS = 25
SHARPNESS = 12  # the power of the cosine that weights a vote
PRIOR = 0.5  # votes of the sample's mean, so that a score is never 0 / 0
BLOCK = 512

_CLASSES = bytes.maketrans(
    bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(48, 58)) + bytes(range(128, 256)),
    b"U" * 26 + b"l" * 26 + b"d" * 10 + b"l" * 128,
)
_RUN = re.compile(rb"(.)\1+", re.S)


class Counts:
    """Texts to damped counts per bucket."""

    def __init__(self) -> None:
        self.number: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
        self.buckets = np.zeros((0, 2), np.int64)

    def matrix(self, texts: list[bytes | None]) -> np.ndarray:
        if len(self.number) > VOCABULARY:
            self.__init__()
        numbers, figures = [], []
        for text in texts:
            words = text.split() if text else []
            numbers.append(np.fromiter(map(self.number.__getitem__, words), np.int64, len(words)))
            figures.append(self._figures(text or b"", words))
        self._learn()
        out = np.zeros((len(texts), BUCKETS), np.float32)
        for row, own, more in zip(out, numbers, figures):
            pairs = self.buckets[own]
            row[:] = np.bincount(pairs.ravel(), minlength=BUCKETS)
            row[more] = 1.0
        return np.log1p(out)

    def _learn(self) -> None:
        known = len(self.buckets)
        new = list(itertools.islice(self.number, known, None))
        if new:
            bucket = xxhash.xxh32_intdigest
            words = [bucket(w.lower()) % WORD_BUCKETS for w in new]
            shapes = [WORD_BUCKETS + bucket(_RUN.sub(rb"\1", w.translate(_CLASSES))) % SHAPE_BUCKETS for w in new]
            self.buckets = np.concatenate([self.buckets, np.stack([words, shapes], 1)])

    @staticmethod
    def _figures(text: bytes, words: list[bytes]) -> list[int]:
        """A bucket per figure and size class."""
        n = len(words)
        lines = [x for x in text.split(b"\n") if x.strip()]
        ratios = (
            len(set(words)) / n if n else 0.0,
            1 - len(set(lines)) / len(lines) if lines else 0.0,
            min(1.0, len(lines) / n * 4) if n else 0.0,
            min(1.0, sum(map(len, words)) / n / 16) if n else 0.0,
            sum(map(bytes.__eq__, words, words[1:])) / n if n else 0.0,
            sum(map(text.count, (b"#", b"$", b"%", b"&", b"*", b"|", b"!"))) / (len(text) + 1),
        )
        classes = [n.bit_length(), *(32 * (i + 1) + int(31 * min(1.0, r)) for i, r in enumerate(ratios))]
        return [WORD_BUCKETS + SHAPE_BUCKETS + c for c in classes]


@dataclass
class Model:
    """What the executors need: rarity, projection, and the labelled vectors."""

    rarity: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def latent(self, counts: np.ndarray) -> np.ndarray:
        x = weighted(counts, self.rarity) @ self.projection
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        mean = float(self.labels.mean())
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        cosine = self.latent(counts) @ self.vectors.T
        k = min(NEIGHBOURS, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0) ** SHARPNESS
        votes = (weight * self.labels[near]).sum(1) + PRIOR * mean
        return np.clip(votes / (weight.sum(1) + PRIOR), 0, 1)


def weighted(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Rarity-weighted counts, each group of buckets brought to its share."""
    x = counts * rarity
    for lo, hi, share in WEIGHTS:
        part = x[:, lo:hi]
        part *= share / np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-12)
    return x


def fit(counts: np.ndarray, labels: np.ndarray) -> Model:
    """Truncated singular value decomposition of the sample by subspace iteration."""
    n = len(counts)
    rarity = (np.log((1 + n) / (1 + (counts > 0).sum(0))) + 1).astype(np.float32)
    x = weighted(counts, rarity)
    rng = np.random.default_rng(3)
    basis = rng.standard_normal((BUCKETS, LATENT + 16)).astype(np.float32)
    for _ in range(6):
        basis, _ = np.linalg.qr(x.T @ (x @ basis))
    _, _, right = np.linalg.svd(x @ basis, full_matrices=False)
    projection = (basis @ right.T)[:, :LATENT].astype(np.float32)
    model = Model(rarity, projection, np.zeros((0, LATENT), np.float32), labels.astype(np.float32))
    model.vectors = model.latent(counts)
    return model


class Sampled:
    """Labelled texts to their counts, packed."""

    def __call__(self, batches: Batches) -> Batches:
        counts = per_process("quality counts", Counts)
        for batch in batches:
            texts = list(utf8(batch.column("text")))
            packed = [r.tobytes() for at in range(0, len(texts), BLOCK) for r in counts.matrix(texts[at : at + BLOCK])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("label"), pa.array(packed, pa.binary())], ["doc", "label", "counts"]
            )


class Score:
    """Texts to scores, block by block against all labelled vectors."""

    def __init__(self, model: object) -> None:
        self.model = model

    def __call__(self, batches: Batches) -> Batches:
        model: Model = self.model.value
        counts = per_process("quality counts", Counts)
        for batch in batches:
            texts = list(utf8(batch.column("text")))
            blocks = [model.scores(counts.matrix(texts[at : at + BLOCK])) for at in range(0, len(texts), BLOCK)]
            scores = np.concatenate([np.zeros(0), *blocks]).astype(np.float64)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(scores)], ["doc", "score"])


def labelled_sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str) -> DataFrame:
    """``(doc, label, text)`` of the first ``LABELLED`` labelled ids in hash order. An
    id that repeats in either table counts once, with its largest label and the text
    of the smallest hash; NULL ids and labels are left out."""
    known = labels.select(F.col(doc_id).cast("bigint").alias("id"), F.col(label).cast("double").alias("label"))
    known = known.dropna().groupBy("id").agg(F.max("label").alias("label"))
    known = first_by_hash(known, known.count(), LABELLED, "id")
    texts = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).alias("text"))
    texts = texts.join(F.broadcast(known), F.col("doc") == F.col("id"))
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one")
    return texts.groupBy("doc", "label").agg(one).select("doc", "label", F.col("one.text").alias("text"))


def quality_scores(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality"
) -> DataFrame:
    """``(doc, score)`` per row of ``docs``: 0 to 1, higher where label 1 is likelier.

    Only the text counts. NULL and empty texts are scored like any other, all the
    same. NULL ids stay NULL; repeated rows get equal scores. Extra columns are
    ignored; without labels every score is 0.5, and an empty table gives an empty
    one.
    """
    sample = labelled_sample(docs, labels, doc_id, text, label)
    rows = sample.mapInArrow(Sampled(), "doc bigint, label double, counts binary").collect()
    rows.sort(key=lambda r: r.doc)  # at most LABELLED; equal cosines then are always cut alike
    counts = np.frombuffer(b"".join(bytes(r.counts) for r in rows), np.float32).reshape(-1, BUCKETS)
    marks = np.array([r.label for r in rows], np.float32)
    empty = Model(np.ones(BUCKETS, np.float32), np.zeros((BUCKETS, LATENT), np.float32), np.zeros((0, LATENT), np.float32), marks)
    model = fit(counts, marks) if len(rows) else empty
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[doc_id].dataType.simpleString()
    texts = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    return texts.mapInArrow(Score(shared), f"doc {kind}, score double")

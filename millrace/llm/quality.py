"""Quality by the votes of labelled neighbours in a latent-semantic space.

A text becomes hashed byte trigrams (logarithmic counts, weighted by rarity) and a
few shares of its characters. The leading singular directions of a bounded
labelled sample make the latent space. Every document is projected in blocks, its
cosine with every labelled vector is one exact matrix product, and the labels of
its nearest neighbours vote, weighted by similarity. Broadcast are the projection
and the labelled vectors, whose sizes are parameters.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.samples import labelled_sample, remainder

#: Labelled rows of each class that the vote uses at most.
PER_CLASS = 2500
#: Hash buckets of trigrams, dimensions of the latent space, neighbours that vote.
BUCKETS, DIMENSIONS, NEIGHBOURS = 1024, 48, 15
#: Documents in one matrix product.
BLOCK = 512
#: Weight of the character shares beside the unit vector of trigrams.
SHARE_WEIGHT = 0.5

_BYTES = np.arange(256)
_CLASSES = np.stack(
    [
        (_BYTES >= 65) & (_BYTES <= 90),
        (_BYTES >= 97) & (_BYTES <= 122),
        (_BYTES >= 48) & (_BYTES <= 57),
        (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)),
        (_BYTES > 32) & (_BYTES < 127) & ~np.isin(_BYTES, np.r_[48:58, 65:91, 97:123]),
        _BYTES >= 128,
    ],
    axis=1,
).astype(np.float32)
SHARES = _CLASSES.shape[1] + 2


def features(text: str | None) -> np.ndarray:
    """Logarithmic trigram counts by bucket, then character shares; all zero for no text."""
    out = np.zeros(BUCKETS + SHARES, np.float32)
    data = (text or "").encode("utf-8", "replace")
    if not data:
        return out
    codes = np.frombuffer(data, np.uint8).astype(np.uint32)
    padded = np.concatenate([[32], codes, [32]]).astype(np.uint32)
    hashed = ((padded[:-2] << 16) | (padded[1:-1] << 8) | padded[2:]) * np.uint32(2654435761)
    counts = np.bincount(hashed >> np.uint32(32 - BUCKETS.bit_length() + 1), minlength=BUCKETS)
    out[:BUCKETS] = np.log1p(counts)
    total = len(codes)
    out[BUCKETS : BUCKETS + SHARES - 2] = np.bincount(codes, minlength=256).astype(np.float32) @ _CLASSES / total
    share = counts / total
    out[-2] = np.sqrt((share * share).sum())
    words = text.split()
    out[-1] = len(set(words)) / len(words) if words else 0
    return out


@dataclass(frozen=True)
class Vote:
    """A fitted voter: arrays of bounded size, as they are broadcast."""

    rarity: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    prior: float

    def project(self, rows: np.ndarray) -> np.ndarray:
        latent = _weighted(rows, self.rarity, self.mean, self.spread) @ self.directions
        return latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)

    def scores(self, texts: Iterable[str | None]) -> Iterator[float]:
        """One score per text: the similarity-weighted share of label 1 among its neighbours; the prior for an empty one."""
        block: list[np.ndarray] = []
        for text in texts:
            block.append(features(text))
            if len(block) == BLOCK:
                yield from self._block(np.stack(block))
                block = []
        if block:
            yield from self._block(np.stack(block))

    def _block(self, rows: np.ndarray) -> list[float]:
        if not len(self.vectors):
            return [self.prior] * len(rows)
        cosine = self.project(rows) @ self.vectors.T
        k = min(NEIGHBOURS, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        similarity = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** 4
        similarity *= self.weights[near]
        total = similarity.sum(1)
        score = np.where(total > 0, (similarity * self.labels[near]).sum(1) / np.maximum(total, 1e-12), self.prior)
        empty = ~rows.any(1)
        return np.clip(np.where(empty, self.prior, score), 0, 1).tolist()


def _weighted(rows: np.ndarray, rarity: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    terms = rows[:, :BUCKETS] * rarity
    terms = terms / np.maximum(np.linalg.norm(terms, axis=1, keepdims=True), 1e-9)
    shares = (rows[:, BUCKETS:] - mean) / spread * (SHARE_WEIGHT / np.sqrt(SHARES))
    return np.concatenate([terms, np.clip(shares, -3, 3)], axis=1)


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality", divisor: int = 5, kept_out: int = 0, per_class: int = PER_CLASS) -> Vote:
    """Learn from a bounded sample of labelled rows, none of the held-out fold.

    Rows with crc32(doc_id) mod ``divisor`` = ``kept_out`` are never read as labels.
    Without labelled rows the voter gives 0.5 to every text.
    """
    training = remainder(F.col("doc_id"), divisor) != kept_out
    sample, counts = labelled_sample(documents, labels, label, training, per_class)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary()), batch.column(2)], names=["doc_id", "vector", "label"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    table = sample.mapInArrow(run, f"doc_id {kind}, vector binary, label int").toArrow().sort_by("doc_id")
    known = table["label"].to_numpy()
    if not len(known):
        empty = np.zeros((0, 1), np.float32)
        return Vote(empty, empty, empty, empty, empty, empty, empty, 0.5)
    rows = np.frombuffer(b"".join(table["vector"].to_pylist()), np.float32).reshape(len(known), -1)
    rarity = np.log((1 + len(rows)) / (1 + (rows[:, :BUCKETS] > 0).sum(0))).astype(np.float32) + 1
    mean, spread = rows[:, BUCKETS:].mean(0), rows[:, BUCKETS:].std(0) + 1e-6
    matrix = _weighted(rows, rarity, mean, spread).astype(np.float64)
    _, vectors = np.linalg.eigh(matrix.T @ matrix)
    directions = vectors[:, ::-1][:, :DIMENSIONS].astype(np.float32)
    total = sum(counts.values())
    weight = {v: (counts.get(v, 0) / total) / max((known == v).mean(), 1e-9) for v in (0, 1)}
    model = Vote(rarity, mean, spread, directions, np.zeros((0, 1)), known.astype(np.float64), np.array([weight[v] for v in known.tolist()]), counts.get(1, 0) / total)
    return Vote(**{**model.__dict__, "vectors": model.project(rows).astype(np.float32)})


def with_scores(documents: DataFrame, model: Vote) -> DataFrame:
    """``doc_id`` and ``score`` of every row, null and empty texts included (they get the prior); repeated rows stay."""
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = list(sent.value.scores(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def classify(documents: DataFrame, labels: DataFrame, threshold: float = 0.3, divisor: int = 5, kept_out: int = 0) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every document.

    Only ``text`` is an input of a score. Tables may be empty, hold nulls, repeated rows and
    other columns: every row of ``documents`` gives one row, and a null doc_id is not held out.
    """
    scored = with_scores(documents, fit(documents, labels, divisor=divisor, kept_out=kept_out))
    return scored.select(
        "doc_id",
        (remainder(F.col("doc_id"), divisor) == kept_out).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(documents: DataFrame, model: Vote, threshold: float = 0.3) -> DataFrame:
    """The documents whose score reaches the threshold, all columns as they were."""
    sent = documents.sparkSession.sparkContext.broadcast(model)
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.fromiter(sent.value.scores(batch.column(at).to_pylist()), np.float64, batch.num_rows)
            yield batch.filter(pa.array(scores >= threshold))

    return documents.mapInArrow(run, documents.schema)

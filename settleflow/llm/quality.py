"""Text quality by nearest-neighbour voting over latent-semantic vectors."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from settleflow.llm.tables import fitted, in_fold, labelled_sample
from settleflow.llm.words import Texts, hashed, lengths_to_rows, pieces

#: Terms of a kind (shape runs, words) after hashing, and latent dimensions.
TERMS, RANK = 2048, 48
#: Most labelled texts of each class, and most characters of all of them.
FIT_ROWS, FIT_CHARS = 2000, 80_000_000
#: Labelled vectors that vote, and the power of the cosine that is a vote's weight.
NEIGHBOURS, SHARPNESS = 25, 8
BLOCK = 256

# Classes of bytes: letters by case, digits, bytes of other letters, spaces, and punctuation sign by sign.
_SHAPE = np.full(256, 3, np.uint32)
_SHAPE[:128] = 4
for _i, _signs in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789")):
    _SHAPE[[ord(c) for c in _signs]] = _i
for _i, _sign in enumerate(" \n.,!?|*$%&#-:/<>{}()=\"'_"):
    _SHAPE[ord(_sign)] = 5 + _i


class Space(NamedTuple):
    """Weights of terms, projection to latent dimensions, labelled vectors and their labels."""

    weight: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    share: float


def terms(texts: Texts) -> np.ndarray:
    """Term counts of every text, dampened: runs of four byte classes, words, and repetition.

    Repetition is counted as terms of its own: words equal to the one before, or seen earlier in the text.
    """
    count = len(texts.offsets) - 1
    out = np.zeros((count, 2 * TERMS + 2), np.float32)
    if len(texts.data) >= 4:
        shape = _SHAPE[texts.data]
        run = (shape[:-3] * np.uint32(32768) + shape[1:-2] * np.uint32(1024) + shape[2:-1] * np.uint32(32) + shape[3:])
        term = ((run * np.uint32(0x9E3779B1)) >> np.uint32(21)).astype(np.int64)
        row = np.repeat(np.arange(count), np.diff(texts.offsets))
        inside = row[:-3] == row[3:]
        key = row[:-3][inside] * TERMS + term[inside]
        out[:, :TERMS] = np.bincount(key, minlength=count * TERMS).reshape(count, TERMS)
    words, bounds = hashed(texts, lower=True)
    if len(words):
        of = lengths_to_rows(bounds)
        key = of * TERMS + (words % np.uint64(TERMS)).astype(np.int64)
        out[:, TERMS : 2 * TERMS] = np.bincount(key, minlength=count * TERMS).reshape(count, TERMS)
        same = (words[1:] == words[:-1]) & (of[1:] == of[:-1])
        out[:, -2] = np.bincount(of[1:][same], minlength=count)
        order = np.lexsort((words, of))
        again = (words[order][1:] == words[order][:-1]) & (of[order][1:] == of[order][:-1])
        out[:, -1] = np.bincount(of[order][1:][again], minlength=count)
    # Shares of the text's length, so that long and short texts of a kind are close.
    size = np.maximum(np.diff(texts.offsets), 1)[:, None].astype(np.float32)
    out[:, :TERMS] /= size
    out[:, TERMS:] /= np.maximum(np.diff(bounds), 1)[:, None]
    return np.sqrt(out)


def project(space: Space, counts: np.ndarray) -> np.ndarray:
    """Unit vectors in the latent space; zero for a text without terms."""
    return _unit((counts * space.weight) @ space.basis)


def _unit(latent: np.ndarray) -> np.ndarray:
    return latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)


def fit(samples: list[tuple[str, int]], seed: int = 3) -> Space:
    """Latent-semantic space of labelled texts: weighted terms, randomised truncated SVD."""
    labels = np.array([label for _, label in samples], np.float32)
    share = float((labels.sum() + 1) / (len(labels) + 2))
    if len(set(labels.tolist())) < 2:
        return Space(np.zeros(0), np.zeros(0), np.zeros((0, RANK), np.float32), labels[:0], share)
    matrix = np.concatenate([terms(texts) for texts in pieces(pa.array([text for text, _ in samples]))])
    present = (matrix > 0).sum(axis=0)
    weight = (np.log((1 + len(matrix)) / (1 + present)) + 0.2).astype(np.float32)
    matrix *= weight
    rng = np.random.default_rng(seed)
    rank = min(RANK, *matrix.shape)
    basis = matrix.T @ (matrix @ rng.normal(size=(matrix.shape[1], rank + 8)).astype(np.float32))
    for _ in range(4):
        basis, _ = np.linalg.qr(matrix.T @ (matrix @ basis))
    _, _, turned = np.linalg.svd(matrix @ basis, full_matrices=False)
    basis = np.ascontiguousarray((basis @ turned.T)[:, :rank], np.float32)
    return Space(weight, basis, _unit(matrix @ basis), labels, share)


def vote(space: Space, vectors: np.ndarray) -> np.ndarray:
    """Mean label of the nearest labelled vectors, weighted by a power of the cosine.

    Exact cosine products of a block of texts with all labelled vectors, two small counts of the share
    of label 1 added so that a text like no labelled one gets that share.
    """
    if not len(space.vectors):
        return np.full(len(vectors), space.share)
    near = min(NEIGHBOURS, len(space.labels))
    score = np.empty(len(vectors))
    for at in range(0, len(vectors), BLOCK):
        cosine = vectors[at : at + BLOCK] @ space.vectors.T
        best = np.argpartition(cosine, len(space.labels) - near, axis=1)[:, -near:]
        weight = np.maximum(np.take_along_axis(cosine, best, axis=1), 0).astype(np.float64) ** SHARPNESS
        score[at : at + BLOCK] = ((weight * space.labels[best]).sum(axis=1) + 0.02 * space.share) / (
            weight.sum(axis=1) + 0.02
        )
    return np.clip(score, 0, 1)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    folds: int = 5,
    fold: int = 0,
    threshold: float = 0.3,
    row: str | None = None,
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` for every document, and the whole input row in ``row`` if that is named.

    At most ``FIT_ROWS`` labelled texts of each class outside the held-out fold span a latent-semantic space
    of ``RANK`` dimensions. Their vectors (2 * FIT_ROWS * RANK floats, under 1 MB) and the projection are
    broadcast; every whole text is projected and its cosine with every labelled vector computed in
    blocks; the nearest ones vote. The sample is fitted in one task, the driver sees only the model. As the sample takes both classes alike, the vote is of balanced
    classes, not of their shares in the data. Scoring is one pass without a shuffle.

    Null and empty texts have no terms and get the share of label 1. Null and other labels than 0 and 1 are not learned from;
    without labels of both classes all scores are that share. A null id counts as held out. Repeated rows give a row
    each; other columns are ignored.
    """
    sample = labelled_sample(docs, labels, label, folds, fold, FIT_ROWS, FIT_CHARS)
    shared = docs.sparkSession.sparkContext.broadcast(fitted(sample, fit))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = shared.value
        for batch in batches:
            whole = batch.column(0)
            for texts in pieces(pc.cast(pc.struct_field(whole, "text"), pa.string()), 1 << 20):
                count = len(texts.offsets) - 1
                score = np.empty(count)
                for at in range(0, count, BLOCK):
                    end = min(at + BLOCK, count)
                    low, high = texts.offsets[at], texts.offsets[end]
                    part = Texts(at, texts.data[low:high], texts.offsets[at : end + 1] - low)
                    vectors = project(space, terms(part)) if len(space.vectors) else np.zeros((end - at, 1))
                    score[at:end] = vote(space, vectors)
                yield pa.RecordBatch.from_arrays([whole.slice(texts.first, count), pa.array(score)], ["_row", "score"])

    carried = docs.columns if row else ["doc_id", "text"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carried]).alias("_row"))
    kind = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())])
    found = rows.mapInArrow(run, kind).select(F.col("_row.doc_id").alias("doc_id"), "score", "_row")
    return found.select(
        "doc_id",
        in_fold(F.col("doc_id"), folds, fold).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        *([F.col("_row").alias(row)] if row else []),
    )

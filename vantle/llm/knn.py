"""Document quality by nearest-neighbour voting in a latent-semantic space.

A document becomes a vector of term shares: hashed byte pairs, bytes, and how much of
it repeats itself (word pairs and lines seen before). Square roots of shares, centred
and weighted, of a bounded labelled sample give a truncated SVD; the sample's latent
vectors and labels are broadcast. Every document is projected the same way, all its
cosines with the sample are computed in blocks, and its nearest neighbours vote with
the fourth power of their similarity as weight.

Only the labelled sample is bounded (labels.MAX_LABELLED, a parameter); every whole
text is scored. Defined results: null text counts as empty and is scored like any
other; without labelled rows the score is 0.5; equal texts have equal scores; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import keep_rows, released, text_batches, texts_of
from .labels import labelled_texts

PAIRS, SHAPES = 1024, 12
WIDTH = PAIRS + 256 + SHAPES
#: Labelled neighbours kept on every worker: with 48 dimensions, 1.2 MB.
MAX_NEIGHBOURHOOD = 6_000
DIMENSIONS, NEIGHBOURS = 48, 15


def term_shares(text: str) -> np.ndarray:
    """Square roots of term shares of one text; each family of terms has length 1."""
    out = np.zeros(WIDTH, np.float32)
    raw = text.encode("utf-8", "surrogatepass")
    b = np.frombuffer(raw, np.uint8)
    if len(b):
        out[PAIRS : PAIRS + 256] = np.sqrt(np.bincount(b, minlength=256) / len(b))
    if len(b) > 1:
        code = b[:-1].astype(np.uint16) << np.uint16(8)
        code |= b[1:]
        code *= np.uint16(0x9E37)  # odd: mixes before the top bits are taken
        code >>= np.uint16(6)
        out[:PAIRS] = np.sqrt(np.bincount(code, minlength=PAIRS) / len(code))
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    shape = out[PAIRS + 256 :]
    if words:
        n = len(words)
        pairs = len(set(zip(words, words[1:], strict=False)))
        again = 1 - pairs / (n - 1) if n > 1 else 0.0
        seen = 1 - len(set(lines)) / len(lines)
        shape[0], shape[1] = 2 * again**0.5, 2 * (1 - again) ** 0.5
        shape[2], shape[3] = seen**0.5, (1 - seen) ** 0.5
        mean = (len(raw) - n) / n
        shape[4] = min(1.0, mean / 20)
    return out


@dataclass
class Neighbourhood:
    """What is broadcast: the projection and the labelled latent vectors."""

    mean: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def scores(self, shares: np.ndarray, k: int, block: int = 256) -> np.ndarray:
        """Similarity-weighted vote of the k nearest labelled vectors for each row."""
        if not len(self.labels):
            return np.full(len(shares), 0.5)
        k = min(k, len(self.labels))
        out = np.empty(len(shares))
        for i in range(0, len(shares), block):
            z = (shares[i : i + block] - self.mean) @ self.projection
            z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)
            cosine = z @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, near, 1), 1e-6).astype(np.float64) ** 4
            out[i : i + block] = (weight * self.labels[near]).sum(1) / weight.sum(1)
        return np.clip(out, 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MAX_NEIGHBOURHOOD, dimensions: int = DIMENSIONS, id_col: str = "doc_id", text_col: str = "text") -> Neighbourhood:
    """Learn the latent space from at most ``most`` labelled texts outside the held-out fifth."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_batches(batches):
            shares = [term_shares(t).astype("<f2").tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(shares, pa.binary())], names=["doc_id", "label", "shares"])

    got = labelled_texts(docs, labels, label, most, id_col, text_col).mapInArrow(released(run), "doc_id long, label int, shares binary").toArrow()
    if not got.num_rows:
        return Neighbourhood(np.zeros(WIDTH, np.float32), np.zeros((WIDTH, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0))
    got = got.sort_by("doc_id")
    x = np.frombuffer(b"".join(got["shares"].to_pylist()), "<f2").reshape(-1, WIDTH).astype(np.float32)
    mean = x.mean(0)
    centred = x - mean
    _, values, axes = np.linalg.svd(centred.T @ centred, hermitian=True)
    keep = max(1, min(dimensions, int((values > values[0] * 1e-6).sum())))
    projection = axes[:keep].T.astype(np.float32)
    z = centred @ projection
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)
    return Neighbourhood(mean, np.ascontiguousarray(projection), np.ascontiguousarray(z), got["label"].to_numpy().astype(np.float64))


def score(df: DataFrame, model: Neighbourhood, neighbours: int = NEIGHBOURS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score double) of every whole text."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_batches(batches):
            shares = np.stack([term_shares(t) for t in texts]) if texts else np.zeros((0, WIDTH), np.float32)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sent.value.scores(shares, neighbours))], names=["doc_id", "score"])

    return texts_of(df, id_col, text_col).mapInArrow(released(run), "doc_id long, score double")


def accept(df: DataFrame, model: Neighbourhood, threshold: float = 0.3, neighbours: int = NEIGHBOURS, text_col: str = "text") -> DataFrame:
    """The rows of df, all columns, whose text scores ``threshold`` or more."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    def decide(texts: list[str]) -> list[bool]:
        return (sent.value.scores(np.stack([term_shares(t) for t in texts]), neighbours) >= threshold).tolist() if texts else []

    return keep_rows(df, decide, text_col)

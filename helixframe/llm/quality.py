"""Quality by nearest-neighbour voting in a latent-semantic space.

A labelled sample is turned into TF-IDF rows over hashed words and token shapes, and a truncated singular
value decomposition gives each a short vector. These vectors are broadcast (their number and length are
fixed parameters); every document is projected the same way, compared with all of them by blocked cosine
products (in single precision), and its nearest neighbours vote, weighted by similarity: NEIGHBOURS of them, or
the square root of the sample's size, if that is less.

Defined results: a null or empty text, or one like no labelled text, gets the mean label; without labels
every score is 0; rows with a null label are not learnt from; equal similarities count in the sample's
order; repeated rows come back as often; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import remembered, text_rows

#: The bounded labelled sample: at most so many documents are learnt from.
SAMPLE_DOCS = 4000
WORD_BUCKETS, SHAPE_BUCKETS, DIMS, NEIGHBOURS = 3072, 1024, 64, 25
#: Share of a row's squared length that shapes have; words have the rest.
SHAPE_SHARE = 0.7
SHAPE_RUNS = 12
THRESHOLD = 0.3
CACHE_TOKENS = 500_000
FEATURES = WORD_BUCKETS + SHAPE_BUCKETS


def shape(token: str) -> str:
    """Runs of capitals, small letters and digits become A, a and 0; other runs keep their sign.

    Of more than SHAPE_RUNS runs their kinds and the order of magnitude of their number are told.
    """
    out = []
    for c in token:
        kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if out and out[-1].rstrip("+") == kind:
            out[-1] = kind + "+"
        else:
            out.append(kind)
    if len(out) > SHAPE_RUNS:
        out = [*sorted(set(out)), "*", str(len(out).bit_length())]
    return "".join(out)


class Features:
    """Counts of hashed words, of shapes, and (last) of tokens like the one before; remembers what each token is."""

    def __init__(self):
        self.cache: dict[str, int] = {}

    def _number(self, token: str) -> int:
        word = zlib.crc32(token.lower().strip(".,;:!?()").encode("utf-8", "replace")) % WORD_BUCKETS
        form = WORD_BUCKETS + zlib.crc32(shape(token).encode("utf-8", "replace")) % (SHAPE_BUCKETS - 1)
        number = self.cache[token] = word * FEATURES + form
        return number

    def counts(self, texts: list[str]) -> np.ndarray:
        if len(self.cache) > CACHE_TOKENS:
            self.cache = {}
        get, make = self.cache.get, self._number
        out = np.zeros((len(texts), FEATURES), np.float32)
        for k, text in enumerate(texts):
            tokens = text.split()
            both = np.fromiter((get(t) or make(t) for t in tokens), np.int64, len(tokens))
            out[k] = np.bincount(both // FEATURES, minlength=FEATURES) + np.bincount(both % FEATURES, minlength=FEATURES)
            out[k, -1] = (both[1:] == both[:-1]).sum()
        return out


@dataclass
class Model:
    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray  # of the labelled sample, of length 1
    labels: np.ndarray
    prior: float


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    for part, share in ((slice(0, WORD_BUCKETS), 1 - SHAPE_SHARE), (slice(WORD_BUCKETS, FEATURES), SHAPE_SHARE)):
        size = np.sqrt((x[:, part] ** 2).sum(axis=1, keepdims=True))
        x[:, part] *= np.sqrt(share) / np.where(size > 0, size, 1)
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.sqrt((x**2).sum(axis=1, keepdims=True))
    return x / np.where(size > 1e-6, size, np.inf)


def learn(texts: list[str], labels: list[int]) -> Model:
    y = np.array(labels, np.float32)
    if not len(y):
        return Model(np.zeros(FEATURES, np.float32), np.zeros((FEATURES, 1), np.float32), np.zeros((0, 1), np.float32), y, 0.0)
    counts = Features().counts(texts)
    idf = (np.log((1 + len(y)) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
    x = _weighted(counts, idf)
    dims = min(DIMS, len(y))
    rng = np.random.default_rng(5)
    basis = x.T @ (x @ rng.normal(size=(FEATURES, min(dims + 16, len(y)))).astype(np.float32))
    for _ in range(3):  # power steps of a randomised decomposition
        basis, _ = np.linalg.qr(x.T @ (x @ basis))
    _, _, right = np.linalg.svd(x @ basis, full_matrices=False)
    projection = (basis @ right.T[:, :dims]).astype(np.float32)
    return Model(idf, projection, _unit(x @ projection), y, float(y.mean()))


class Scorer:
    def __init__(self, model: Model):
        self.model, self.features = model, Features()

    def scores(self, texts: list[str]) -> np.ndarray:
        m = self.model
        out = np.full(len(texts), m.prior)
        k = min(NEIGHBOURS, math.isqrt(len(m.labels)))
        if not k or not texts:
            return out
        near = _unit(_weighted(self.features.counts(texts), m.idf) @ m.projection) @ m.vectors.T
        top = np.argpartition(-near, k - 1, axis=1)[:, :k] if k < near.shape[1] else np.tile(np.arange(k), (len(texts), 1))
        weight = np.maximum(np.take_along_axis(near, top, axis=1), 0).astype(float)
        total = weight.sum(axis=1)
        voted = total > 0
        out[voted] = (weight * m.labels[top])[voted].sum(axis=1) / total[voted]
        return np.clip(out, 0, 1)


def score(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, score."""
    shared, mine = df.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = remembered(mine, lambda: Scorer(shared.value))
        for keys, texts in text_rows(batches, key, text):
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(scorer.scores(texts), pa.float64())], [key, "score"])

    return df.select(F.col(key).cast("bigint").alias(key), text).mapInArrow(scan, f"`{key}` bigint, score double")

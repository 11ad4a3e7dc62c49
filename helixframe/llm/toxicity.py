"""Toxicity: subword-bag embeddings, averaged, into a linear softmax.

A word is the average of the vectors of its character n-grams (and of itself), a stretch of text the average
of its words, and vectors and softmax weights are trained together in numpy. Misspelt words share most
n-grams with words seen in training. Because the softmax is linear, a word's part in the result is one
number, so scoring looks words up and averages.

A text's log-odds are those of its stretches of WINDOW words, averaged by their softmax (of sharpness SHARPNESS),
plus the bias: in training over stretches side by side, in scoring over those at every offset. So a few toxic
words in a long text are not averaged away, and length is no input. One scale and one shift, fitted on labelled
rows that the vectors have not seen, make the log-odds a probability; nothing else stands between them.

Defined results: a null or empty text, or one without a word, gets the share of label 1 among labelled rows; without labels of
both kinds every score is the mean label, or 0; rows with a null label are not learnt from; repeated rows
come back as often; an empty table gives an empty table.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixframe.llm.common import bounded_sample, remembered, slices, text_rows

#: The bounded labelled sample: at most so many documents of either label are learnt from.
SAMPLE_DOCS = {0: 4000, 1: 2000}
BUCKETS, DIMS, STEPS, LEARNING_RATE, SCALE, SHARPNESS = 1 << 17, 4, 60, 0.15, 20, 1.5
#: A word is trained on from so many texts on; rarer ones are scored by the n-grams they share.
LEAST_TEXTS = 4
WINDOW = 4
THRESHOLD = 0.3
#: Tokens that a Python worker remembers before it starts afresh.
CACHE_TOKENS = 300_000

_WORDS = re.compile(r"\w+").findall


def tokens_of(text: str) -> list[str]:
    """Lower-cased tokens; a token repeated in a row counts once."""
    tokens = text.lower().split()
    return [a for a, b in zip(tokens, [None, *tokens], strict=False) if a != b]


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of each word itself and of its n-grams of 3 to 5 characters, ends marked; sorted by word."""
    marked = "".join([f"<{w}>" for w in words])
    codes = np.frombuffer(marked.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    lens = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(lens)
    word_of = np.repeat(np.arange(len(words)), lens)
    left = np.repeat(ends, lens) - np.arange(len(codes))  # characters from here to the word's end
    whole = np.fromiter((zlib.crc32(w.encode("utf-8", "replace")) for w in words), np.int64, len(words)) % BUCKETS
    found, owner, h = [whole], [np.arange(len(words))], np.zeros(len(codes), np.uint64)
    for n in range(1, 6):
        shifted = np.zeros(len(codes), np.uint64)
        shifted[: max(len(codes) - n + 1, 0)] = codes[n - 1 :]
        h = (h ^ shifted) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        if n >= 3:
            at = np.flatnonzero((left >= n) & (lens[word_of] > n))
            found.append((h[at] % np.uint64(BUCKETS)).astype(np.int64))
            owner.append(word_of[at])
    owner_, found_ = np.concatenate(owner), np.concatenate(found)
    order = np.argsort(owner_, kind="stable")
    return owner_[order], found_[order]


@dataclass
class Model:
    weights: np.ndarray  # of each subword bucket: its vector's part in the log-odds
    bias: float = 0.0  # the softmax's own part in them
    scale: float = 1.0  # calibration of the log-odds
    shift: float = 0.0
    prior: float = 0.0  # the score of a text without words
    constant: float | None = None  # the score of everything, where there was nothing to learn


def _mean(values: np.ndarray, which: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Mean of values[which] in runs of lens, all of which are over 0."""
    return (np.add.reduceat(values[which], np.cumsum(lens) - lens, axis=0).T / lens).T


def train_vectors(texts: list[str], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Gradient descent on the softmax loss of each text's pooled stretches: log-odds by bucket, and the bias.

    A text's value is the average of its stretches' values, weighted by their softmax: evenly at first, then
    more and more towards the highest, so that the words that make a text toxic bear the gradient. Both
    classes weigh alike. Vectors (``vectors``) and the linear layer (``softmax``, bias) learn together.
    """
    number: dict[str, int] = {}
    coded = []
    for t in texts:
        words = _WORDS(" ".join(tokens_of(t)))
        coded.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words)))
    seen = np.zeros(len(number), np.int64)
    for c in coded:
        seen[np.unique(c)] += 1
    vocabulary = sorted(w for w, k in number.items() if seen[k] >= LEAST_TEXTS)
    place = np.full(len(number), -1, np.int32)
    place[[number[w] for w in vocabulary]] = np.arange(len(vocabulary))
    coded = [p[p >= 0] for p in (place[c] for c in coded)]
    keep = [k for k, c in enumerate(coded) if len(c)]
    y = labels[keep].astype(float)
    if not keep or y.min() == y.max():
        return np.zeros(BUCKETS, np.float32), 0.0
    words = np.concatenate([coded[k] for k in keep])
    n_words = np.array([len(coded[k]) for k in keep])
    n_stretches = -(-n_words // WINDOW)
    stretch_len = np.full(n_stretches.sum(), WINDOW)
    stretch_len[np.cumsum(n_stretches) - 1] = n_words - (n_stretches - 1) * WINDOW
    stretch_at, doc_at = np.cumsum(stretch_len) - stretch_len, np.cumsum(n_stretches) - n_stretches
    of, grams = subwords(vocabulary)
    n_grams = np.bincount(of, minlength=len(vocabulary))
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    rng = np.random.default_rng(11)
    vectors = rng.normal(0, 0.05, (BUCKETS, DIMS)).astype(np.float32)
    softmax, bias = rng.normal(0, 0.5, (DIMS, 2)), np.zeros(2)
    # How much a subword's gradient varies from text to text by chance; steps are in units of that.
    chance = np.bincount(words, np.repeat((weight / n_words) ** 2, n_words), len(vocabulary)) / n_grams**2
    chance = np.sqrt(np.bincount(grams, np.repeat(chance, n_grams), BUCKETS) + 1e-18)
    speed = np.zeros(BUCKETS)
    for step in range(1, STEPS + 1):
        of_word = _mean(vectors, grams, n_grams)
        # Short stretches count as WINDOW words long, so that one word there is not worth more.
        of_stretch = np.stack([np.add.reduceat(v[words], stretch_at) for v in of_word.T.astype(np.float32)], axis=1) / WINDOW
        value = SCALE * of_stretch @ (softmax[:, 1] - softmax[:, 0])
        sharp = SHARPNESS * (step - 1) / STEPS
        share = np.exp(sharp * (value - np.repeat(np.maximum.reduceat(value, doc_at), n_stretches)))
        share /= np.repeat(np.add.reduceat(share, doc_at), n_stretches)
        odds = np.add.reduceat(share * value, doc_at) + bias[1] - bias[0]
        error = (1 / (1 + np.exp(-np.clip(odds, -30, 30))) - y) * weight
        d_value = SCALE * share * np.repeat(error, n_stretches)
        direction = softmax[:, 1] - softmax[:, 0]
        d_word = np.bincount(words, np.repeat(d_value / WINDOW, stretch_len), len(vocabulary)) / n_grams
        d_vec = np.bincount(grams, np.repeat(d_word, n_grams), BUCKETS) / chance
        speed += 0.2 * (d_vec - speed)
        vectors -= LEARNING_RATE * np.outer(speed / max(np.abs(speed).max(), 1e-12), direction)
        softmax -= LEARNING_RATE * np.outer(d_value @ of_stretch, [-1, 1])
        bias -= error.sum() * np.array([-1, 1])
    return (SCALE * vectors @ (softmax[:, 1] - softmax[:, 0])).astype(np.float32), float(bias[1] - bias[0])


class Scorer:
    """Values of texts under a model; remembers what each token adds."""

    def __init__(self, model: Model):
        self.model, self.cache, self.parts = model, {}, np.zeros(0)

    def values(self, texts: list[str]) -> np.ndarray:
        """The log-odds of each text: its stretches at every offset, averaged by their softmax, and the bias; NaN without words."""
        split = [tokens_of(t) for t in texts]
        if len(self.cache) > CACHE_TOKENS:
            self.cache, self.parts = {}, np.zeros(0)
        new = list({w for ws in split for w in ws if w not in self.cache})
        if new:
            self.cache.update(zip(new, range(len(self.cache), len(self.cache) + len(new)), strict=True))
            self.parts = np.concatenate([self.parts, self._parts(new)])
        out = np.full(len(texts), np.nan)
        for k, ws in enumerate(split):
            v = self.parts[np.fromiter(map(self.cache.__getitem__, ws), np.int64, len(ws))]
            v = v[~np.isnan(v)]
            if len(v):
                total = np.concatenate([[0.0], np.cumsum(v)])
                size = min(WINDOW, len(v))
                odds = (total[size:] - total[:-size]) / WINDOW
                share = np.exp(SHARPNESS * (odds - odds.max()))
                out[k] = share @ odds / share.sum() + self.model.bias
        return out

    def _parts(self, tokens: list[str]) -> np.ndarray:
        """The mean part of a token's words; NaN for one without."""
        split = [[t] if t.isalpha() else _WORDS(t) for t in tokens]
        words, n = [w for ws in split for w in ws], np.fromiter(map(len, split), np.int64, len(split))
        if not words:
            return np.full(len(tokens), np.nan)
        of, grams = subwords(words)
        parts = np.bincount(of, self.model.weights[grams], len(words)) / np.bincount(of, minlength=len(words))
        total = np.bincount(np.repeat(np.arange(len(tokens)), n), parts, len(tokens))
        return np.divide(total, n, out=np.full(len(tokens), np.nan), where=n > 0)

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.model.constant is not None:
            return np.full(len(texts), self.model.constant)
        odds = self.values(texts)
        return np.where(np.isnan(odds), self.model.prior, _probability(self.model.scale * np.nan_to_num(odds) + self.model.shift))


def _probability(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def learn(texts: list[str], labels: list[int], share: float | None = None) -> Model:
    """Vectors and softmax from two thirds of the rows, scale and shift from the rest; ``share``: of label 1 among all labels."""
    y = np.array(labels)
    rest = np.arange(len(y)) % 3 == 2
    if not len(y) or y.min() == y.max() or y[rest].sum() in (0, rest.sum()):
        return Model(np.zeros(BUCKETS, np.float32), constant=float(y.mean()) if len(y) else 0.0)
    model = Model(*train_vectors([t for t, r in zip(texts, rest, strict=True) if not r], y[~rest]))
    scorer, unseen, target = Scorer(model), [t for t, r in zip(texts, rest, strict=True) if r], y[rest]
    odds = np.concatenate([scorer.values(unseen[at : at + 128]) for at in range(0, len(unseen), 128)])
    odds, target = odds[~np.isnan(odds)], target[~np.isnan(odds)]
    if target.sum() in (0, len(target)):
        return Model(model.weights, constant=float(y.mean()))
    share = target.mean() if share is None else share
    weight = np.where(target == 1, share / target.mean(), (1 - share) / (1 - target.mean()))
    mean, spread = odds.mean(), odds.std() + 1e-9
    z, mix = np.stack([np.ones(len(odds)), (odds - mean) / spread], axis=1), np.zeros(2)
    for _ in range(60):  # Newton's method, slightly ridged
        p = _probability(z @ mix)
        h = (z * (weight * p * (1 - p))[:, None]).T @ z + 0.05 * np.eye(2)
        g = z.T @ (weight * (p - target)) + 0.05 * mix
        step = np.array([h[1, 1] * g[0] - h[0, 1] * g[1], h[0, 0] * g[1] - h[1, 0] * g[0]]) / (h[0, 0] * h[1, 1] - h[0, 1] * h[1, 0])
        mix -= np.clip(step, -2, 2)
    model.prior = float(share)
    model.scale, model.shift = float(mix[1] / spread), float(mix[0] - mix[1] * mean / spread)
    return model


def labelled(documents: DataFrame, labels: DataFrame, label: str, most: int | dict[int, int], key: str = "doc_id", text: str = "text") -> tuple[list[str], list[int]]:
    """Texts and labels of a bounded sample, of either label if ``most`` tells them apart.

    Only the sample's ids are broadcast, so ``documents`` is not shuffled.
    """
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label"))
    if isinstance(most, dict):
        parts = [bounded_sample(known.where(F.col("_label") == k), "_key", n) for k, n in most.items()]
        ids = parts[0].unionByName(parts[1])
    else:
        ids = bounded_sample(known, "_key", most)
    rows = documents.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text")).join(F.broadcast(ids), "_key").select("_key", "_label", "_text").collect()
    rows.sort(key=lambda r: (zlib.crc32(str(r[0]).encode()), r[0], r[1], r[2]))
    return [r[2] for r in rows], [r[1] for r in rows]


def share_of_ones(labels: DataFrame, label: str) -> float | None:
    """The share of label 1 among all labelled rows."""
    return labels.where(F.col(label).isin(0, 1)).agg(F.avg(F.col(label).cast("double"))).first()[0]


def score(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, score."""
    shared, mine = df.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = remembered(mine, lambda: Scorer(shared.value))
        for keys, texts in text_rows(batches, key, text):
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(scorer.scores(texts), pa.float64())], [key, "score"])

    return df.select(F.col(key).cast("bigint").alias(key), text).mapInArrow(scan, f"`{key}` bigint, score double")


def add_score(df: DataFrame, model: Model, text: str = "text", name: str = "toxicity_score") -> DataFrame:
    """``df`` with one more column, the score of ``text``; rows stay where they are. ``name`` must be new."""
    shared, mine = df.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = remembered(mine, lambda: Scorer(shared.value))
        for part in slices(batches, text):
            scores = scorer.scores([t or "" for t in part.column(part.schema.get_field_index(text)).to_pylist()])
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], [*part.schema.names, name])

    return df.mapInArrow(scan, T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())]))

"""Near-duplicate texts by improved consistent weighted sampling over TF-IDF shingles.

1. Texts with the same words are one class: only its least key goes on.
2. A shingle is five words; its weight is its count times its inverse document frequency, 1 + ln (N / n): N texts
   are counted, of which n hold it. All shingles are counted, however rare, and no frequency is clipped. Of a group
   of copies one text is counted: else what its members share would weigh less than their edits, and a large group
   would be lost. Which texts those are is told by sketches (one permutation, BINS bins): a text isn't counted if it
   shares one of SKETCH_BANDS bands with a text of smaller hash, and ALIKE of all bins with the least in that band.
   ALIKE is far below the threshold, as two copies of one text share less with each other than either with it: were
   only the nearer ones told, the rest of a large group would be counted, and its edited copies lost.
   Texts lie in chunks of about CHUNK words, which are kept as numbers in the chunk's list of words' hashes. A chunk's
   distinct shingles are dealt to buckets by hash, counted there (told by 48 bits of hash), and the counts travel back
   to the chunk in the same order.
3. Each class is sampled BANDS x ROWS times (improved consistent weighted sampling); classes that agree in
   a band, and whose total weights allow the similarity (a class is in two neighbouring cells of weight),
   are proposed to each other.
4. In such a bucket everything is compared with the bucket's least class first. What is too far from it is
   compared with what it can still be near to, as distances (1 - weighted Jaccard similarity) obey the
   triangle inequality, in blocks of bounded size, and only until it is known to belong to a component. No
   pair that shares a bucket and could connect two components is left out; pairs within one aren't listed.
5. Pairs are verified by exact weighted Jaccard similarity, and united into components.

Two texts at similarity s meet in some band with probability 1 - (1 - s^ROWS)^BANDS: 99.5 % at 0.8, 99.95 % at 0.85.

Defined results: a null or empty text, or one without a word, is a duplicate of nothing; a text of fewer
than five words is one shingle; repeated rows share a class; of equals the least key is kept; other columns
are not read; an empty table gives an empty table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.llm.bpe import pack_all, pack_bytes, pack_ints, take_runs, unpack_all, unpack_bytes, unpack_ints
from helixframe.llm.common import discard, materialize, remembered, slices, text_rows
from helixframe.llm.graph import connected_components

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 10, 4
#: Sketches that tell which texts are copies while documents are counted: bins, bands of them, and the share that agrees.
BINS, SKETCH_BANDS, ALIKE = 80, 20, 0.3
#: Words that a chunk of texts holds, shingles that a bucket holds on average, and bits of a row's place in its chunk.
CHUNK, BUCKET, PLACE = 1_500_000, 2_000_000, 20
#: What is far from its bucket's centre is compared in blocks of about so many rows, and shingles, at most.
BLOCK_ROWS, BLOCK_SHINGLES = 512, 2_000_000
#: Signs that are no part of a word at its ends.
SIGNS = ".,;:!?*$%&#|()[]{}\"'<>/\\-_=+~^`"

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingler:
    """64-bit hashes of shingles of many texts at a time; remembers tokens' hashes."""

    def __init__(self):
        self.cache: dict[str, int] = {}

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all texts' words, one after another, and how many each text has."""
        import xxhash

        split = [t.lower().split() for t in texts]
        if len(self.cache) > 300_000:
            self.cache = {}
        cache = self.cache
        for token in {w for ws in split for w in ws if w not in cache}:
            bare = token.strip(SIGNS)
            cache[token] = (xxhash.xxh64_intdigest(bare.encode("utf-8", "replace")) | 1) if bare else 0
        get = cache.__getitem__
        out = np.fromiter((h for ws in split for h in map(get, ws)), np.uint64, sum(map(len, split)))
        text_of = np.repeat(np.arange(len(texts)), [len(ws) for ws in split])
        real = out != 0
        return out[real], np.bincount(text_of[real], minlength=len(texts))

    def distinct(self, words: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each text's distinct shingles in order, their counts, and how many each text has."""
        starts = np.cumsum(lens) - lens
        if not len(words):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(lens), np.int64)
        rolled = np.zeros(len(words), np.uint64)
        for k in range(WORDS):
            shifted = np.zeros(len(words), np.uint64)
            shifted[: max(len(words) - k, 0)] = words[k:]
            rolled = _scramble(rolled + shifted + _MIX)
        sizes = np.where(lens >= WORDS, lens - WORDS + 1, np.minimum(lens, 1))
        ends = np.cumsum(sizes)
        at = np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1])
        shingles = rolled[at]
        for k in np.flatnonzero((lens > 0) & (lens < WORDS)).tolist():  # a short text is one shingle of its own words
            h = np.zeros(1, np.uint64)
            for w in words[starts[k] : starts[k] + lens[k]]:
                h = _scramble(h + w + _MIX)
            shingles[ends[k] - 1] = h[0]
        first = np.zeros(len(shingles) + 1, bool)
        first[ends - sizes] = True
        for lo, hi in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
            shingles[lo:hi].sort()
        first[:-1][1:] |= shingles[1:] != shingles[:-1]
        first[-1] = False
        new = np.flatnonzero(first)
        counts = np.diff(np.append(new, len(shingles)))
        text_of = np.repeat(np.arange(len(lens)), sizes)
        return shingles[new], counts, np.bincount(text_of[new], minlength=len(lens))

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.distinct(*self.words(texts))


def idf(documents: int, found: np.ndarray) -> np.ndarray:
    """Inverse document frequency of shingles that so many of the counted documents hold; one that none holds is as rare as can be."""
    return 1 + np.log(np.maximum(documents / np.maximum(found, 1), 1))


class Weights:
    """Inverse document frequencies of all shingles, given how many documents hold each that more than one holds."""

    def __init__(self, documents: int, frequent: dict[int, int]):
        self.hashes = np.array(sorted(frequent), np.uint64)
        self.rare = float(idf(max(documents, 1), np.ones(1))[0])
        self.idf = idf(documents, np.array([frequent[int(h)] for h in self.hashes], float))

    def of(self, shingles: np.ndarray) -> np.ndarray:
        out = np.full(len(shingles), self.rare)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, shingles), len(self.hashes) - 1)
            hit = self.hashes[at] == shingles
            out[hit] = self.idf[at[hit]]
        return out


def sketches(shingles: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """16 bits of the least of each text's shingles in each of BINS ranges of hashes, a row a text; an empty bin takes its next one's."""
    out = np.zeros((len(lens), BINS), np.uint16)
    some = np.flatnonzero(lens)
    if not len(some):
        return out
    bins = (((shingles >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)).astype(np.int64)
    at = np.repeat(np.arange(len(some)), lens[some]) * BINS + bins  # in order, as a text's shingles are
    first = np.flatnonzero(np.diff(at, prepend=-1))
    held, values = np.full(len(some) * BINS, BINS), np.zeros(len(some) * BINS, np.uint16)
    held[at[first]] = at[first] % BINS
    values[at[first]] = (shingles[first] & np.uint64(0xFFFF)).astype(np.uint16)
    held, values = held.reshape(-1, BINS), values.reshape(-1, BINS)
    following = np.minimum.accumulate(held[:, ::-1], axis=1)[:, ::-1]
    following = np.where(following == BINS, held.min(axis=1)[:, None], following)
    out[some] = np.take_along_axis(values, following, axis=1)
    return out


def sketch_bands(sketch: np.ndarray) -> np.ndarray:
    """A hash for each band of a sketch: every SKETCH_BANDS-th bin, so that a short text's are not one shingle."""
    out = np.zeros((len(sketch), SKETCH_BANDS), np.uint64)
    for k in range(BINS // SKETCH_BANDS):
        out = _scramble(out + sketch[:, k * SKETCH_BANDS : (k + 1) * SKETCH_BANDS].astype(np.uint64) + _MIX)
    return out


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Gamma(2, 1) quantiles at 65,536 even steps, and their logs, by Newton's method on 1 - (1 + x) exp(-x)."""
    p = (np.arange(65536) + 0.5) / 65536
    x = np.sqrt(2 * p) + p
    for _ in range(60):
        x = np.maximum(x - (1 - (1 + x) * np.exp(-x) - p) / (x * np.exp(-x) + 1e-300), 1e-9)
    return x.astype(np.float32), np.log(x).astype(np.float32)


_GAMMA, _LOG_GAMMA = _tables()


def signatures(shingles: np.ndarray, log_weight: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Band hashes of texts whose distinct shingles start at ``starts``: a row for each band."""
    low, lens = np.uint64(0xFFFF), np.diff(np.append(starts, len(shingles)))
    bands = np.zeros((BANDS, len(starts)), np.uint64)
    log_weight = log_weight.astype(np.float32)
    for k in range(BANDS * ROWS):
        h = (shingles ^ np.uint64((k + 1) * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x94D049BB133111EB)
        r = _GAMMA[(h >> np.uint64(48)).astype(np.intp)]
        beta = (((h >> np.uint64(16)) & low).astype(np.float32)) * np.float32(1 / 65536)
        t = np.floor(log_weight / r + beta)
        a = _LOG_GAMMA[((h >> np.uint64(32)) & low).astype(np.intp)] - r * (t - beta + 1)
        least = np.minimum.reduceat(a, starts)
        # The first of a text's shingles that has the least value; equal shingles have equal values in any text.
        hit = np.flatnonzero(a == np.repeat(least, lens))
        first = hit[np.searchsorted(hit, starts)]
        sample = _scramble(shingles[first] + t[first].astype(np.int64).astype(np.uint64) * _MIX)
        bands[k // ROWS] = _scramble(bands[k // ROWS] + sample + _MIX)
    return bands


def pack_words(words: np.ndarray, lens: np.ndarray) -> bytes:
    """Words' hashes of texts, one after another, as numbers in the list of the different ones."""
    named = pa.array(words.view(np.int64), pa.int64()).dictionary_encode()
    return pack_all(pack_bytes(named.dictionary.to_numpy().tobytes()), pack_ints(named.indices.to_numpy()), pack_ints(lens))


def unpack_words(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    names, numbers, lens = unpack_all(blob)
    return np.frombuffer(unpack_bytes(names), np.uint64)[unpack_ints(numbers)], unpack_ints(lens).astype(np.int64)


def _read(docs: DataFrame, mine: str) -> DataFrame:
    """A row for each of ``docs``: uid (its chunk and its place there), doc_id, h (hash of its words), size (number of
    its distinct shingles), sketch and marks (that's bands), the last four null for a text without words; and a row for
    each chunk: chunk, words."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        names = ["uid", "doc_id", "h", "size", "sketch", "marks", "chunk", "words"]
        shingler, chunk = remembered(mine, Shingler), TaskContext.get().partitionId() << 23
        held, place, n = [], 0, 0

        def packed() -> pa.RecordBatch:
            none = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64()))]
            blob = pack_words(*(np.concatenate(x) for x in zip(*held, strict=True)))
            return pa.RecordBatch.from_arrays([*none, pa.array([chunk], pa.int64()), pa.array([blob], pa.binary())], names)

        for keys, texts in text_rows(batches, "doc_id"):
            words, n_words = shingler.words(texts)
            shingles, _, lens = shingler.distinct(words, n_words)
            ends, empty = np.cumsum(n_words), n_words == 0
            h = [xxhash.xxh3_128_digest(words[lo:hi].tobytes()) if hi > lo else None for lo, hi in zip((ends - n_words).tolist(), ends.tolist(), strict=True)]
            sketch = sketches(shingles, lens)
            marks = list(sketch_bands(sketch).view(np.int64))
            rows = [pa.array((chunk << PLACE) + np.arange(place, place + len(texts)), pa.int64()), pa.array(keys, pa.int64()), pa.array(h, pa.binary()), pa.array(lens, pa.int64(), mask=empty)]
            rows += [pa.array([None if e else r.tobytes() for r, e in zip(sketch, empty, strict=True)], pa.binary()), pa.array([None if e else m for m, e in zip(marks, empty, strict=True)], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*rows, pa.nulls(len(texts), pa.int64()), pa.nulls(len(texts), pa.binary())], names)
            held.append((words, n_words))
            place, n = place + len(texts), n + len(words)
            if n >= CHUNK or place >= 1 << PLACE - 1:
                yield packed()
                chunk, held, place, n = chunk + 1, [], 0, 0
        if held:
            yield packed()

    return docs.select("doc_id", "text").mapInArrow(read, "uid bigint, doc_id bigint, h binary, size bigint, sketch binary, marks array<bigint>, chunk bigint, words binary")


def _copies(texts: DataFrame) -> DataFrame:
    """(t): texts that aren't counted, as one of smaller hash is like them. Nothing here depends on keys."""
    marks = texts.select("t", F.posexplode("marks").alias("band", "hash"))
    shared = materialize(marks.groupBy("band", "hash").agg(F.min("t").alias("m"), F.count("*").alias("n")).where("n > 1").select("band", "hash", "m"), "sketch-buckets")
    pairs = materialize(marks.join(shared, ["band", "hash"]).where("t > m").select("t", "m").distinct(), "sketch-pairs")
    leaders = materialize(texts.join(pairs.select(F.col("m").alias("t")).distinct(), "t", "left_semi").select(F.col("t").alias("m"), F.col("sketch").alias("other")), "leaders")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, BINS) for k in (1, 2))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array((one == two).mean(axis=1) >= ALIKE))], ["t"])

    compared = pairs.join(texts.select("t", "sketch"), "t").join(leaders, "m").select("t", "sketch", "other")
    copies = materialize(compared.mapInArrow(compare, "t bigint").distinct(), "copies-of-texts")
    discard(shared)
    return copies


def _deltas(values: np.ndarray) -> bytes:
    """Numbers in order as differences, each byte of them in a plane of its own."""
    return pack_bytes(np.diff(values, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes())


def _undone(blob: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(unpack_bytes(blob), np.uint8).reshape(8, -1).T.copy().view("<u8").reshape(-1), dtype=np.uint64)


def _in_order(shingles: np.ndarray) -> np.ndarray:
    """The distinct ones in order; sorted, as hashing them is slower."""
    out = np.sort(shingles)
    return out[np.append(True, out[1:] != out[:-1])] if len(out) else out


def _shingled(chunk: pa.Table, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles, counts and lengths of the texts at those places of a chunk."""
    words, lens = unpack_words(chunk.column("words")[0].as_py())
    return Shingler().distinct(take_runs(words, np.cumsum(lens) - lens, lens, places), lens[places])


def _by_chunk(rows: DataFrame, buckets: int):
    return rows.repartition(buckets, "chunk").groupBy("chunk")


def _dealt(chunks: DataFrame, told: DataFrame, buckets: int) -> DataFrame:
    """(bucket, chunk, payload): each chunk's distinct shingles by bucket, with the numbers of its counted texts that hold them."""
    names, types = ["bucket", "chunk", "payload"], [pa.int64(), pa.int64(), pa.binary()]

    def deal(chunk: pa.Table, texts: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return pa.Table.from_arrays([pa.nulls(0, t) for t in types], names)
        shingles, _, lens = _shingled(chunk, texts.column("place").to_numpy())
        every = _in_order(shingles)
        counted = np.sort(shingles[np.repeat(texts.column("counted").to_numpy(), lens)])
        found = np.bincount(np.searchsorted(every, counted), minlength=len(every))
        ends = np.searchsorted(((every >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32), np.arange(buckets, dtype=np.uint64), side="right")
        starts = np.append(0, ends[:-1])
        some = np.flatnonzero(ends > starts)
        payloads = [pack_all(_deltas(every[lo:hi] >> np.uint64(16)), pack_ints(found[lo:hi])) for lo, hi in zip(starts[some].tolist(), ends[some].tolist(), strict=True)]
        return pa.Table.from_arrays([pa.array(some, pa.int64()), pa.array([chunk.column("chunk")[0].as_py()] * len(some), pa.int64()), pa.array(payloads, pa.binary())], names)

    dealt = _by_chunk(chunks, buckets).cogroup(_by_chunk(told.select("chunk", "place", "counted"), buckets)).applyInArrow(deal, "bucket bigint, chunk bigint, payload binary")
    return dealt.repartition(buckets, "bucket")


def _frequencies(group: pa.Table) -> pa.Table:
    """A bucket's counts over all chunks, for each chunk in the order of its shingles."""
    parts = [unpack_all(p) for p in group.column("payload").to_pylist()]
    shingles = [_undone(p[0]) for p in parts]
    ends = np.cumsum([len(s) for s in shingles]).tolist()
    shingles, found = np.concatenate(shingles), np.concatenate([unpack_ints(p[1]) for p in parts]).astype(np.int64)
    order = np.argsort(shingles, kind="stable")
    new = np.flatnonzero(np.append(True, shingles[order][1:] != shingles[order][:-1]))
    total = np.empty(len(order), np.int64)
    total[order] = np.repeat(np.add.reduceat(found[order], new), np.diff(np.append(new, len(order))))
    out = [pack_ints(total[lo:hi]) for lo, hi in zip([0, *ends[:-1]], ends, strict=True)]
    return pa.table({"chunk": group.column("chunk"), "bucket": group.column("bucket"), "payload": pa.array(out, pa.binary())})


def _weighted(chunks: DataFrame, told: DataFrame, documents: int, buckets: int, threshold: float) -> DataFrame:
    """(uid, class, size, cell, bands, found): number of a text's distinct shingles, cell of its total weight, its band hashes, and how many of the counted documents hold each of its shingles.

    ``told``: (chunk, place, class, counted) of every text.
    """
    names = ["uid", "class", "size", "cell", "bands", "found"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.binary()]

    def weigh(chunk: pa.Table, known: pa.Table) -> pa.Table:
        counts, texts = (known.filter(known.column(c).is_valid()) for c in ("bucket", "place"))
        if not texts.num_rows:
            return pa.Table.from_arrays([pa.nulls(0, t) for t in types], names)
        places, payloads = texts.column("place").to_numpy(), counts.column("payload").to_pylist()
        found = np.concatenate([unpack_ints(payloads[k]) for k in np.argsort(counts.column("bucket").to_numpy()).tolist()])
        shingles, times, lens = _shingled(chunk, places)
        found = found[np.searchsorted(_in_order(shingles), shingles)]
        ends = np.cumsum(lens)
        starts, cells, bands = ends - lens, [], []
        for lo in range(0, len(lens), 256):  # samples take some memory
            a, b = int(starts[lo]), int(ends[min(lo + 256, len(lens)) - 1])
            weight, own = times[a:b] * idf(documents, found[a:b]), starts[lo : lo + 256] - a
            bands.extend(signatures(shingles[a:b], np.log(weight), own).view(np.int64).T)
            cells.append(np.floor(np.log(np.add.reduceat(weight, own)) / -np.log(threshold - 1e-6)))
        blobs = [found[lo:hi].astype("<u4").tobytes() for lo, hi in zip(starts.tolist(), ends.tolist(), strict=True)]
        uid = (chunk.column("chunk")[0].as_py() << PLACE) + places
        columns = [pa.array(uid, pa.int64()), texts.column("class").combine_chunks(), pa.array(lens, pa.int32()), pa.array(np.concatenate(cells), pa.int32()), pa.array(bands, pa.list_(pa.int64())), pa.array(blobs, pa.binary())]
        return pa.Table.from_arrays(columns, names)

    counts = _dealt(chunks, told, buckets).groupBy("bucket").applyInArrow(_frequencies, "chunk bigint, bucket bigint, payload binary")
    known = counts.unionByName(told.select("chunk", "place", "class"), allowMissingColumns=True)
    return _by_chunk(chunks, buckets).cogroup(_by_chunk(known, buckets)).applyInArrow(weigh, "uid bigint, class bigint, size int, cell int, bands array<bigint>, found binary")


def _sampled(docs: DataFrame, threshold: float, mine: str) -> tuple[DataFrame, DataFrame, DataFrame, int, int]:
    """What ``_read`` and ``_weighted`` give, stored; the least key and its row of each text with words; and the numbers of counted documents and of buckets."""
    base = materialize(_read(docs, mine), "words")
    known = base.where("h is not null and doc_id is not null")
    least = materialize(known.groupBy("h").agg(F.min("doc_id").alias("class"), F.min_by("uid", "doc_id").alias("uid"), F.max("size").alias("size")).withColumn("t", F.xxhash64("h")), "texts")
    copies = _copies(base.where("h is not null").select("uid", "sketch", "marks").join(least.select("uid", "t"), "uid"))
    total, n = least.agg(F.sum("size"), F.count("*")).first()
    documents = n - copies.count()
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(total or 0) // BUCKET))
    told = least.join(copies.withColumn("copy", F.lit(True)), "t", "left").select(*_at(), "class", F.col("copy").isNull().alias("counted"))
    weighted = materialize(_weighted(_chunks(base), materialize(told, "places"), documents, buckets, threshold), "bands")
    discard(copies)
    return base, weighted, least, documents, buckets


def _chunks(base: DataFrame) -> DataFrame:
    return base.where("chunk is not null").select("chunk", "words")


def _at() -> tuple[Column, Column]:
    """A row's chunk and its place there."""
    return F.shiftright("uid", PLACE).alias("chunk"), F.col("uid").bitwiseAND((1 << PLACE) - 1).alias("place")


def _features(chunks: DataFrame, asked: DataFrame, documents: int, buckets: int) -> DataFrame:
    """(class, features): distinct shingles and their weights, sorted by shingle; of (uid, class, found)."""

    def build(chunk: pa.Table, texts: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return pa.table({"class": pa.nulls(0, pa.int64()), "features": pa.nulls(0, pa.binary())})
        shingles, counts, lens = _shingled(chunk, texts.column("place").to_numpy())
        found = np.frombuffer(b"".join(texts.column("found").to_pylist()), "<u4")
        weight, ends = (counts * idf(documents, found)).astype("<f4"), np.cumsum(lens)
        out = [shingles[lo:hi].tobytes() + weight[lo:hi].tobytes() for lo, hi in zip((ends - lens).tolist(), ends.tolist(), strict=True)]
        return pa.table({"class": texts.column("class"), "features": pa.array(out, pa.binary())})

    return _by_chunk(chunks, buckets).cogroup(_by_chunk(asked.select(*_at(), "class", "found"), buckets)).applyInArrow(build, "class bigint, features binary")


def weights(df: DataFrame) -> Weights:
    """The weights as one object, for small tables: the driver gets every shingle. ``near_duplicates`` never asks for it."""
    docs = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    base, weighted, _, documents, _ = _sampled(docs, THRESHOLD, uuid.uuid4().hex)
    chunks = {r.chunk: unpack_words(bytes(r.words)) for r in _chunks(base).collect()}
    found: dict[int, int] = {}
    for chunk, place, counts in weighted.select(*_at(), "found").collect():
        words, lens = chunks[chunk]
        own = words[lens[:place].sum() : lens[: place + 1].sum()]
        found.update(zip(Shingler().distinct(own, np.array([len(own)]))[0].tolist(), np.frombuffer(counts, "<u4").tolist(), strict=True))
    return Weights(documents, {s: n for s, n in found.items() if n > 1})


def read_features(blob: bytes) -> tuple[np.ndarray, np.ndarray, float]:
    """Shingles in order, their weights, and the sum of these."""
    n = len(blob) // 12
    weight = np.frombuffer(blob, "<f4", n, 8 * n).astype(float)
    return np.frombuffer(blob, np.uint64, n), weight, float(weight.sum())


def _similar(one: tuple[np.ndarray, np.ndarray, float], two: tuple[np.ndarray, np.ndarray, float]) -> float:
    if not len(one[0]) or not len(two[0]):
        return 0.0
    at = np.minimum(np.searchsorted(two[0], one[0]), len(two[0]) - 1)
    hit = two[0][at] == one[0]
    both = float(np.minimum(one[1][hit], two[1][at[hit]]).sum())
    return both / max(one[2] + two[2] - both, 1e-300)


def similarity(one: bytes, two: bytes) -> float:
    """Weighted Jaccard similarity of two feature blobs."""
    return _similar(read_features(one), read_features(two))


def _verified(pairs: DataFrame, features: DataFrame) -> DataFrame:
    """Adds the distance of each distinct pair (a, b)."""
    one = features.select(F.col("class").alias("a"), F.col("features").alias("fa"))
    two = features.select(F.col("class").alias("b"), F.col("features").alias("fb"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "fa"):  # what is much longer on one side can't be near, and is short-lived
            d = [1 - similarity(part.column(2)[k].as_py(), part.column(3)[k].as_py()) for k in range(part.num_rows)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(d, pa.float64())], ["a", "b", "distance"])

    return pairs.join(one, "a").join(two, "b").select("a", "b", "fa", "fb").mapInArrow(measure, "a bigint, b bigint, distance double")


def _connect(group: pa.Table, most: float) -> pa.Table:
    """(a, b): links between open rows, and between them and rows near the centre, that join what isn't joined yet."""
    open_, distance, block = (group.column(c).to_numpy(zero_copy_only=False) for c in ("open", "distance", "block"))
    ids = group.column("class").to_numpy()
    lo, hi = group.column("lo")[0].as_py(), group.column("hi")[0].as_py()
    features = [read_features(f) for f in group.column("features").to_pylist()]
    root = list(range(len(ids) + 1))  # the last stands for the centre's component

    def find(v: int) -> int:
        while root[v] != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    for k in np.flatnonzero(~open_).tolist():
        root[k] = len(ids)
    out: list[tuple[int, int]] = []
    total = np.array([f[2] for f in features])
    for u in np.flatnonzero(open_).tolist():
        gap = np.abs(distance - distance[u])
        fits = (gap <= most + 1e-6) & (np.minimum(total, total[u]) >= (1 - most - 1e-6) * np.maximum(total, total[u]))
        fits &= block == (hi if block[u] == lo else lo)
        near = np.flatnonzero(fits)
        for c in near[np.argsort(gap[near], kind="stable")].tolist():
            if c != u and (not open_[c] or ids[c] > ids[u] or lo != hi) and find(u) != find(c) and 1 - _similar(features[u], features[c]) <= most:
                root[find(u)] = find(c)
                out.append((int(ids[u]), int(ids[c])))
    return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})


def _links(buckets: DataFrame, features: DataFrame, most: float) -> DataFrame:
    """(a, b) within ``most`` that connect everything that shares a bucket and can be connected.

    ``buckets``: (class, size, bucket), stored. A row is open if it is too far from its bucket's centre. What
    is known of each bucket is stored before it is joined, so that Spark can broadcast it or split a hot bucket.
    """
    slack = most + 1e-6
    centres = materialize(buckets.groupBy("bucket").agg(F.min("class").alias("centre")), "centres")
    asked = materialize(buckets.join(centres, "bucket").where(F.col("class") != F.col("centre")).select("bucket", "size", "class", F.col("centre").alias("a"), F.col("class").alias("b")), "bucket-rows")
    measured = materialize(_verified(asked.select("a", "b").distinct(), features), "verified")
    near = measured.where(F.col("distance") <= most).select("a", "b")
    told = asked.join(measured, ["a", "b"]).withColumn("open", F.col("distance") > most)
    span = materialize(told.where("open").groupBy("bucket").agg(F.min("distance").alias("least"), F.max("distance").alias("highest")), "open-buckets")
    left = told.join(span, "bucket").where(F.col("open") | F.col("distance").between(F.col("least") - slack, F.col("highest") + slack))
    left = materialize(left.select("bucket", "class", "size", "open", "distance"), "left-over")
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK_ROWS, F.sum(F.col("size").cast("bigint")) / BLOCK_SHINGLES)).cast("int")
    sizes = materialize(left.groupBy("bucket").agg(blocks.alias("blocks")), "block-counts")
    dealt = left.join(sizes, "bucket").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("bucket", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "class", "open", "distance").join(features, "class")
    found = dealt.groupBy("bucket", "lo", "hi").applyInArrow(lambda g: _connect(g, most), "a bigint, b bigint")
    return near.unionByName(found).distinct()


def near_duplicates(df: DataFrame, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, class_id (the least key of the component), kept (whether it is that row).

    Rows with one key in common are treated as one document; a row with a null key is a class of its own.
    """
    docs = df.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    base, weighted, least, documents, buckets = _sampled(docs, threshold, uuid.uuid4().hex)
    members = materialize(base.where("uid is not null").select("doc_id", "h").join(least.select("h", "class"), "h", "left").select("doc_id", F.coalesce("class", "doc_id").alias("class")), "text-classes")
    each = weighted.select("class", "size", "cell", F.posexplode("bands").alias("band", "hash"))
    # A similarity of the threshold needs total weights in the same or neighbouring cells: every class is in two.
    placed = each.select("class", "size", F.explode(F.array(F.col("cell"), F.col("cell") + 1)).alias("cell"), "band", "hash").select("class", "size", F.xxhash64("band", "hash", "cell").alias("bucket")).distinct()
    told_by = {"n": F.count("*"), "one": F.bit_xor(F.xxhash64("class")), "two": F.bit_xor(F.xxhash64(F.lit(1), "class")), "least": F.min("class"), "most": F.max("class")}
    shared = placed.groupBy("bucket").agg(*(v.alias(k) for k, v in told_by.items())).where("n > 1")
    # Of buckets that hold the same classes one is enough; such are told by size, ends and 128 bits of their members' hashes.
    unique = materialize(shared.groupBy(*told_by).agg(F.min("bucket").alias("bucket")).select("bucket"), "shared-buckets")
    rows = materialize(placed.join(unique, "bucket"), "buckets")
    # Stored, so that Spark knows its size and shuffles documents only for a long list.
    wanted = materialize(rows.select("class").distinct(), "wanted")
    asked = materialize(weighted.join(wanted, "class", "left_semi").select("uid", "class", "found"), "wanted-counts")
    features = materialize(_features(_chunks(base), asked, documents, buckets), "features")
    discard(base, asked)
    # Different texts of one key are one document.
    several = members.where("doc_id is not null").groupBy("doc_id").agg(F.min("class").alias("a"), F.max("class").alias("b")).where("a < b").select("doc_id", "a")
    same = members.join(several, "doc_id").where("class <> a").select("a", F.col("class").alias("b"))
    components = connected_components(_links(rows, features, 1 - threshold).unionByName(same))
    discard(weighted, features)
    out = members.join(components.select(F.col("node").alias("class"), "component"), "class", "left")
    out = out.select(F.col("doc_id").alias(key), F.coalesce("component", "class").alias("class_id"))
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("class_id"), F.lit(True)))

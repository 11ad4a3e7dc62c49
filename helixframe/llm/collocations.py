"""Phrases of two or three words that occur together more than chance, by language, counted in HAT-tries.

1. Each partition cuts its texts into pieces and words, and keeps a chunk of them as numbers in the chunk's own
   list of words. The words, with their counts, are dealt to buckets by hash, one packed row for each bucket.
2. A bucket adds up its words. A phrase occurs no more often than its words, so only words with enough occurrences
   get an id; ids travel back to the chunks, and rarer words cut a piece in two.
3. A chunk counts its phrases in a HAT-trie: a level of first words above hash containers of what follows, which
   burst into hybrid ones, by shares of the second words, when they grow. When the trie is full, its largest subtrees are spilled whole,
   as sorted runs. Runs are dealt to partitions by the phrase's prefix: its first two words, and of the third word
   a few bits, so that one very frequent pair is spread. Each partition merges its runs.
4. Phrases with enough occurrences are far fewer; the rest is joins of these with the counts of their parts, which
   are as frequent, so none is missing. Scores are divisions of 38-digit decimals.

Defined results: a null text is empty, a null lang 'und'; repeated rows count as often as they come; ties are ranked
by the phrase's bytes; keys and other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.llm.bpe import pack_all, pack_bytes, pack_ints, unpack_all, unpack_bytes, unpack_ints
from helixframe.llm.common import materialize, slices

_PIECES, _WORDS = re.compile(rb"[.,;:!?\n-\r]"), re.compile(rb"[^ \t]+")
#: Bytes of text that share one list of words, and for which there is one bucket of words and one partition of runs.
CHUNK_BYTES, BUCKET_BYTES = 6_000_000, 8_000_000
#: Entries of a container that bursts, containers that it bursts into, entries of a trie that spills, and shares of
#: third words that spread a pair.
BURST, HYBRIDS, FULL, SPREAD = 16_384, 16, 1_000_000, 64
#: Shares of a language's phrases that are ranked apart first.
SHARES = 16
_DEALT = pa.schema([("key", pa.int64()), ("chunk", pa.int64()), ("payload", pa.binary())])
_DEALT_DDL = "key bigint, chunk bigint, payload binary"
_RUNS_DDL = "part bigint, payload binary"
_COUNTS_DDL = "w1 bigint, w2 bigint, w3 bigint, f bigint, lang string, word string"
_COUNTS = pa.schema([*((c, pa.int64()) for c in ("w1", "w2", "w3", "f")), ("lang", pa.string()), ("word", pa.string())])


class HatTrie:
    """Counts of word sequences (first, rest): first words above hash containers of the rest.

    ``rest`` is one number, second * base + third (third 0 where there is none), with words from 1 and below base. A
    container that grows bursts into hybrid ones, each of a share of the second words.
    """

    def __init__(self, base: int, burst: int = BURST, full: int = FULL):
        self.base, self.burst, self.full = base, burst, full
        self.containers: dict[int, Counter] = {}
        self.levels: dict[int, list[Counter]] = {}
        self.sizes: Counter = Counter()
        self.entries = 0
        self.runs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, first: np.ndarray, rest: np.ndarray) -> None:
        """Insert phrases, a subtree at a time."""
        order = np.argsort(first, kind="stable")
        first, rest = first[order], rest[order]
        cuts = np.flatnonzero(np.diff(first)) + 1
        bounds = [0, *cuts.tolist(), len(first)]
        rests = rest.tolist()
        for lo, hi, word in zip(bounds[:-1], bounds[1:], first[[0, *cuts]].tolist() if len(first) else [], strict=False):
            grown = self._burst_insert(word, rest[lo:hi]) if word in self.levels else self._insert(word, rests[lo:hi])
            self.sizes[word] += grown
            self.entries += grown
            if self.entries > self.full:
                self._make_room()

    def _insert(self, word: int, rests: list[int]) -> int:
        container = self.containers.get(word)
        if container is None:
            container = self.containers[word] = Counter()
        before = len(container)
        container.update(rests)
        grown = len(container) - before
        if len(container) > self.burst:
            level = self.levels[word] = [Counter() for _ in range(HYBRIDS)]
            for r, n in self.containers.pop(word).items():
                level[r // self.base % HYBRIDS][r] = n
        return grown

    def _burst_insert(self, word: int, rest: np.ndarray) -> int:
        share, grown = rest // self.base % HYBRIDS, 0
        for k, container in enumerate(self.levels[word]):
            before = len(container)
            container.update(rest[share == k].tolist())
            grown += len(container) - before
        return grown

    def _make_room(self) -> None:
        """Spill whole subtrees, the largest first, until half of the room is free."""
        words, left = [], self.entries
        for word, n in self.sizes.most_common():
            if left <= self.full // 2:
                break
            words.append(word)
            left -= n
        self._spill(words)

    def _spill(self, words: list[int]) -> None:
        """One sorted run of whole subtrees."""
        containers = [[self.containers.pop(w)] if w in self.containers else self.levels.pop(w) for w in words]
        flat = [c for own in containers for c in own]
        sizes = [sum(map(len, own)) for own in containers]
        rest = np.fromiter(chain.from_iterable(flat), np.int64, sum(sizes))
        counts = np.fromiter(chain.from_iterable(c.values() for c in flat), np.int64, sum(sizes))
        first = np.repeat(np.array(words, np.int64), sizes)
        order = np.lexsort((rest, first)) if self.base >= 1 << 21 else np.argsort(first * (self.base * self.base) + rest)
        self.runs.append((first[order], rest[order], counts[order]))
        self.entries -= sum(self.sizes.pop(w) for w in words)

    def drain(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """All runs, what is left as the last of them: first, rest and count, in order; a phrase may come once a run."""
        self._spill(list(self.sizes))
        runs, self.runs = self.runs, []
        return iter(runs)


class _Chunk:
    def __init__(self, number: int):
        self.number, self.bytes = number, 0
        self.numbers: dict[bytes, dict[bytes, int]] = {}
        self.words: list[bytes] = []
        self.sequences: list[np.ndarray] = []

    def add(self, lang: str, text: str) -> None:
        """Words as numbers from 1, a 0 after each piece. Lower case is of A to Z only, as bytes have it."""
        raw = text.encode().lower()
        self.bytes += len(raw)
        mine, prefix, words, out = self.numbers.setdefault(lang.encode(), {}), lang.encode() + b"\xff", self.words, []
        for piece in _PIECES.split(raw):
            for word in _WORDS.findall(piece):
                k = mine.get(word)
                if k is None:
                    words.append(prefix + word)
                    k = mine[word] = len(words)
                out.append(k)
            out.append(0)
        self.sequences.append(np.array(out, np.uint32))

    def batches(self, buckets: int) -> Iterator[pa.RecordBatch]:
        flat = np.concatenate(self.sequences)
        yield _row(self.number, self.number, pack_ints(flat))
        counts = np.bincount(flat, minlength=len(self.words) + 1)[1:]
        bucket = np.fromiter((zlib.crc32(w) for w in self.words), np.int64, len(self.words)) % buckets
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(buckets), side="right")
        for b, (lo, hi) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)):
            if lo < hi:
                nos = order[lo:hi]
                own = [self.words[k] for k in nos.tolist()]
                payload = pack_all(pack_ints(np.diff(nos, prepend=0)), pack_ints(np.array([len(w) for w in own])), pack_bytes(b"".join(own)), counts[nos].astype("<u8").tobytes())
                yield _row(-1 - b, self.number, payload)


def _row(key: int, chunk: int, payload: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([chunk], pa.int64()), pa.array([payload], pa.binary())], schema=_DEALT)


def _dealt(docs: DataFrame, buckets: int) -> DataFrame:
    """One row with a chunk's numbers (key: the chunk), and one for each bucket its words go to (key: -1 - bucket)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        chunk = _Chunk(number)
        for part in slices(batches, "text"):
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                if chunk.bytes and chunk.bytes + len(text) > CHUNK_BYTES:
                    yield from chunk.batches(buckets)
                    number += 1
                    chunk = _Chunk(number)
                chunk.add(lang, text)
        if chunk.sequences:
            yield from chunk.batches(buckets)

    given = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return given.mapInArrow(cut, _DEALT_DDL).repartition(buckets, "key")


def _bucket_words(rows: list[tuple[int, bytes]]) -> tuple[list[list[bytes]], list[np.ndarray], dict[bytes, int]]:
    """Of a bucket's rows: the words and numbers of each chunk, and the counts of all."""
    total: dict[bytes, int] = defaultdict(int)
    words, numbers = [], []
    for _, payload in rows:
        nos, lens, joined, counts = unpack_all(payload)
        raw, ends = unpack_bytes(joined), np.cumsum(unpack_ints(lens), dtype=np.int64).tolist()
        own = [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        for word, n in zip(own, np.frombuffer(counts, "<u8").tolist(), strict=True):
            total[word] += n
        words.append(own)
        numbers.append(np.cumsum(unpack_ints(nos), dtype=np.int64))
    return words, numbers, total


def _per_bucket(dealt: DataFrame, buckets: int, least: int, answer, ddl: str) -> DataFrame:
    """``answer`` of each bucket's rows and of the ids of its frequent words; ids follow from words and counts alone."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, rows = None, []

        def done() -> Iterator[pa.RecordBatch]:
            words, numbers, total = _bucket_words(rows)
            frequent = sorted(w for w, n in total.items() if n >= least)
            ids = {w: 1 + (-1 - bucket) + k * buckets for k, w in enumerate(frequent)}
            yield from answer(rows, words, numbers, total, ids)

        for batch in batches:
            keys, chunks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for k, key in enumerate(keys):
                if key < 0:
                    if key != bucket and rows:
                        yield from done()
                        rows = []
                    bucket = key
                    rows.append((chunks[k], batch.column(2)[k].as_py()))
        if rows:
            yield from done()

    return dealt.sortWithinPartitions("key", "chunk").mapInArrow(work, ddl)


def _ids(dealt: DataFrame, buckets: int, least: int) -> DataFrame:
    """For each chunk, the ids of its words that have one: packed (number, id), from each bucket."""

    def answer(rows, words, numbers, total, ids) -> Iterator[pa.RecordBatch]:
        for (chunk, _), own, nos in zip(rows, words, numbers, strict=True):
            mine = np.fromiter((ids.get(w, 0) for w in own), np.int64, len(own))
            has = np.flatnonzero(mine)
            if len(has):
                yield _row(chunk, chunk, pack_all(pack_ints(nos[has] + 1), mine[has].astype("<u8").tobytes())).select(["key", "payload"])

    return _per_bucket(dealt, buckets, least, answer, "key bigint, payload binary")


def _word_table(dealt: DataFrame, buckets: int, least: int) -> DataFrame:
    """w1 (the id), f, lang and word of frequent words; and with id 0, f of all words of a lang in a bucket."""

    def answer(rows, words, numbers, total, ids) -> Iterator[pa.RecordBatch]:
        langs: Counter = Counter()
        for word, n in total.items():
            langs[word.split(b"\xff", 1)[0].decode()] += n
        out = [(0, n, lang, None) for lang, n in langs.items()]
        out += [(k, total[w], *(x.decode() for x in w.split(b"\xff", 1))) for w, k in ids.items()]
        w, f, lang, word = zip(*out, strict=True)
        zeros = pa.array(np.zeros(len(out), np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(w, pa.int64()), zeros, zeros, pa.array(f, pa.int64()), pa.array(lang, pa.string()), pa.array(word, pa.string())], schema=_COUNTS)

    return _per_bucket(dealt, buckets, least, answer, _COUNTS_DDL)


def prefix_partition(w1: np.ndarray, w2: np.ndarray, w3: np.ndarray, parts: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = w1.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + w2.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + (w3 % SPREAD).astype(np.uint64) * np.uint64(0x165667B19E3779F9)
        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return ((mixed >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)


def _runs(dealt: DataFrame, ids: DataFrame, parts: int) -> DataFrame:
    """Each chunk's phrases of frequent words, counted in a trie, as one packed run for each prefix partition."""
    schema = pa.schema([("part", pa.int64()), ("payload", pa.binary())])

    def count(docs: pa.Table, words: pa.Table) -> pa.Table:
        if not docs.num_rows or docs.column("key")[0].as_py() < 0 or not words.num_rows:
            return schema.empty_table()
        answers = [unpack_all(p) for p in words.column("payload").to_pylist()]
        nos = np.concatenate([unpack_ints(a[0]) for a in answers]).astype(np.int64)
        names = np.concatenate([np.frombuffer(a[1], "<u8") for a in answers]).astype(np.int64)
        order = np.argsort(names)  # frequent words are numbered anew, from 1, in the order of ids
        names, local = np.concatenate([[0], names[order]]), np.zeros(int(nos.max()) + 1, np.int64)
        local[nos[order]] = np.arange(1, len(names))
        trie = HatTrie(len(names))
        for payload in docs.column("payload").to_pylist():
            flat = unpack_ints(payload)
            s = np.concatenate([np.where(flat < len(local), local[np.minimum(flat, len(local) - 1)], 0), [0, 0]])
            for at in range(0, len(s) - 2, 2_000_000):
                one, two, three = s[at : at + 2_000_000], s[at + 1 : at + 2_000_001], s[at + 2 : at + 2_000_002]
                n = min(len(one), len(three))
                one, two, three = one[:n], two[:n], three[:n]
                pair = (one > 0) & (two > 0)
                triple = pair & (three > 0)
                trie.add(np.concatenate([one[pair], one[triple]]), np.concatenate([two[pair] * trie.base, two[triple] * trie.base + three[triple]]))
        out = []
        for first, rest, counts in trie.drain():
            w1, w2, w3 = names[first], names[rest // trie.base], names[rest % trie.base]
            part = prefix_partition(w1, w2, w3, parts)
            order = np.argsort(part.astype(np.uint16) if parts < 1 << 16 else part, kind="stable")
            w1, w2, w3, counts, part = (x[order] for x in (w1, w2, w3, counts, part))
            cuts = np.flatnonzero(np.diff(part)) + 1
            out += [(int(part[lo]), _pack_run(w1[lo:hi], w2[lo:hi], w3[lo:hi], counts[lo:hi])) for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(part)], strict=True) if lo < hi]
        return pa.Table.from_arrays([pa.array([p for p, _ in out], pa.int64()), pa.array([b for _, b in out], pa.binary())], schema=schema)

    return dealt.groupBy("key").cogroup(ids.groupBy("key")).applyInArrow(count, _RUNS_DDL)


def _pack_run(w1: np.ndarray, w2: np.ndarray, w3: np.ndarray, counts: np.ndarray) -> bytes:
    """Columns of a sorted run; 32-bit planes where all numbers fit."""
    columns = (np.diff(w1, prepend=0), w2, w3, counts)
    if max(int(c.max()) for c in columns) < 1 << 32:
        return b"\x04" + pack_all(*map(pack_ints, columns))
    return b"\x08" + pack_all(*(pack_bytes(c.astype("<i8").tobytes()) for c in columns))


def _unpack_run(blob: bytes) -> np.ndarray:
    """A column for each number of an entry."""
    wide = blob[0] == 8
    w1, w2, w3, n = (np.frombuffer(unpack_bytes(c), "<i8") if wide else unpack_ints(c).astype(np.int64) for c in unpack_all(blob[1:]))
    return np.stack([np.cumsum(w1), w2, w3, n])


def _added(entries: np.ndarray) -> np.ndarray:
    """Sorted entries, counts of equal phrases added up."""
    small = entries.shape[1] and entries[:3].max() < 1 << 21  # then a phrase is one number
    order = np.argsort((entries[0] << 42) | (entries[1] << 21) | entries[2]) if small else np.lexsort((entries[2], entries[1], entries[0]))
    entries = entries[:, order]
    fresh = np.concatenate([[True], (np.diff(entries[:3], axis=1) != 0).any(axis=0)]) if entries.shape[1] else np.zeros(0, bool)
    starts = np.flatnonzero(fresh)
    return np.concatenate([entries[:3, starts], np.add.reduceat(entries[3], starts)[None, :]]) if len(starts) else entries


def _merged(runs: DataFrame, parts: int, least: int, most: int = 1_000_000) -> DataFrame:
    """Phrases of each prefix partition with at least ``least`` occurrences; runs are merged as they come."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, waiting, waits = None, np.zeros((4, 0), np.int64), [], 0

        def done() -> Iterator[pa.RecordBatch]:
            final = _added(np.concatenate([held, *waiting], axis=1))
            final = final[:, final[3] >= least]
            if final.shape[1]:
                none = pa.nulls(final.shape[1], pa.string())
                yield pa.RecordBatch.from_arrays([*map(pa.array, final), none, none], schema=_COUNTS)

        for batch in batches:
            for p, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if p != part and part is not None:
                    yield from done()
                    held, waiting, waits = np.zeros((4, 0), np.int64), [], 0
                part = p
                run = _unpack_run(payload.as_py())
                waiting.append(run)
                waits += run.shape[1]
                if waits > max(most, held.shape[1]):
                    held, waiting, waits = _added(np.concatenate([held, *waiting], axis=1)), [], 0
        if part is not None:
            yield from done()

    return runs.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(merge, _COUNTS_DDL)


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1,000,000 a a / (l r)), exact up to counts of 10**15."""
    wide = lambda c: c.cast("decimal(15,0)")
    above, below = wide(a) * wide(a) * F.lit(1_000_000).cast("decimal(7,0)"), wide(left) * wide(right)
    return F.call_function("div", above, below)


def counts_of(docs: DataFrame, least: int) -> DataFrame:
    """w1, w2, w3 (ids, 0 for none) and f of frequent phrases of two and three words; lang and word of frequent words."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    dealt = _dealt(docs, buckets)
    runs = _runs(dealt, _ids(dealt, buckets, least), buckets)
    return _merged(runs, buckets, least).unionByName(_word_table(dealt, buckets, least))


def mine(docs: DataFrame, least: int = 10, ranks: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of two and three words."""
    found = materialize(counts_of(docs, least), "phrases")
    words = found.where("w2 = 0 and w1 > 0").select("lang", F.col("w1").alias("id"), "word", "f")
    totals = found.where("w1 = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    pairs, triples = found.where("w2 > 0 and w3 = 0").select("w1", "w2", "f"), found.where("w3 > 0").select("w1", "w2", "w3", "f")

    def named(df: DataFrame, k: str) -> DataFrame:
        """With the word of an id, and how often it occurs."""
        return df.join(words.select("lang", F.col("id").alias(k), F.col("word").alias(f"t{k}"), F.col("f").alias(f"f{k}")), ["lang", k] if "lang" in df.columns else [k])

    # A pair falls to the most frequent triple that begins or ends with it.
    longer = triples.select("w1", "w2", "f").unionByName(triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "f")).groupBy("w1", "w2").agg(F.max("f").alias("longer"))
    whole = pairs.join(longer, ["w1", "w2"], "left").where(F.coalesce(100 * F.col("longer") < 50 * F.col("f"), F.lit(True)))
    two = named(named(whole, "w1"), "w2").select("lang", F.concat_ws(" ", "tw1", "tw2").alias("phrase"), F.col("f").alias("a"), F.col("fw1").alias("l"), F.col("fw2").alias("r")).withColumn("score", score(F.col("a"), F.col("l"), F.col("r")))

    start, end = pairs.select("w1", "w2", F.col("f").alias("f12")), pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("f").alias("f23"))
    cut = named(named(named(triples.join(start, ["w1", "w2"]).join(end, ["w2", "w3"]), "w1"), "w2"), "w3")
    one, other = score(F.col("f"), F.col("fw1"), F.col("f23")), score(F.col("f"), F.col("f12"), F.col("fw3"))
    cut = cut.withColumns({"_one": one, "_two": other}).withColumn("_first", F.col("_one") <= F.col("_two"))
    pick = lambda x, y: F.when(F.col("_first"), F.col(x)).otherwise(F.col(y))
    three = cut.select("lang", F.concat_ws(" ", "tw1", "tw2", "tw3").alias("phrase"), F.col("f").alias("a"), pick("fw1", "f12").alias("l"), pick("f23", "fw3").alias("r"), pick("_one", "_two").alias("score"))

    # First within shares of a language, so that its last task reads the best of each share only, however many tasks there are.
    best = two.unionByName(three).withColumn("_share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
    for keys in (["lang", "_share"], ["lang"]):
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc("a"), "phrase")
        best = best.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= ranks)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

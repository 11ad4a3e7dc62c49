"""Byte-level BPE by a global shuffle of distinct words.

1. Each partition cuts its documents into chunks of a few million characters, numbers the distinct
   pre-tokens of a chunk, and keeps every document as the positions' sequence of those numbers. That is the
   exploded (document, position, pre-token) relation, pre-aggregated before it is shuffled.
2. A chunk's words are dealt to buckets by hash, and shuffled as one packed row for each bucket; in its
   bucket, each distinct word is encoded once.
3. The ids travel back to their chunks, packed likewise, and documents are reassembled by position.
4. Decoding joins the token-byte table, whose size the vocabulary fixes, so it is broadcast.

A word occurs once per chunk at most, so no key is hot, however common a word is. Documents and words go
through one and the same exchange, which both branches of the plan read.

Defined results: a null or empty text has no ids and decodes to b''; repeated rows come back as often; keys
may be null; other columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import text_rows

#: Characters of text that share one dictionary of word numbers, and for which there is one bucket of words.
CHUNK_CHARS, BUCKET_CHARS = 14_000_000, 8_000_000
#: Expressions whose matches never cross the cut before a single blank.
CUT_AT_BLANKS = frozenset({r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+", r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s", r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"})

#: key: the chunk for a document, -1 - bucket for words.
_DEALT = pa.schema([("key", pa.int64()), ("chunk", pa.int64()), ("doc_id", pa.int64()), ("payload", pa.binary())])
_DEALT_DDL = "key bigint, chunk bigint, doc_id bigint, payload binary"


def pack_ints(values: np.ndarray) -> bytes:
    """Unsigned 32-bit integers, compressed: each byte of a number in a plane of its own, as high planes are mostly zero."""
    planes = values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return pack_bytes(planes)


def unpack_ints(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(unpack_bytes(blob), np.uint8)
    return planes.reshape(4, -1).T.copy().view("<u4").reshape(-1)


def pack_bytes(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + (pa.Codec("zstd").compress(raw, asbytes=True) if raw else b"")


def unpack_bytes(blob: bytes) -> bytes:
    n = int.from_bytes(blob[:8], "little")
    return pa.Codec("zstd").decompress(blob[8:], decompressed_size=n, asbytes=True) if n else b""


def pack_all(*parts: bytes) -> bytes:
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def unpack_all(blob: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(blob):
        n = int.from_bytes(blob[at : at + 8], "little")
        out.append(blob[at + 8 : at + 8 + n])
        at += 8 + n
    return out


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f) if token}


class _Numbers(dict):
    """Numbers its keys in the order in which they are first seen."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


def take_runs(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs ``which`` of ``flat``, one after another; run k is lens[k] items from starts[k]."""
    n = lens[which]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts[which] - (ends - n), n) + np.arange(total)]


class _Chunk:
    def __init__(self, number: int):
        self.number, self.chars = number, 0
        self.segments, self.words = _Numbers(), _Numbers()
        self.docs: list[tuple[int | None, np.ndarray, bool]] = []

    def add(self, doc_id: int | None, text: str, find, uneven) -> None:
        """Cut at single blanks, so that the expression runs once per distinct segment of the chunk.

        A match never crosses such a cut; a text with a blank beside other white space is matched whole, and so
        is every text where nothing is known of the expression (``uneven`` is None).
        """
        self.chars += len(text)
        whole = uneven is None or uneven(text) is not None
        if whole:
            numbers, parts = self.words, find(text)
        else:
            numbers, parts = self.segments, text.split(" ") if text else []
            parts = parts[:1] * bool(parts and parts[0]) + [" " + p for p in parts[1:]]
        self.docs.append((doc_id, np.fromiter(map(numbers.__getitem__, parts), np.uint32, len(parts)), whole))

    def batches(self, find, buckets: int) -> Iterator[pa.RecordBatch]:
        per_segment = [find(s) for s in self.segments]
        lens = np.fromiter(map(len, per_segment), np.int64, len(per_segment))
        flat = np.fromiter((self.words[w] for words in per_segment for w in words), np.uint32, int(lens.sum()))
        del per_segment
        self.segments.clear()
        starts = np.cumsum(lens) - lens
        for at in range(0, len(self.docs), 1000):
            part = self.docs[at : at + 1000]
            seqs = [pack_ints(numbers if whole else take_runs(flat, starts, lens, numbers)) for _, numbers, whole in part]
            mine = pa.array([self.number] * len(part), pa.int64())
            yield pa.RecordBatch.from_arrays([mine, mine, pa.array([d[0] for d in part], pa.int64()), pa.array(seqs, pa.binary())], schema=_DEALT)
        words = [w.encode() for w in self.words]
        bucket = np.fromiter((zlib.crc32(w) for w in words), np.int64, len(words)) % buckets
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(buckets), side="right")
        for b, (lo, hi) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)):
            if lo == hi:
                continue
            nos = order[lo:hi]
            own = [words[k] for k in nos.tolist()]
            payload = pack_all(pack_ints(np.diff(nos, prepend=0)), pack_ints(np.array([len(w) for w in own])), pack_bytes(b"".join(own)))
            yield pa.RecordBatch.from_arrays([pa.array([-1 - b], pa.int64()), pa.array([self.number], pa.int64()), pa.nulls(1, pa.int64()), pa.array([payload], pa.binary())], schema=_DEALT)


def _matches(expression):
    """All matches of an expression, groups or not."""
    return expression.findall if not expression.groups else lambda text: [m[0] for m in expression.finditer(text)]


def _dealt(df: DataFrame, pattern: str, key: str, text: str, buckets: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find = _matches(regex.compile(pattern))
        uneven = regex.compile(r" \s|\s ").search if pattern in CUT_AT_BLANKS else None
        number = TaskContext.get().partitionId() << 32
        chunk = _Chunk(number)
        for keys, texts in text_rows(batches, key, text):
            for doc_id, t in zip(keys, texts, strict=True):
                if chunk.docs and chunk.chars + len(t) > CHUNK_CHARS:
                    yield from chunk.batches(find, buckets)
                    number += 1
                    chunk = _Chunk(number)
                chunk.add(doc_id, t, find, uneven)
        if chunk.docs:
            yield from chunk.batches(find, buckets)

    return df.select(F.col(key).cast("bigint").alias(key), text).mapInArrow(cut, _DEALT_DDL).repartition(buckets, "key")


def _encoded(dealt: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """Rows sorted by bucket within their partition: a bucket's words are met together, and each is encoded once."""
    vocabulary = dealt.sparkSession.sparkContext.broadcast(ranks)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        encoding = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=vocabulary.value, special_tokens={})
        last, known = None, {}
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for row in np.flatnonzero(keys < 0).tolist():
                if keys[row] != last:
                    last, known = keys[row], {}
                nos, lens, words = unpack_all(batch.column(3)[row].as_py())
                raw, ends = unpack_bytes(words), np.cumsum(unpack_ints(lens), dtype=np.int64).tolist()
                out = []
                for a, b in zip([0, *ends[:-1]], ends, strict=True):
                    word = raw[a:b]
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = encoding._encode_single_piece(word)  # the same, but not cut again
                    out.append(ids)
                flat = np.fromiter((i for ids in out for i in ids), np.uint32)
                payload = pack_all(nos, pack_ints(np.array([len(ids) for ids in out])), pack_ints(flat))
                chunk = batch.column(1).slice(row, 1)
                yield pa.RecordBatch.from_arrays([chunk, pa.array([payload], pa.binary())], ["key", "payload"])

    return dealt.sortWithinPartitions("key").mapInArrow(encode, "key bigint, payload binary")


def _reassembled(dealt: DataFrame, encoded: DataFrame, key: str) -> DataFrame:
    schema = pa.schema([(key, pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def join(docs: pa.Table, words: pa.Table) -> pa.Table:
        if not docs.num_rows or docs.column("key")[0].as_py() < 0:  # a bucket of words, of no use here
            return schema.empty_table()
        parts = [unpack_all(p) for p in words.column("payload").to_pylist()]
        nos = np.concatenate([np.cumsum(unpack_ints(p[0]), dtype=np.int64) for p in parts] or [np.zeros(0, np.int64)])
        counts = np.concatenate([unpack_ints(p[1]) for p in parts] or [np.zeros(0, np.int64)]).astype(np.int64)
        flat = np.concatenate([unpack_ints(p[2]) for p in parts] or [np.zeros(0, np.uint32)])
        lens, starts = np.zeros(len(nos), np.int64), np.zeros(len(nos), np.int64)
        lens[nos] = counts
        starts[nos] = np.cumsum(counts) - counts
        out = [take_runs(flat, starts, lens, unpack_ints(p)).tobytes() for p in docs.column("payload").to_pylist()]
        return pa.Table.from_arrays([docs.column("doc_id").combine_chunks(), pa.array([len(x) // 4 for x in out], pa.int64()), pa.array(out, pa.binary())], schema=schema)

    return dealt.groupBy("key").cogroup(encoded.groupBy("key")).applyInArrow(join, f"`{key}` bigint, n_tokens bigint, ids binary")


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, n_tokens, and ids as little-endian unsigned 32-bit integers.

    Words are dealt to a bucket for each BUCKET_CHARS characters of text, at least as many as the session has
    shuffle partitions, so that buckets, and what a task reads, don't grow with the table.
    """
    chars = df.agg(F.sum(F.char_length(text))).first()[0] or 0
    buckets = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-chars // BUCKET_CHARS))
    dealt = _dealt(df, pattern, key, text, buckets)
    return _reassembled(dealt, _encoded(dealt, ranks, pattern), key)


def decode(df: DataFrame, ranks: dict[bytes, int], key: str = "doc_id") -> DataFrame:
    """Adds ``decoded``, the bytes of ``ids``: a lookup in the token-byte table (one entry per vocabulary id)."""
    table = df.sparkSession.sparkContext.broadcast(ranks)
    out = pa.schema([(key, pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])

    def lookup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = [b""] * (max(table.value.values(), default=-1) + 1)
        for word, rank in table.value.items():
            token[rank] = word
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts = [b"".join(map(token.__getitem__, np.frombuffer(i, "<u4").tolist())) for i in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], schema=out)

    return df.select(key, "n_tokens", "ids").mapInArrow(lookup, f"`{key}` bigint, n_tokens bigint, ids binary, decoded binary")


def digest(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the hashes of ids and decoded bytes."""
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))

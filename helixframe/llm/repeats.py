"""Removes every byte that lies in a string of a given length which also starts elsewhere, by suffix arrays.

One suffix array of a corpus fits no task, so only texts that may hold a repeat are sorted, in bounded buckets:

1. A string's key is the least hash of the 64-byte strings in it, so equal strings have one key wherever they stand.
   Neighbouring strings mostly share it: a text falls into runs of strings with one key, and the bytes of a run are a
   context. Keys seen once in all texts have no repeat, unless within their own run.
2. Equal contexts are whole repeats, told by their hashes; one of them stands for all from here on. Of texts that
   occur more than once, one stands for all as well.
3. Contexts that share a key but differ are dealt to buckets by the key and sorted there in two stages: only suffixes
   smaller than their successor are compared with each other; scans over the buckets of first bytes induce the order
   of the rest. Neighbours with a common prefix of ``length`` bytes are repeats, if they start at two places.
4. A key with very many different contexts would make a bucket of its own without bound. Such contexts are split by
   what is compared: each of their strings is hashed, and equal strings are counted.
5. Places of repeats become intervals of removed bytes, joined to the texts once.

Rows are told apart by their place in ``docs``, which must be a table, or anything that Spark reads alike twice.
Defined results: null and empty texts, and texts shorter than ``length``, lose nothing; rows with equal texts of at
least ``length`` bytes lose all; keys may be null or repeated; very long texts are cut into overlapping parts while
runs are sought; other columns, whatever their names, are not read; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import discard, materialize, slices

#: Bytes of the strings that are hashed, and of a text's part while runs are sought.
GRAM, PART = 64, 2_000_000
#: Bytes of contexts that share a suffix array, and contexts of a key that is split by whole strings.
BUCKET_BYTES, MANY = 1_000_000, 10_000
_RUNS_DDL = "row bigint, key bigint, context bigint, lo bigint, hi bigint, weight int, tied boolean, los array<int>, his array<int>"
_INTERVALS_DDL = "row bigint, los array<int>, his array<int>"
_INTERVALS = pa.schema([("row", pa.int64()), ("los", pa.list_(pa.int32())), ("his", pa.list_(pa.int32()))])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each string of GRAM bytes, its two halves hashed alike at every step."""
    h, width = _mixed(raw.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)), 1
    while width < GRAM:
        h = h[:-width] * np.uint64(0x9E3779B97F4A7C15 + 2 * width) + h[width:]
        width *= 2
    return _mixed(h)


def least_of(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


def runs_of(raw: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the strings of ``length`` bytes, by runs of neighbours with one key: key, first start, where starts end,
    and whether the key's gram comes again within the run, without which no two strings of it can be equal.

    A run of more starts than a string has grams is cut; each start keeps its key, however runs are cut.
    """
    wide, found = length - GRAM + 1, []
    for at in range(0, max(0, len(raw) - length + 1), PART):
        grams = gram_hashes(raw[at : at + PART + length - 1])
        keys = least_of(grams, wide)
        cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(cuts, append=len(keys))
        parts = -(-sizes // wide)
        nth = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        los = np.repeat(cuts, parts) + nth * wide
        his = np.minimum(los + wide, np.repeat(cuts + sizes, parts))
        n = his - los + wide - 1
        starts = np.cumsum(n) - n
        tied = np.add.reduceat(grams[np.repeat(los - starts, n) + np.arange(int(n.sum()))] == np.repeat(keys[los], n), starts, dtype=np.int64) > 1
        found.append((keys[los], los + at, his + at, tied))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def united(los: np.ndarray, his: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Half-open intervals that overlap or touch as one."""
    if not len(los):
        return los, his
    order = np.argsort(los, kind="stable")
    los, reach = los[order], np.maximum.accumulate(his[order])
    fresh = np.concatenate([[True], los[1:] > reach[:-1]])
    starts = np.flatnonzero(fresh)
    return los[starts], reach[np.concatenate([starts[1:] - 1, [len(los) - 1]])]


def _runs(rows: DataFrame, length: int) -> DataFrame:
    """Runs of each text: their key, the hash of their context, and their starts.

    Of equal contexts in a text the first stands for all, with a weight of 2 and the starts of all.
    """
    import xxhash

    def of_text(raw: np.ndarray, view: memoryview) -> list[np.ndarray]:
        keys, los, his, tied = runs_of(raw, length)
        codes = np.array([xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(los.tolist(), (his + (length - 1)).tolist(), strict=True)], np.uint64)
        order = np.lexsort((los, codes, keys))
        cuts = np.flatnonzero(np.concatenate([[True], (np.diff(keys[order]) != 0) | (np.diff(codes[order]) != 0)]))
        sizes, first = np.diff(cuts, append=len(order)), order[cuts]
        many, pieces = np.flatnonzero(sizes > 1), np.ones(len(first), np.int64)
        starts, stops = los[first], his[first]
        if len(many):
            own = {int(k): united(los[order[cuts[k] : cuts[k] + sizes[k]]], his[order[cuts[k] : cuts[k] + sizes[k]]]) for k in many}
            pieces[many] = [len(own[int(k)][0]) for k in many]
            starts = np.concatenate([own[k][0] if k in own else starts[k : k + 1] for k in range(len(first))])
            stops = np.concatenate([own[k][1] if k in own else stops[k : k + 1] for k in range(len(first))])
        return [keys[first].view(np.int64), codes[first].view(np.int64), los[first], his[first], np.where(sizes > 1, 2, 1), tied[first], pieces, starts, stops]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "raw"):
            row, found = [], []
            for r, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                blob = text.as_buffer()
                if blob is not None and blob.size >= length:
                    found.append(of_text(np.frombuffer(blob, np.uint8), memoryview(blob)))
                    row.append(r)
            if found:
                key, context, lo, hi, weight, tied, pieces, los, his = (np.concatenate(x) for x in zip(*found, strict=True))
                offsets = pa.array(np.concatenate([[0], np.cumsum(pieces)]), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (los, his)]
                numbers = [np.repeat(row, [len(x[0]) for x in found]), key, context, lo, hi]
                yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in numbers), pa.array(weight, pa.int32()), pa.array(tied), *lists], ["row", "key", "context", "lo", "hi", "weight", "tied", "los", "his"])

    return rows.select("row", "raw").mapInArrow(find, _RUNS_DDL)


def suffix_order(raw: np.ndarray, depth: int, wanted: np.ndarray | None = None) -> np.ndarray:
    """Starts of the ``wanted`` suffixes (or all) in the order of their first ``depth`` bytes at least, by two-stage sorting.

    A suffix that is smaller than its successor is sorted directly. The others follow: the scan of a bucket (the
    suffixes with one first byte) meets suffixes in order, and puts each one's predecessor, if it is greater, behind
    what its own bucket has so far; greater suffixes of a bucket stand before its smaller ones. A wanted suffix that is
    greater needs its successors up to the first smaller one, so these are sorted along and left out at the end.
    """
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64)
    ends = np.concatenate([np.flatnonzero(raw[1:] != raw[:-1]), [n - 1]])  # where runs of a byte end
    after = np.concatenate([raw, [0]]).astype(np.int16)
    after[n] = -1
    greater = np.repeat(after[ends] > after[ends + 1], np.diff(ends, prepend=-1))
    taken = np.ones(n, bool) if wanted is None else _with_successors(wanted, greater)
    small = _sorted_directly(raw, np.flatnonzero(~greater & taken), depth)
    bounds = np.searchsorted(raw[small], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if greater[n - 1] and taken[n - 1]:
        waiting[raw[n - 1]].append(np.array([n - 1]))
    out = []

    def predecessors(bucket: np.ndarray) -> np.ndarray:
        before = bucket - 1
        before = before[before >= 0]
        return before[taken[before]]

    for byte in range(256):
        induced, k = waiting[byte], 0
        while k < len(induced):  # greater suffixes put their own predecessors with the same byte behind themselves
            before = predecessors(induced[k])
            before = before[raw[before] == byte]
            if len(before):
                induced.append(before)
            k += 1
        bucket = np.concatenate([*induced, small[bounds[byte] : bounds[byte + 1]]])
        if not len(bucket):
            continue
        out.append(bucket)
        before = predecessors(bucket)
        letters = raw[before]
        before, letters = before[letters > byte], letters[letters > byte]
        order = np.argsort(letters, kind="stable")
        before, letters = before[order], letters[order]
        cuts = np.flatnonzero(np.diff(letters)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(letters)], strict=True):
            if lo < hi:
                waiting[letters[lo]].append(before[lo:hi])
    found = np.concatenate(out) if out else np.zeros(0, np.int64)
    return found if wanted is None else found[wanted[found]]


def _with_successors(wanted: np.ndarray, greater: np.ndarray) -> np.ndarray:
    """Wanted places, and those from a greater one to the next smaller one."""
    places = np.arange(len(wanted))
    last = np.maximum.accumulate(np.where(wanted, places, -1))  # the nearest wanted place so far
    stop = np.concatenate([[-1], np.maximum.accumulate(np.where(~greater, places, -1))[:-1]])  # the nearest smaller one before
    return wanted | ((last >= 0) & (stop < last))


def _words(raw: np.ndarray, depth: int) -> np.ndarray:
    """The eight bytes from each place as one number; zeros follow the end."""
    padded = np.concatenate([raw, np.zeros(depth + 16, np.uint8)])
    words = padded[: len(padded) - 8].astype(np.uint64)
    for k in range(1, 8):
        words <<= np.uint64(8)
        words |= padded[k : len(padded) - 8 + k]
    return words


def _sorted_directly(raw: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Starts by their first ``depth`` bytes, eight at a time; only what ties so far and differs now is sorted again."""
    words = _words(raw, depth)
    order = np.argsort(words[starts], kind="stable")
    out = starts[order]
    first = words[out]
    fresh = np.concatenate([[True], first[1:] != first[:-1]]) if len(out) else np.zeros(0, bool)  # where groups of ties begin
    active = np.arange(len(out))
    for at in range(8, depth, 8):
        alone = fresh & np.concatenate([fresh[1:], [True]]) if len(fresh) else fresh
        active, fresh = active[~alone], fresh[~alone]
        if not len(active):
            break
        w = words[np.minimum(out[active] + at, len(words) - 1)]
        group = np.cumsum(fresh) - 1
        differs = np.concatenate([[False], (w[1:] != w[:-1]) & ~fresh[1:]])
        if not differs.any():
            continue
        split = np.zeros(int(group[-1]) + 1, bool)
        split[group[differs]] = True
        mine = np.flatnonzero(split[group])
        order = np.lexsort((w[mine], group[mine]))
        places = active[mine]
        out[places], w[mine] = out[places[order]], w[mine][order]
        fresh = fresh | np.concatenate([[True], w[1:] != w[:-1]])
    return out


def repeated_starts(contexts: list[bytes], length: int, source: np.ndarray, place: np.ndarray, many: np.ndarray) -> list[np.ndarray]:
    """For each context, the offsets in it at which a string starts that starts elsewhere as well.

    ``source`` and ``place`` say where a context comes from; a context with ``many`` stands for several.
    """
    sizes = np.array([len(c) + 1 for c in contexts])
    begins = np.cumsum(sizes) - sizes
    raw = np.frombuffer(b"\0".join(contexts) + b"\0", np.uint8)
    owner = np.repeat(np.arange(len(contexts), dtype=np.int32), sizes)
    whole = np.arange(len(raw)) - begins[owner] + length < sizes[owner]
    order = suffix_order(raw, length, whole)
    # Adjacent common prefixes: all of ``length`` bytes or less.
    words = _words(raw, length)
    one, two = order[:-1], order[1:]
    equal = np.arange(len(one))
    for at in [*range(0, length - 7, 8), length - 8]:
        equal = equal[words[one[equal] + at] == words[two[equal] + at]]
    linked = np.zeros(len(order) + 1, bool)
    linked[equal + 1] = True
    group = np.cumsum(~linked[:-1])
    within = linked[:-1] | linked[1:]  # a string that no neighbour equals is in no group
    order, group = order[within], group[within]
    who = owner[order]
    at = place[who] + order - begins[who]
    keys = np.lexsort((at, source[who], group))
    g, s, p = group[keys], source[who][keys], at[keys]
    distinct = np.concatenate([[True], (np.diff(g) != 0) | (np.diff(s) != 0) | (np.diff(p) != 0)])[: len(g)]
    size = int(g[-1]) + 1 if len(g) else 1
    places, stands = np.bincount(g, weights=distinct, minlength=size), np.bincount(g, weights=many[who][keys], minlength=size)
    hit = np.sort(order[keys[(places[g] > 1) | (stands[g] > 0)]])
    cuts = np.searchsorted(hit, np.concatenate([begins, [len(raw)]]))
    return [hit[a:b] - begins[k] for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))]


def _as_intervals(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of neighbouring starts, half open."""
    cuts = np.flatnonzero(np.diff(starts) != 1) + 1
    return starts[np.concatenate([[0], cuts])], starts[np.concatenate([cuts - 1, [len(starts) - 1]])] + 1


def _contexts(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of each context asked for."""
    schema = pa.schema([("row", pa.int64()), ("place", pa.int64()), ("key", pa.int64()), ("many", pa.bool_()), ("split", pa.bool_()), ("raw", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "raw", rows=64):
            out: list[list] = [[] for _ in schema]
            for row, text, asked in zip(part.column(0).to_pylist(), part.column(1), part.column(2).to_pylist(), strict=True):
                view = memoryview(text.as_buffer())
                for a in asked:
                    for column, value in zip(out, (row, a["lo"], a["key"], a["many"], a["split"], bytes(view[a["lo"] : a["hi"] + length - 1])), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(out, schema, strict=True)], schema=schema)

    lists = wanted.groupBy("row").agg(F.collect_list(F.struct("lo", "hi", "key", "many", "split")).alias("asked"))
    return rows.join(lists, "row").select("row", "raw", "asked").mapInArrow(cut, "row bigint, place bigint, key bigint, many boolean, split boolean, raw binary")


def _sorted_buckets(contexts: DataFrame, length: int, buckets: int) -> DataFrame:
    """Starts of repeats in the contexts of each bucket, as intervals of a row."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, rows = None, []

        def done() -> Iterator[pa.RecordBatch]:
            source, place, many = np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
            out = []
            for k, starts in enumerate(repeated_starts([r[3] for r in rows], length, source, place, many)):
                if len(starts):
                    out.append((rows[k][0], *_as_intervals(starts + place[k])))
            if out:
                row, los, his = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(los, _INTERVALS.field(1).type), pa.array(his, _INTERVALS.field(2).type)], schema=_INTERVALS)

        for batch in batches:
            for row, place, b, many, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if b != bucket and rows:
                    yield from done()
                    rows = []
                bucket = b
                rows.append((row, place, many, raw))
        if rows:
            yield from done()

    dealt = contexts.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets))).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.select("row", "place", "bucket", "many", "raw").mapInArrow(sort, _INTERVALS_DDL)


def _hashed_strings(contexts: DataFrame, length: int) -> DataFrame:
    """Starts of repeats in the contexts of keys that have very many, by counting equal strings. Each string is in one context."""
    import xxhash

    schema = pa.schema([("row", pa.int64()), ("start", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("weight", pa.int32())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "raw", rows=512):
            out: list[list] = [[] for _ in range(5)]
            for row, place, many, blob in zip(*(c.to_pylist() for c in part.columns), strict=True):
                for s in range(len(blob) - length + 1):
                    code = xxhash.xxh3_128_intdigest(blob[s : s + length])
                    for column, value in zip(out, (row, place + s, code >> 64, code & (1 << 64) - 1, 2 if many else 1), strict=True):
                        column.append(value)
            signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), signed(out[2]), signed(out[3]), pa.array(out[4], pa.int32())], schema=schema)

    strings = contexts.select("row", "place", "many", "raw").mapInArrow(hashed, "row bigint, start bigint, h1 bigint, h2 bigint, weight int")
    again = strings.groupBy("h1", "h2").agg(F.sum("weight").alias("_w")).where(F.col("_w") > 1).select("h1", "h2")
    found = strings.join(again, ["h1", "h2"], "left_semi").select("row", F.col("start").cast("int").alias("lo"))
    return found.select("row", F.array("lo").alias("los"), F.array(F.col("lo") + 1).alias("his"))


def repeated_starts_of(rows: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """(row, los, his): starts of strings that also start elsewhere, as intervals, in one row or several; and rows whose whole text comes again."""
    hashed = rows.where(F.octet_length("raw") >= length).select("row", F.xxhash64("raw").alias("h1"), F.xxhash64(F.lit(1), "raw").alias("h2"))
    groups = hashed.groupBy("h1", "h2").agg(F.count("*").alias("_n"), F.min("row").alias("first")).where("_n > 1")
    copies = materialize(hashed.join(groups, ["h1", "h2"]).select("row", (F.col("row") == F.col("first")).alias("first")), "copies")

    found = materialize(_runs(rows, length), "runs")
    again = found.groupBy("key").agg(F.sum("weight").alias("_w"), F.max("tied").alias("_tied")).where((F.col("_w") > 1) | F.col("_tied")).select("key")
    shared = found.join(again, "key", "left_semi").join(copies, "row", "left").where(F.coalesce("first", F.lit(True)))
    shared = materialize(shared.withColumn("weight", F.when(F.col("first"), 2).otherwise(F.col("weight"))).drop("first"), "shared-runs")
    discard(found)

    contexts = materialize(shared.groupBy("key", "context").agg(F.sum("weight").alias("weight"), F.max("tied").alias("tied"), F.min(F.struct("row", "lo", "hi")).alias("at")).select("key", "context", "weight", "tied", "at.*"), "contexts")
    whole = shared.join(contexts.where("weight > 1").select("key", "context"), ["key", "context"], "left_semi").select("row", "los", "his")
    varied = contexts.groupBy("key").agg(F.count("*").alias("_n"), F.max("tied").alias("_tied")).where("_n > 1 or _tied")
    wanted = contexts.join(varied, "key").select("row", "lo", "hi", "key", (F.col("weight") > 1).alias("many"), (F.col("_n") > MANY).alias("split"))
    cut = materialize(_contexts(rows, wanted, length), "context-bytes")
    size = cut.where("not split").agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    buckets = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    found = whole.unionByName(_sorted_buckets(cut.where("not split"), length, buckets)).unionByName(_hashed_strings(cut.where("split"), length))
    by_row = materialize(found.groupBy("row").agg(F.flatten(F.collect_list("los")).alias("los"), F.flatten(F.collect_list("his")).alias("his")), "intervals")
    discard(shared, contexts, cut)
    return by_row, copies


def remove_repeats(docs: DataFrame, length: int = 200, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_bytes, n_removed, n_spans, and ``kept``: the bytes that are left."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("bigint").alias("key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("raw"))
    starts, copies = repeated_starts_of(rows, length)
    by_row = starts.join(copies.select("row", F.lit(True).alias("copy")), "row", "full")
    schema = pa.schema([("key", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "raw", rows=512):
            out: list[list] = [[] for _ in schema]
            for k, text, copy, los, his in zip(part.column(0).to_pylist(), part.column(1), *(c.to_pylist() for c in part.columns[2:]), strict=True):
                view, n = memoryview(text.as_buffer()), len(text.as_buffer())
                if copy:
                    los, his = np.array([0]), np.array([n])
                else:
                    los, his = united(np.array(los or [], np.int64), np.array(his or [], np.int64) + (length - 1))
                kept = b"".join(view[a:b] for a, b in zip([0, *his.tolist()], [*los.tolist(), n], strict=True))
                for column, value in zip(out, (k, n, n - len(kept), len(los), kept), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(out, schema, strict=True)], schema=schema)

    joined = rows.join(by_row, "row", "left").select("key", "raw", "copy", "los", "his")
    return joined.mapInArrow(remove, "key bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary").withColumnRenamed("key", key)

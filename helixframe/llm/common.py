"""Small helpers that the corpus operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all machines of the cluster see, as spark.checkpoint.dir names it.

    Where the session names none, only a local master (tests, a laptop) gets one of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster see")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-shared-"))
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_path = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Delete what ``materialize`` wrote, once nothing reads it any more."""
    for df in stored:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df.stored_path)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it where ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], column: str, rows: int = 256, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of each Arrow batch: at most ``rows`` rows, and ``most`` bytes of ``column`` unless one row has more."""
    for batch in batches:
        where = batch.schema.get_field_index(column)
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(where)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right"))
            to = min(max(to, at + 1), at + rows)
            yield batch.slice(at, to - at)
            at = to
    pa.default_memory_pool().release_unused()


def text_rows(batches: Iterator[pa.RecordBatch], key: str, text: str = "text", step: int = 256):
    """(keys, texts) in small slices of each Arrow batch; a null text is ''."""
    for part in slices(batches, text, step):
        keys = part.column(part.schema.get_field_index(key)).to_pylist()
        texts = part.column(part.schema.get_field_index(text)).to_pylist()
        yield keys, [t or "" for t in texts]


_HELD: dict = {}


def remembered(name: str, make: Callable[[], object]):
    """What ``make`` gave this Python worker when last asked under ``name``.

    A worker holds one such thing only: the next operator's takes its place, so what stages leave doesn't add up.
    """
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = make()
    return _HELD[name]


def fold(column: str, n: int):
    """crc32 of an id's text, modulo n: the split that learning and scoring agree on."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def bounded_sample(df: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows, the same at every run: those with the smallest hash of ``key``."""
    return df.orderBy(F.xxhash64(F.col(key)), F.col(key)).limit(most)

"""File listings as tables."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.functions import base_name
from helixframe.sources.calls import vcf

NAME = r"^(.+)_S(\d+)_L(\d+)_R(\d+)(?:_(\d+))?\.(?:fastq|fq)(\.gz)?$"


def fastq_names(paths: DataFrame, path: str = "path") -> DataFrame:
    """Sample, its tags, number, lane, read of the pair, file number and compression from names such as a-b_S1_L001_R1_001.fastq.gz.

    Tags are parted by the one non-word sign that a name holds, else by an underscore. Other files are left out.
    """
    name = base_name(F.col(path))
    sample = F.regexp_extract(name, NAME, 1)

    def number(group: int) -> Column:
        return F.regexp_extract(name, NAME, group).try_cast("int")

    signs = F.array_distinct(F.regexp_extract_all(sample, F.lit(r"(\W)"), F.lit(1)))
    tags = F.when(F.size(signs) == 1, F.split(F.regexp_replace(sample, r"\W", "\u0001"), "\u0001")).otherwise(F.split(sample, "_"))
    return paths.where(name.rlike(NAME)).select(F.col(path).alias("path"), sample.alias("sampleName"), tags.alias("tags"), number(2).alias("sampleNumber"), number(3).alias("lane"), number(4).alias("pairedEnd"), number(5).alias("fileNumber"), (F.regexp_extract(name, NAME, 6) != "").alias("gzip"))


def fastq_catalogue(spark: SparkSession, folder: str, depth: int | None = None) -> DataFrame:
    """Sequence files below a folder, at most ``depth`` folders down; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.f*q*").load(folder).select("path")
    if depth is not None:
        below = F.size(F.split(F.regexp_replace("path", "^file:/*", "/"), "/")) - len(folder.rstrip("/").split("/"))
        found = found.where(below - 1 <= depth)
    return fastq_names(found)


def gvcf_folder(spark: SparkSession, folder: str, more: list[str] | None = None) -> DataFrame:
    """All g.vcf and gvcf files of a folder, with an explicit list; an error if there are none."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*vcf").load(folder).select("path").where(F.lower("path").rlike(r"(g\.vcf|\.gvcf)$"))
    paths = sorted({r[0] for r in found.collect()} | set(more or []))
    if not paths:
        raise FileNotFoundError(f"no g.vcf files in {folder}")
    return vcf(spark, paths)


def compressed_state(spark: SparkSession, folder: str, pattern: str = "*.gz", step: int = 1 << 20) -> DataFrame:
    """path, state and bytes (uncompressed, as far as they go) of compressed files below a folder.

    The state is ``whole``, ``truncated``, ``damaged`` (a check sum or the code itself is wrong), ``trailing`` (something
    else follows) or ``not gzip``. A file is inflated ``step`` bytes at a time and nothing of it is kept; members that
    follow one another are one file, as the format allows. Files are dealt out by Spark, one row each; empty ones
    are no rows, as Spark skips them.
    """

    def state_of(blob: memoryview) -> tuple[str, int]:
        at, n, inside = 0, 0, zlib.decompressobj(31)
        if len(blob) < 2 or bytes(blob[:2]) != b"\x1f\x8b":
            return "not gzip", 0
        while at < len(blob):
            fed, at = blob[at : at + step], min(at + step, len(blob))
            try:
                n += len(inside.decompress(fed, step))
                while inside.unconsumed_tail:
                    n += len(inside.decompress(inside.unconsumed_tail, step))
            except zlib.error:
                return "damaged", n
            if inside.eof:
                at -= len(inside.unused_data)
                if at < len(blob) and bytes(blob[at : at + 2]) != b"\x1f\x8b"[: len(blob) - at]:
                    return "trailing", n
                if at < len(blob):
                    inside = zlib.decompressobj(31)
        return ("whole" if inside.eof else "truncated"), n

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, path in enumerate(batch.column(0).to_pylist()):
                state, n = state_of(memoryview(batch.column(1)[k].as_buffer()))
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([state]), pa.array([n], pa.int64())], ["path", "state", "bytes"])

    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    return found.select("path", "content").mapInArrow(check, "path string, state string, bytes bigint")

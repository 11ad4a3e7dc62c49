"""Search and grouping of sequence files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def find(files: DataFrame, criteria: str | dict[int, str] | list[str] | int) -> DataFrame:
    """Files by a text in the first tag, tags by place, tags in order, or a least number of tags. Search again in the result to refine."""
    if isinstance(criteria, bool):
        raise TypeError("no search by a truth value")
    if isinstance(criteria, str):
        return files.where(F.col("tags")[0].contains(criteria))
    if isinstance(criteria, int):
        return files.where(F.size("tags") >= criteria)
    wanted = criteria if isinstance(criteria, dict) else dict(enumerate(criteria))
    out = files
    for place, value in wanted.items():
        out = out.where(F.lower(F.get("tags", F.lit(place))) == value.lower())
    return out


def collisions(files: DataFrame) -> DataFrame:
    return files.groupBy("sampleName", "lane", "pairedEnd").agg(F.count("*").alias("n")).where("n > 1")


def sample_lanes(files: DataFrame, strict: bool = True) -> DataFrame:
    """One row a sample and lane with the path of each read of the pair; more than one file for a read is an error if ``strict``."""
    path = F.when(F.count("*") <= 1, F.first("path"))
    if strict:
        path = path.otherwise(F.raise_error(F.concat(F.lit("several files for "), F.first("path"))))
    else:
        path = F.min("path")
    return files.groupBy("sampleName", "lane").pivot("pairedEnd", [1, 2]).agg(path).withColumnsRenamed({"1": "read1", "2": "read2"})


def sample_tree(files: DataFrame) -> DataFrame:
    """sample, and its lanes as a map to (read of the pair, path) lists."""
    lanes = files.groupBy("sampleName", "lane").agg(F.sort_array(F.collect_list(F.struct("pairedEnd", "path"))).alias("files"))
    return lanes.groupBy("sampleName").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("lane", "files")))).alias("lanes"))

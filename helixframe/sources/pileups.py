"""Pileups and the variant tables derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.functions import parse_indel, parse_strands
from helixframe.sources.columns import is_data, lines, typed

PILEUP = [("contig", "string"), ("position", "bigint"), ("ref", "string"), ("depth", "int"), ("bases", "string"), ("quals", "string")]
EXTRACTED = [("mutCount", "int"), ("coverage", "int"), ("mutPercent", "double"), ("contig", "string"), ("position", "bigint"), ("ref", "string"), ("alt", "string"), ("type", "string"), ("strand", "string"), ("rawPileUpLine", "string")]
LEGACY = [("count", "int"), ("coverage", "int"), ("pct", "double"), ("contig", "string"), ("position", "bigint"), ("id", "string"), ("ref", "string"), ("alt", "string"), ("qual", "string"), ("filter", "string"), ("info", "string"), ("na1", "string"), ("na2", "string")]
METRICS = ["count", "mapq", "basequal", "semq", "plus", "minus", "readpos", "subs", "mmqs", "q2reads", "q2dist", "readlen", "dist3"]


def pileup(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Tab-separated pileup lines with at least four fields; bases and quals only where there is depth."""
    parts = F.split("value", "\t", -1)
    rows = lines(spark, paths).where(is_data() & (F.size(parts) >= 4)).select(*typed(parts, PILEUP), F.col("value").alias("raw"), "ord")
    covered = F.col("depth") > 0
    return rows.withColumns({"ref": F.upper("ref"), "bases": F.when(covered, F.col("bases")), "quals": F.when(covered, F.col("quals"))})


def pileup_six(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Only lines of exactly six fields, plain or compressed."""
    parts = F.split("value", r"\s+", -1)
    return lines(spark, paths).where(is_data() & (F.size(parts) == 6)).select(*typed(parts, PILEUP), "ord").withColumn("ref", F.upper("ref"))


def extracted_variants(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The ten-column table, with strand counts and the decoded indel."""
    parts = F.split("value", "\t", 10)
    rows = lines(spark, paths).where(is_data() & (F.size(parts) >= 9)).select(*typed(parts, EXTRACTED), "ord").where("mutCount is not null")
    strands = parse_strands(F.col("strand"))
    return rows.withColumns({"plus": strands["plus"], "minus": strands["minus"], "indel": parse_indel(F.col("alt"))})


def legacy_variants(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Contig and position from the fourth and fifth field, and the line."""
    parts = F.split("value", "\t", -1)
    return lines(spark, paths).where(is_data() & (F.size(parts) >= 5)).select(parts[3].alias("contig"), parts[4].try_cast("bigint").alias("position"), F.col("value").alias("line"), "ord")


def joined_variants(spark: SparkSession, paths: str | list[str], contig: str | None = None) -> DataFrame:
    """26-column tumour and normal rows as two structs, with parsed INFO fields."""
    parts = F.split("value", "\t", -1)

    def half(first: int):
        return F.struct(*(F.get(parts, F.lit(first + k)).try_cast(t).alias(n) for k, (n, t) in enumerate(LEGACY)))

    from helixframe.sources.calls import info_map

    rows = lines(spark, paths).where(is_data() & (F.size(parts) >= 26)).select(half(0).alias("tumor"), half(13).alias("normal"), "ord")
    rows = rows.withColumns({"contig": F.col("tumor.contig"), "position": F.col("tumor.position"), "tumor_info": info_map(F.col("tumor.info")), "normal_info": info_map(F.col("normal.info"))})
    return rows.where(F.col("contig") == contig) if contig else rows


def positional_counts(spark: SparkSession, paths: str | list[str], contig: str | None = None) -> DataFrame:
    """Pileup rows with allele counts as a map; uncovered rows have an empty map and -- for their reads."""
    from helixframe.operators.pileup import alleles_of

    rows = pileup(spark, paths)
    rows = rows.where(F.col("contig") == contig) if contig else rows
    alleles = alleles_of(F.col("bases"), F.col("ref"))
    names = F.array_distinct(F.transform(alleles, lambda a: a["allele"]))
    counts = F.map_from_arrays(names, F.transform(names, lambda n: F.size(F.filter(alleles, lambda a: a["allele"] == n))))
    empty = F.create_map().cast("map<string,int>")
    return rows.withColumns({"counts": F.coalesce(counts, empty), "bases": F.coalesce("bases", F.lit("--")), "quals": F.coalesce("quals", F.lit("--"))})


def allele_read_counts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Wide rows of allele:metric:... cells from the sixth column on as one row per locus and allele; the last line of a locus wins."""
    from helixframe.operators.relational import last_wins

    parts = F.split("value", "\t", -1)
    rows = lines(spark, paths).where(is_data() & (F.size(parts) >= 6)).select(parts[0].alias("contig"), parts[1].try_cast("bigint").alias("position"), F.slice(parts, 6, F.size(parts)).alias("cells"), "ord")
    cells = last_wins(rows, ["contig", "position"], "ord").select("contig", "position", F.explode("cells").alias("cell")).withColumn("f", F.split("cell", ":", -1)).where(F.size("f") >= 8)
    return cells.select("contig", "position", F.col("f")[0].alias("allele"), *(F.get("f", F.lit(k + 1)).try_cast("double").alias(n) for k, n in enumerate(METRICS)))


def contig_rows(spark: SparkSession, path: str, contig: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """Rows of one contig, from start to end if given, of a table that ``sinks.clustered`` wrote.

    The contig is a folder, so others aren't listed for the scan; positions are pushed to the row groups' statistics.
    """
    rows = spark.read.parquet(path).where(F.col("contig") == contig)
    rows = rows if start is None else rows.where(F.col("position") >= start)
    return rows if end is None else rows.where(F.col("position") <= end)

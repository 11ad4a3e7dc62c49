"""Free-text reports and alignments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.sources.columns import typed

SAM = [("name", "string"), ("flag", "int"), ("contig", "string"), ("pos", "bigint"), ("mapq", "int"), ("cigar", "string"), ("rnext", "string"), ("pnext", "bigint"), ("tlen", "bigint"), ("seq", "string"), ("qual", "string")]


def hla_report(spark: SparkSession, paths: str | list[str], section: str = "Inferred Allelic Pairs") -> DataFrame:
    """file, ord, molecule and allele of the section's rows, without each row's last field."""
    text = spark.read.text(paths, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    after = F.when(F.col("value").contains(section), F.substring_index("value", section, -1)).otherwise(F.raise_error(F.concat(F.lit(f"no section {section} in "), F.col("file"))))
    rows = text.select("file", F.posexplode(F.split(after, "\n")).alias("line", "row")).where((F.col("line") > 2) & (F.trim("row") != ""))
    fields = F.split(F.trim("row"), r"\s+")
    alleles = rows.select("file", "line", F.posexplode(F.slice(fields, 1, F.greatest(F.size(fields) - 1, F.lit(0)))).alias("field", "allele"))
    return alleles.select("file", (F.col("line") * 1000 + F.col("field")).cast("bigint").alias("ord"), F.substring_index("allele", "*", 1).alias("molecule"), "allele")


def sam_text(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    parts = F.split("value", "\t", -1)
    return spark.read.text(paths).where(~F.col("value").startswith("@") & (F.size(parts) >= 11)).select(*typed(parts, SAM)).drop("rnext", "pnext", "tlen")

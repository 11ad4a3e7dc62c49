"""Pileup lines as they arrive: the same operators on a stream of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.operators.pileup import extract_variants
from helixframe.sources.columns import is_data, typed
from helixframe.sources.pileups import PILEUP


def variant_stream(spark: SparkSession, folder: str, **thresholds) -> DataFrame:
    """Variants of every pileup file that comes into a folder. Extraction keeps no state, so no watermark is needed."""
    parts = F.split("value", "\t", -1)
    lines = spark.readStream.text(folder).where(is_data() & (F.size(parts) >= 4)).select(*typed(parts, PILEUP), F.col("value").alias("raw"))
    return extract_variants(lines.withColumn("ref", F.upper("ref")), **thresholds)

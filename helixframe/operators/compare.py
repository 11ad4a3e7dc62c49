"""Tumour against matched normal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.functions import indel_code
from helixframe.sources.pileups import EXTRACTED

_COLUMNS = [n for n, _ in EXTRACTED]


def compare_tumor_normal(tumor: DataFrame, normal: DataFrame, compat: bool = False, keys: tuple[str, ...] = ()) -> DataFrame:
    """Every tumour variant beside the normal's row for that allele, or what the normal shows instead.

    The same allele: its row. Only the locus: no support at the coverage of the locus's row with the smallest
    allele. Neither: uncovered (type U, ref N, alt Unread). Alleles are compared with their sequence;
    ``compat`` compares indels by kind and length alone and lets the last one stand for both. ``keys``: more
    columns to match, such as a sample. Two left joins; the normal is reduced to a row a locus for the second.
    """
    from helixframe.operators.relational import last_wins

    locus = ["contig", "position", *keys]
    code = indel_code(F.col("alt")) if compat else F.col("alt")
    t = tumor.withColumn("_allele", code)
    n = normal.withColumn("_allele", code)
    packed = n.select(*locus, "_allele", F.struct(*_COLUMNS).alias("n"))
    by_allele = last_wins(packed.withColumn("_order", F.struct("n.rawPileUpLine", "n.alt")), [*locus, "_allele"], "_order").drop("_order")
    by_locus = packed.groupBy(*locus).agg(F.min_by("n", F.col("n.alt")).alias("l"))
    joined = t.join(by_allele, [*locus, "_allele"], "left").join(by_locus, locus, "left")

    def missing(read: bool):
        values = {"mutCount": F.lit(0), "coverage": F.col("l.coverage") if read else F.lit(0), "mutPercent": F.lit(0.0), "contig": F.col("contig"), "position": F.col("position"), "ref": F.col("l.ref") if read else F.lit("N"), "alt": F.col("alt") if read else F.lit("Unread"), "type": F.col("type") if read else F.lit("U"), "strand": F.lit("+0-0"), "rawPileUpLine": F.col("l.rawPileUpLine") if read else F.lit("NA")}
        return F.struct(*(values[c].cast(ty).alias(c) for c, ty in EXTRACTED))

    side = F.coalesce("n", F.when(F.col("l").isNotNull(), missing(True)).otherwise(missing(False)))
    rows = joined.withColumn("normal", side)
    indel = F.col("alt").rlike("^[+-]")
    return rows.select(
        *keys,
        F.concat_ws(":", "contig", F.col("position").cast("string")).alias("locus"),
        F.col("ref"),
        indel_code(F.col("alt")).alias("var"),
        F.when(indel, "INDEL").otherwise("SUBSTITUTION").alias("varType"),
        F.col("mutCount").alias("tumorVarSupport"),
        F.col("coverage").alias("tumorCoverage"),
        F.col("normal.mutCount").alias("normalVarSupport"),
        F.col("normal.coverage").alias("normalCoverage"),
        F.col("strand").alias("tumorStrands"),
        F.col("normal.strand").alias("normalStrands"),
        F.when(indel, F.regexp_extract("alt", r"^[+-]\d+(.+)$", 1)).otherwise(F.col("alt")).alias("varSeq"),
        *(F.col(c).alias(f"tumor_{c}") for c in _COLUMNS),
        *(F.col(f"normal.{c}").alias(f"normal_{c}") for c in _COLUMNS),
    )


def variants_with_normal(tumor: DataFrame, normal: DataFrame, columns: list[str]) -> DataFrame:
    """Left join on the locus; the normal's columns are NA where it has none. Ordered by contig and position."""
    n = normal.select("contig", "position", *(F.col(c).cast("string").alias(f"normal_{c}") for c in columns))
    return tumor.join(n, ["contig", "position"], "left").na.fill("NA", [f"normal_{c}" for c in columns]).orderBy("contig", "position")


def variants_with_counts(variants: DataFrame, tumor_counts: DataFrame, normal_counts: DataFrame, strip_prefix: bool = True) -> DataFrame:
    """Left joins of allele counts of both samples at each variant's locus, only alternatives with tumour reads."""
    from helixframe.functions import with_prefix

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(with_prefix(F.col("contig")).alias("contig") if strip_prefix else F.col("contig"), "position", F.col("allele").alias("alt"), F.col("count").alias(f"{name}_count"), F.col("coverage").alias(f"{name}_coverage"))

    t, n = side(tumor_counts, "tumor"), side(normal_counts, "normal")
    v = variants.withColumn("contig", with_prefix(F.col("contig"))) if strip_prefix else variants
    out = v.join(t, ["contig", "position", "alt"], "left").join(n, ["contig", "position", "alt"], "left")
    return out.na.fill(0, ["tumor_count", "tumor_coverage", "normal_count", "normal_coverage"]).where("tumor_count > 0")

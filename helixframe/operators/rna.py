"""RNA evidence for DNA variants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.functions import fisher_exact, odds_ratio, safe_ratio
from helixframe.operators.pileup import alleles_of, coverage


def score(rows: DataFrame, min_difference: float = 10.0, max_p: float = 0.05, min_depth: int = 10, min_support: int = 3) -> DataFrame:
    """Adds rna_score 0-5, rna_pvalue and rna_odds_ratio (null unless tested).

    0 no data, 1 no supporting read, 2 too few reads, 4 about the DNA's share or no significant difference,
    5 above it, 3 below it. Needs rna_depth, rna_support, tumor_depth, tumor_supporting.
    """
    depth, support = F.coalesce("rna_depth", F.lit(0)), F.coalesce("rna_support", F.lit(0))
    ratio = F.try_divide(F.try_divide(support.cast("double"), depth), F.try_divide(F.col("tumor_supporting").cast("double"), "tumor_depth"))
    rows = rows.withColumns({"rna_depth": depth, "rna_support": support}).withColumn("_ratio", ratio)
    rows = rows.withColumn("_level", F.when(F.col("rna_depth") == 0, 0).when(F.col("rna_support") == 0, 1).when((F.col("rna_depth") < min_depth) | (F.col("rna_support") < min_support), 2).when(F.col("_ratio").isNull() | (F.abs(F.col("_ratio") - 1) < min_difference / 100), 4))
    table = ["rna_support", "rna_depth", "tumor_supporting", "tumor_depth"]
    tested = rows.where(F.col("_level").isNull()).select(*table).distinct().withColumns({"rna_pvalue": fisher_exact(*table), "rna_odds_ratio": odds_ratio(*table)})
    scored = rows.join(tested, table, "left").withColumns({"rna_pvalue": F.when(F.col("_level").isNull(), F.col("rna_pvalue")), "rna_odds_ratio": F.when(F.col("_level").isNull(), F.col("rna_odds_ratio"))})
    level = F.coalesce("_level", F.when(F.col("rna_pvalue") > max_p, 4).when(F.col("_ratio") > 1, 5).otherwise(3))
    return scored.withColumn("rna_score", level.cast("int")).drop("_ratio", "_level")


def tested(rows: DataFrame) -> DataFrame:
    """Adds rna_pvalue and rna_odds_ratio of the RNA's against the tumour's counts, null without RNA; each distinct table is tested once."""
    table = ["rna_support", "rna_depth", "tumor_supporting", "tumor_depth"]
    tables = rows.where("rna_depth is not null").select(*table).distinct().withColumns({"rna_pvalue": fisher_exact(*table), "rna_odds_ratio": odds_ratio(*table)})
    return rows.join(tables, table, "left")


def pileup_evidence(variants: DataFrame, rna: DataFrame) -> DataFrame:
    """rna_depth and rna_support of each single-base variant from RNA pileup lines at its locus."""
    # A line brings its alleles along, so that lines are read, and joined, once.
    lines = rna.where("depth > 0").select("contig", "position", coverage(F.col("depth"), F.col("bases")).cast("int").alias("rna_depth"), F.transform(alleles_of(F.col("bases"), F.col("ref")), lambda a: a["allele"]).alias("_alleles"))
    single = (F.length("ref") == 1) & (F.length("alt") == 1)
    joined = variants.where(single).join(lines, ["contig", "position"], "left")
    own = F.filter("_alleles", lambda a: a == F.col("alt"))
    return joined.withColumn("rna_support", F.when(F.col("_alleles").isNull(), 0).otherwise(F.size(own))).drop("_alleles")


def vcf_evidence(variants: DataFrame, rna: DataFrame) -> DataFrame:
    """The same from decoded VCF rows (contig, position, t.depth, t.by_allele)."""
    cells = rna.select("contig", "position", F.col("t.depth").alias("rna_depth"), F.col("t.by_allele").alias("_by"))
    joined = variants.join(cells, ["contig", "position"], "left")
    return joined.withColumn("rna_support", F.coalesce(F.col("_by")[F.col("alt")], F.lit(0))).drop("_by")


def normalised_reads(bases, ref, compat: bool = True):
    """A read string in upper case with match symbols as the reference and insertions cut out.

    It keeps quality signs and deleted bases, as a plain text substitution does; counting with
    ``pileup.alleles_of`` does not. ``compat`` lets an insertion swallow the letters that follow it.
    """
    text = F.upper(F.replace(F.replace(bases, F.lit("."), ref), F.lit(","), ref))
    return F.regexp_replace(F.regexp_replace(text, r"\+\d+[ACGTN]+" if compat else r"\+\d+", ""), "[^ACGT]", "")


def text_count(text, allele):
    """How often an allele occurs in a text."""
    return F.when(F.length(allele) > 0, ((F.length(text) - F.length(F.replace(text, allele, F.lit("")))) / F.length(allele)).cast("int")).otherwise(0)


def support_fraction(rows: DataFrame) -> DataFrame:
    return rows.withColumn("rna_fraction", safe_ratio(F.col("rna_support"), F.col("rna_depth"), float("nan")))

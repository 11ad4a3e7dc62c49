"""Writers. Each takes a DataFrame and a folder; Spark writes its parts there in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.functions import without_prefix
from helixframe.operators.callers import caller_matrix, karyotype_order


def delimited(df: DataFrame, path: str, sep: str = "\t", header: bool = True, null: str = "NA", compression: str | None = None) -> None:
    flat = df.select(*(F.to_json(c).alias(c) if t.startswith(("map", "array", "struct")) else F.col(c) for c, t in df.dtypes))
    writer = flat.write.option("sep", sep).option("header", header).option("nullValue", null).option("quote", "").option("emptyValue", "")
    (writer.option("compression", compression) if compression else writer).csv(path)


def extracted_variants(df: DataFrame, path: str) -> None:
    """The ten-column table; its first column's name carries the comment sign."""
    delimited(df.withColumnRenamed("mutCount", "#mutCount"), path)


def targets(variants: DataFrame, path: str) -> None:
    variants.select("contig", "position").distinct().write.parquet(path)


def comparison(df: DataFrame, path: str) -> None:
    delimited(df, path)


def caller_tables(calls: DataFrame, path: str) -> None:
    calls.write.partitionBy("source").parquet(path)


def consensus_table(calls: DataFrame, sources: list[str], path: str, rna: DataFrame | None = None) -> None:
    """Key, hits, and a count text or NA for each source; with RNA evidence one more column."""
    wide = caller_matrix(calls, sources)
    if rna is not None:
        text = F.concat_ws(",", *(F.col(c).cast("string") for c in ("rna_score", "rna_support", "rna_depth", "rna_pvalue")))
        wide = wide.join(rna.select("contig", "position", "ref", "alt", text.alias("RNASupport")), ["contig", "position", "ref", "alt"], "left")
    delimited(karyotype_order(wide), path)


def consensus_records(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def fused_table(df: DataFrame, path: str) -> None:
    columns = ["contig", "position", "ref", "alt", "normal_depth", "normal_supporting", "tumor_depth", "tumor_supporting"]
    delimited(karyotype_order(df.select(*columns, *(c for c in ("rna_score",) if c in df.columns))), path)


def annotation_input(df: DataFrame, path: str) -> None:
    delimited(annotation_rows(df), path)


def annotation_rows(df: DataFrame) -> DataFrame:
    """Single-base variants: chr, start, end, ref, alt, depth, reads, fraction, normal depth."""
    single = df.where((F.length("ref") == F.length("alt")) & ~F.col("alt").contains("*"))
    rows = single.select(F.col("contig").alias("chr"), F.col("position").alias("start"), (F.col("position") + F.length("ref") - 1).alias("end"), F.col("ref").alias("ref_allele"), F.col("alt").alias("alt_allele"), "tumor_depth", "tumor_supporting", F.bround(F.try_divide("tumor_supporting", "tumor_depth"), 4).alias("vaf"), "normal_depth")
    return karyotype_order(rows, "chr", "start")


def peptide_files(peptides: DataFrame, path: str) -> None:
    """One folder for each length."""
    peptides.select("k", "peptide").distinct().write.partitionBy("k").text(path)


def pass_fail(classified: DataFrame, path: str, columns: list[str]) -> None:
    """Passing rows as they came; failing ones with metrics and reason."""
    delimited(classified.where("reason = 'PASS'").select(*columns), f"{path}/pass")
    delimited(classified.where("reason <> 'PASS'").select(*columns, "frequency", "ref_strandedness", "var_strandedness", "reason"), f"{path}/fail")


def epitope_report(report: DataFrame, notes: DataFrame, path: str) -> None:
    """The report, and its comment block as a small table beside it."""
    delimited(report.withColumn("contig", without_prefix(F.col("contig"))) if "contig" in report.columns else report, f"{path}/report")
    notes.write.json(f"{path}/notes")


def positions(df: DataFrame, path: str) -> None:
    delimited(df.select("contig", "start", "end"), path, header=False)


def compressed(df: DataFrame, path: str) -> None:
    delimited(df, path, compression="gzip")


def clustered(df: DataFrame, path: str, rows_a_file: int = 1_000_000) -> None:
    """Rows by contig and position: a folder a contig, files that cover stretches of it, and in them the least and greatest position of every row group.

    ``sources.contig_rows`` reads one contig, or a stretch of it, without opening the rest. A contig's rows are spread
    over as many files as they fill.
    """
    out = df.repartitionByRange("contig", "position").sortWithinPartitions("contig", "position")
    out.write.option("maxRecordsPerFile", rows_a_file).option("parquet.block.size", 16 << 20).partitionBy("contig").parquet(path)

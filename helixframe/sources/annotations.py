"""Annotations, proteins, predictions and intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.functions import identifier
from helixframe.sources.columns import lines, typed, with_header

#: Canonical annotation fields and the headers they come under.
MAF_ALIASES = {
    "gene": ["Hugo_Symbol"], "contig": ["Chromosome"], "position": ["Start_position", "Start_Position"], "ref": ["Reference_Allele"], "alt": ["Tumor_Seq_Allele2"],
    "variant_class": ["Variant_Classification"], "variant_type": ["Variant_Type"], "protein_change": ["Protein_Change"], "transcript": ["Annotation_Transcript"],
    "description": [], "genome_change": ["Genome_Change"], "exon": ["Transcript_Exon"], "cdna_change": ["cDNA_Change"],
}
PREDICTION = [
    ("pos", "string"), ("hla", "string"), ("peptide", "string"), ("core", "string"), ("offset", "string"), ("ipos", "int"), ("ilen", "int"), ("dpos", "int"),
    ("dlen", "int"), ("icore", "string"), ("identity", "string"), ("log", "double"), ("affinity", "double"), ("rank", "double"), ("arrow", "string"), ("bindingFlag", "string"),
]


def maf(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return with_header(lines(spark, paths, encoding="ISO-8859-1"), MAF_ALIASES, {"position": "bigint"}, comment="#")


def protein_fasta(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """protein, transcript, gene, sequence; identifiers in upper case without version."""
    records = spark.read.option("lineSep", ">").text(paths).where(F.trim("value") != "")
    head = F.substring_index("value", "\n", 1)
    tags = F.str_to_map(F.regexp_replace(head, r"^\S+\s*", ""), F.lit(" "), F.lit(":"))
    sequence = F.regexp_replace(F.substring(F.col("value"), F.length(head) + 1, F.length("value")), r"\s", "")
    return records.select(identifier(F.regexp_extract(head, r"^(\S+)", 1)).alias("protein"), identifier(tags["transcript"]).alias("transcript"), identifier(tags["gene"]).alias("gene"), sequence.alias("sequence"))


def binding_report(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Prediction rows of 14 fields, or 16 where the last is the binding flag; any other width is an error."""
    text = F.trim("value")
    rows = lines(spark, paths).where((text != "") & ~text.startswith("#") & ~text.rlike("^-+$") & ~text.rlike(r"^[Pp]os\s") & ~text.rlike(r"^(Protein|Error)\b"))
    parts = F.split(text, r"\s+")
    rows = rows.withColumn("parts", F.when(F.size(parts).isin(14, 16), parts).otherwise(F.raise_error(F.concat(F.lit("neither 14 nor 16 fields: "), text))))
    return rows.select(*typed(F.col("parts"), PREDICTION), "ord").drop("arrow").withColumn("hla", F.regexp_replace("hla", "^HLA-", ""))


def bed(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    parts = F.split("value", "\t", -1)
    return lines(spark, paths).where(F.size(parts) >= 3).select(parts[0].alias("contig"), parts[1].try_cast("bigint").alias("start"), parts[2].try_cast("bigint").alias("end")).where("start is not null and end is not null")


def pad_intervals(intervals: DataFrame, padding: int = 100) -> DataFrame:
    return intervals.withColumns({"start": F.greatest(F.col("start") - padding, F.lit(0)), "end": F.col("end") + padding})


def merge_intervals(intervals: DataFrame, stride: int = 100_000) -> DataFrame:
    """Overlapping or touching intervals of a contig as one.

    A segmented scan: intervals are first one a start (the longest), so that a stretch of a contig has ``stride`` of
    them at most; each (contig, stretch) is scanned by itself, and the state it is entered with (the furthest end, and
    the number of merged intervals so far) follows from a scan over one row a stretch. A hot contig is spread.
    """
    one = intervals.where("contig is not null and start is not null and end is not null").groupBy("contig", "start").agg(F.max("end").alias("end")).withColumn("_s", F.floor(F.col("start") / stride))
    inside, along = Window.partitionBy("contig", "_s").orderBy("start"), Window.partitionBy("contig").orderBy("_s")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    reach = one.groupBy("contig", "_s").agg(F.max("end").alias("_r")).select("contig", "_s", F.max("_r").over(before(along)).alias("_entry"))
    marked = one.join(reach, ["contig", "_s"]).withColumn("_before", F.greatest(F.max("end").over(before(inside)), F.col("_entry")))
    marked = marked.withColumn("_fresh", F.when(F.col("start") <= F.col("_before"), 0).otherwise(1))
    so_far = marked.groupBy("contig", "_s").agg(F.sum("_fresh").alias("_f")).select("contig", "_s", F.coalesce(F.sum("_f").over(before(along)), F.lit(0)).alias("_runs"))
    numbered = marked.withColumn("_own", F.sum("_fresh").over(inside)).join(so_far, ["contig", "_s"])
    return numbered.groupBy("contig", (F.col("_runs") + F.col("_own")).alias("_run")).agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_run")


def allele_list(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return lines(spark, paths).where(F.trim("value") != "").select(F.split(F.trim("value"), r"\s+")[0].alias("allele")).distinct()

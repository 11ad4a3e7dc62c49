"""Neighbouring mutations: runs of single-base variants, fused."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions import safe_ratio

#: Positions that one window task covers at most, besides a run that crosses its border.
STRIDE = 1_000_000
#: RNA evidence of a variant, where it has been measured.
RNA = ["rna_score", "rna_support", "rna_depth"]


def runs(variants: DataFrame, max_difference: float = 10.0, max_length: int | None = None, stride: int = STRIDE) -> DataFrame:
    """Single-base variants of unambiguous positions with run_start and run_length.

    A run is a maximal chain of neighbouring positions whose tumour fractions differ by at most
    ``max_difference`` per cent from one to the next; ``max_length`` cuts it. A position with several
    alternatives is in no run. Windows are over (contig, stretch of positions): chains are found by joining
    each row with its left neighbour, so a hot contig is spread, and only runs that touch a border are
    stitched through the row before it. ``stride`` must exceed the longest run.
    """
    single = variants.where((F.length("ref") == 1) & (F.length("alt") == 1) & (F.col("alt") != "*"))
    one = single.groupBy("contig", "position").agg(F.count("*").alias("_n"), F.first(F.struct(*single.columns)).alias("_r")).where("_n = 1").select("_r.*")
    one = one.withColumn("_f", safe_ratio(F.col("tumor_supporting"), F.col("tumor_depth")))
    left = one.select("contig", (F.col("position") + 1).alias("position"), F.col("_f").alias("_before"))
    linked = one.join(left, ["contig", "position"], "left").withColumn("_new", F.col("_before").isNull() | (F.abs(F.col("_f") - F.col("_before")) > max_difference / 100 + 1e-12))
    linked = linked.withColumn("_bin", F.floor(F.col("position") / stride))
    so_far = Window.partitionBy("contig", "_bin").orderBy("position")
    marked = linked.withColumn("_start", F.last(F.when(F.col("_new"), F.col("position")), ignorenulls=True).over(so_far))
    # A run that begins in an earlier stretch takes that stretch's last start; runs never skip a position.
    ends = marked.groupBy("contig", "_bin").agg(F.max_by("_start", "position").alias("_carry")).withColumn("_bin", F.col("_bin") + 1)
    joined = marked.join(ends, ["contig", "_bin"], "left").withColumn("run_start", F.coalesce("_start", "_carry", "position"))
    if max_length:
        joined = joined.withColumn("run_start", F.col("run_start") + F.floor((F.col("position") - F.col("run_start")) / max_length) * max_length)
    sizes = joined.groupBy("contig", "run_start").agg(F.count("*").cast("int").alias("run_length"))
    return joined.join(sizes, ["contig", "run_start"]).drop("_f", "_before", "_new", "_bin", "_start", "_carry")


def fuse(variants: DataFrame, max_difference: float = 10.0, max_length: int | None = None, compat: bool = False) -> DataFrame:
    """Variants with each run of two or more in one row: alleles joined in order, counts averaged half-even.

    RNA evidence is averaged likewise where ``variants`` has it. ``compat`` fuses greedy pairs and divides by one
    site less.
    """
    counts = ["normal_depth", "normal_supporting", "tumor_depth", "tumor_supporting", *(c for c in RNA if c in variants.columns)]
    found = runs(variants, max_difference, 2 if compat else max_length).where("run_length > 1")
    ordered = F.array_sort(F.collect_list(F.struct("position", "ref", "alt")))
    divisor = F.col("sites") - 1 if compat else F.col("sites")
    grouped = found.groupBy("contig", F.col("run_start").alias("position")).agg(F.count("*").alias("sites"), ordered.alias("_s"), *(F.sum(c).alias(c) for c in counts))
    fused = grouped.select("contig", "position", F.array_join(F.transform("_s", lambda x: x["ref"]), "").alias("ref"), F.array_join(F.transform("_s", lambda x: x["alt"]), "").alias("alt"), *(F.bround(F.col(c) / divisor, 0).cast("int").alias(c) for c in counts), F.lit(True).alias("fused"))
    rest = variants.join(found.select("contig", "position").distinct(), ["contig", "position"], "left_anti").select("contig", "position", "ref", "alt", *(F.col(c).cast("int").alias(c) for c in counts), F.lit(False).alias("fused"))
    return fused.unionByName(rest)


def same_residue_runs(rows: DataFrame, order: str = "ord", stride: int = STRIDE) -> DataFrame:
    """Adds run_id: neighbouring rows of one gene and one residue (both known), at neighbouring positions, share it.

    Rows are in the order of (position, ``order``) within a gene. Windows are over (gene, stretch of positions), which
    must exceed the longest run; the row before a stretch and the run that enters it come from the stretch before, so a
    hot gene is spread. ``run_id`` is unique within a gene: the run's first position and order.
    """
    binned = rows.withColumn("_s", F.floor(F.col("position") / stride))
    w = Window.partitionBy("gene", "_s").orderBy("position", order)
    place = F.struct("position", F.col(order).alias("ord"))
    ends = binned.groupBy("gene", (F.col("_s") + 1).alias("_s")).agg(F.max(F.struct(place.alias("at"), "residue")).alias("_last"))
    joined = binned.join(ends, ["gene", "_s"], "left")
    before = F.coalesce(F.lag(F.struct(place.alias("at"), "residue")).over(w), F.col("_last"))
    marked = joined.withColumn("_b", before)
    same = (F.col("_b.residue") == F.col("residue")) & (F.col("_b.at.position") + 1 == F.col("position")) & (F.col("residue") != "NA") & (F.col("gene") != "NA")
    marked = marked.withColumn("_start", F.last(F.when(F.coalesce(same, F.lit(False)), None).otherwise(place), ignorenulls=True).over(w))
    # A run that enters a stretch has the id of the last run of the stretch before; runs never skip a position.
    carried = marked.groupBy("gene", (F.col("_s") + 1).alias("_s")).agg(F.max_by("_start", place).alias("_carry"))
    return marked.join(carried, ["gene", "_s"], "left").withColumn("run_id", F.coalesce("_start", "_carry")).drop("_s", "_last", "_b", "_start", "_carry")


def mnv_candidates(rows: DataFrame, order: str = "ord") -> DataFrame:
    """Runs of at least two rows: start, end, joined bases, and the first row's detail."""
    parts = F.array_sort(F.collect_list(F.struct(order, "position", "ref", "alt", "detail")))
    grouped = same_residue_runs(rows, order).groupBy("gene", "residue", "run_id").agg(parts.alias("p"), F.first("contig").alias("contig"), F.count("*").alias("sites")).where("sites > 1")
    return grouped.select("contig", "gene", "residue", F.col("p")[0]["position"].alias("start"), F.element_at("p", -1)["position"].alias("end"), F.array_join(F.transform("p", lambda x: x["ref"]), "").alias("ref"), F.array_join(F.transform("p", lambda x: x["alt"]), "").alias("alt"), "sites", F.col("p")[0]["detail"].alias("detail"))

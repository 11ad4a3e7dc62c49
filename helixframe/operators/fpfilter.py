"""False-positive filter: variants joined with per-allele read metrics, and a cascade whose first failing rule names the reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.functions import decode_ambiguity

#: The cascade's limits.
LIMITS = {"read_position": 0.10, "strandedness": 0.01, "count": 4, "frequency": 0.05, "mmqs_difference": 50, "mapq_difference": 30, "length_difference": 25, "dist3": 0.20, "mmqs": 100}


def with_metrics(variants: DataFrame, metrics: DataFrame) -> DataFrame:
    """Left joins of the reference's and the variant's metrics as structs r and v; ambiguity codes are decoded."""
    fields = [c for c in metrics.columns if c not in ("contig", "position", "allele")]
    named = metrics.select("contig", "position", "allele", F.struct(*fields).alias("m"))
    alleles = variants.withColumns({"ref_base": F.upper("ref"), "var_base": decode_ambiguity(F.upper("ref"), F.upper("alt"))})
    out = alleles
    for name, base in (("r", "ref_base"), ("v", "var_base")):
        out = out.join(named.withColumnRenamed("allele", base).withColumnRenamed("m", name), ["contig", "position", base], "left")
    seen = metrics.select("contig", "position").distinct().withColumn("has_counts", F.lit(True))
    return out.join(seen, ["contig", "position"], "left").withColumn("has_counts", F.coalesce("has_counts", F.lit(False)))


def strandedness(plus, minus):
    return F.coalesce(F.round(F.try_divide(plus.cast("double"), plus + minus), 2), F.lit(0.5))


def classify(joined: DataFrame, limits: dict[str, float] | None = None, compat: bool = False) -> DataFrame:
    """Adds ``reason``: PASS or the first rule that fails. ``compat`` drops rows whose variant has no reads."""
    k = LIMITS | (limits or {})
    r, v = (lambda c: F.col(f"r.{c}")), (lambda c: F.col(f"v.{c}"))
    r_count, v_count = F.coalesce(r("count"), F.lit(0.0)), F.coalesce(v("count"), F.lit(0.0))
    r_strand, v_strand = strandedness(r("plus"), r("minus")), strandedness(v("plus"), v("minus"))
    odd = lambda s: (s < k["strandedness"]) | (s > 1 - k["strandedness"])
    r_mmqs, v_mmqs = F.coalesce(r("mmqs"), F.lit(50.0)), F.coalesce(v("mmqs"), F.lit(0.0))
    frequency = F.coalesce(F.try_divide(v_count, v_count + r_count), F.lit(0.0))
    reason = (
        F.when(~F.col("has_counts"), "no_readcounts")
        .when(v_count == 0, "no_variant_reads")
        .when(v("readpos") < k["read_position"], "read_position")
        .when(odd(v_strand) & ~odd(r_strand), "strandedness")
        .when(v_count < k["count"], "count")
        .when(frequency < k["frequency"], "frequency")
        .when(v_mmqs - r_mmqs > k["mmqs_difference"], "mmqs_difference")
        .when(F.coalesce(r("mapq"), v("mapq")) - v("mapq") > k["mapq_difference"], "mapq_difference")
        .when(F.coalesce(r("readlen"), v("readlen")) - v("readlen") > k["length_difference"], "length_difference")
        .when(v("dist3") < k["dist3"], "dist3")
        .when(v_mmqs > k["mmqs"], "mmqs")
        .otherwise("PASS")
    )
    out = joined.withColumns({"frequency": frequency, "ref_strandedness": r_strand, "var_strandedness": v_strand, "reason": reason})
    return out.where("reason <> 'no_variant_reads'") if compat else out


def statistics(classified: DataFrame) -> DataFrame:
    return classified.groupBy("reason").agg(F.count("*").alias("n"))

"""HLA types, binding predictions and the neoepitope report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions import hla_two_fields, safe_ratio
from helixframe.operators.relational import last_wins


def top_two_alleles(rows: DataFrame, keys: tuple[str, ...] = ("sample", "molecule")) -> DataFrame:
    """At most two distinct alleles (of two fields) of each molecule: those that sort first by the second field, then by first occurrence."""
    first = rows.withColumn("allele", hla_two_fields(F.col("allele"))).groupBy(*keys, "allele").agg(F.min("ord").alias("ord"))
    order = Window.partitionBy(*keys).orderBy(F.substring_index("allele", ":", -1), "ord")
    return first.withColumn("place", F.row_number().over(order)).where("place <= 2").drop("ord")


def attach_hla(rows: DataFrame, calls: DataFrame, sample: str = "sample", into: str = "hla") -> DataFrame:
    """The sample's HLA calls as a map from molecule to alleles, in the column ``into``.

    An error where rows have calls already, or where a sample's molecule comes from two files or a file gives
    two molecules' calls (``calls`` with a column file).
    """
    if into in rows.columns:
        raise ValueError("rows have HLA calls already")
    calls = calls.withColumn("molecule", F.upper("molecule"))
    if "file" in calls.columns:
        for key, other, what in ((["molecule"], "file", "molecule called in several files: "), (["file"], "molecule", "file given for several molecules: ")):
            several = calls.groupBy(sample, *key).agg(F.count_distinct(other).alias("_n"))
            text = F.concat(F.lit(what), F.col(key[0]))
            calls = calls.join(several, [sample, *key]).where(F.when(F.col("_n") == 1, F.lit(True)).otherwise(F.raise_error(text).cast("boolean"))).drop("_n")
    packed = calls.groupBy(sample, "molecule").agg(F.sort_array(F.collect_set("allele")).alias("alleles")).groupBy(sample).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("molecule", "alleles")))).alias(into))
    return rows.join(packed, sample, "left")


def permitted(alleles: DataFrame, allowed: DataFrame, keep: bool = True) -> DataFrame:
    """Alleles on the list, or (``keep`` false) the others, once each."""
    return alleles.join(allowed.select("allele").distinct(), "allele", "left_semi") if keep else alleles.select("allele").distinct().join(allowed, "allele", "left_anti")


def work_list(alleles: DataFrame, sizes: tuple[int, ...] = (8, 9, 10)) -> DataFrame:
    """Every allele with every peptide length."""
    return alleles.distinct().withColumn("k", F.explode(F.array(*map(F.lit, sizes))))


def prediction_index(predictions: DataFrame, ord: str = "ord") -> DataFrame:
    """The last prediction of each peptide and allele."""
    return last_wins(predictions, ["peptide", "hla"], ord)


FIELDS = ("log", "affinity", "rank", "core", "bindingFlag")


def packed_predictions(predictions: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row for each peptide (and keys): ``by_hla``, a map from allele to its prediction. One prediction a peptide and allele."""
    fields = [c for c in FIELDS if c in predictions.columns]
    return predictions.groupBy(*keys, "peptide").agg(F.map_from_entries(F.collect_list(F.struct("hla", F.struct(*fields)))).alias("by_hla"))


def report(peptides: DataFrame, predictions: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Mutant peptides with their wild-type partners and both predictions for the same allele, and how they compare.

    Predictions are rows, or packed. ``keys`` are further columns that both sides have, such as the sample.
    Alleles stay packed while peptides are joined, and are spelled out last.
    """
    packed = predictions if "by_hla" in predictions.columns else packed_predictions(predictions, keys)
    fields = packed.schema["by_hla"].dataType.valueType.names
    side = lambda s: packed.select(*keys, F.col("peptide").alias(f"{s}_peptide"), F.col("by_hla").alias(f"_{s}"))
    joined = peptides.where("mut_peptide <> wt_peptide").join(side("mut"), [*keys, "mut_peptide"]).join(side("wt"), [*keys, "wt_peptide"])
    spelled = joined.select("*", F.explode("_mut").alias("hla", "_m")).withColumn("_w", F.col("_wt")[F.col("hla")]).where("_w is not null")
    named = [F.col(f"_{s[0]}.{c}").alias(f"{s}_{c}") for s in ("mut", "wt") for c in fields]
    out = spelled.select(*peptides.columns, "hla", *named)
    out = out.withColumns({f"{c}_ratio": safe_ratio(F.col(f"mut_{c}"), F.col(f"wt_{c}"), None) for c in ("log", "affinity") if c in fields})
    return out.withColumn("rank_difference", F.col("wt_rank") - F.col("mut_rank")) if "rank" in fields else out


def annotated_report(rows: DataFrame, annotations: DataFrame, rna: DataFrame | None = None) -> DataFrame:
    """Joined with annotations on the key without the chr prefix; RNA evidence where there is some."""
    from helixframe.functions import without_prefix

    key = ["_contig", "position", "ref", "alt"]
    left = rows.withColumn("_contig", without_prefix(F.col("contig")))
    right = annotations.withColumn("_contig", without_prefix(F.col("contig"))).drop("contig")
    out = left.join(right, key).drop("_contig")
    return out.join(rna, ["contig", "position", "ref", "alt"], "left") if rna is not None else out

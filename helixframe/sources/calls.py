"""Variant callers' outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.functions.binding import let
from helixframe.sources.columns import headers, is_data, lines, typed, with_header

#: The 23 columns of the format.
VARSCAN = [
    ("contig", "string"), ("position", "bigint"), ("ref", "string"), ("alt", "string"), ("normal_reads1", "int"), ("normal_reads2", "int"), ("normal_var_freq", "string"),
    ("normal_gt", "string"), ("tumor_reads1", "int"), ("tumor_reads2", "int"), ("tumor_var_freq", "string"), ("tumor_gt", "string"), ("somatic_status", "string"),
    ("variant_p_value", "double"), ("somatic_p_value", "double"), ("tumor_reads1_plus", "int"), ("tumor_reads1_minus", "int"), ("tumor_reads2_plus", "int"),
    ("tumor_reads2_minus", "int"), ("normal_reads1_plus", "int"), ("normal_reads1_minus", "int"), ("normal_reads2_plus", "int"), ("normal_reads2_minus", "int"),
]
#: Canonical names and the spellings that headers use.
MUTECT_ALIASES = {"contig": ["chrom", "chromosome", "chr"], "position": ["pos"], "ref": ["ref_allele", "refallele", "reference"], "alt": ["alt_allele", "altallele", "var", "variant"], "t_ref_count": [], "t_alt_count": [], "n_ref_count": [], "n_alt_count": []}
VARSCAN_ALIASES = {"contig": ["chrom", "chromosome", "chr"], "position": ["pos"], "ref": ["ref_allele", "refallele", "reference"], "alt": ["var", "variant", "alt_allele", "altallele"]}


def info_map(info: Column) -> Column:
    """k=v;... as a map; the bare word INDEL, or its absence, becomes the key type; NA is empty."""
    pairs = F.str_to_map(F.when(info == "NA", "").otherwise(info), F.lit(";"), F.lit("="))
    kind = F.when(F.array_contains(F.split(info, ";"), "INDEL"), "Indel").otherwise("Substitution")
    return F.map_concat(F.map_filter(pairs, lambda k, v: (k != "") & (k != "INDEL") & (k != "type")), F.create_map(F.lit("type"), kind))


def vcf(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Fixed fields, alts as an array, and samples as a map from name to (field to text); names are those of each file's own header."""
    rows = lines(spark, paths)
    heads = rows.where(F.col("value").startswith("#CHROM")).groupBy("file").agg(F.min_by("value", "ord").alias("_head"))
    parts = F.split("value", "\t", -1)
    body = rows.where(is_data() & (F.size(parts) >= 5)).join(heads, "file", "left")
    head = F.coalesce("_head", F.raise_error(F.concat(F.lit("no header line in "), F.col("file"))))
    keys = F.split(F.get(parts, F.lit(8)), ":")
    names = F.filter(F.split(head, "\t"), lambda n, i: i >= 9)
    samples = F.map_from_entries(F.transform(names, lambda n, i: F.struct(n, _cell_map(keys, F.get(parts, i + 9)))))
    return body.select(parts[0].alias("contig"), parts[1].try_cast("bigint").alias("position"), parts[2].alias("id"), parts[3].alias("ref"), F.split(parts[4], ",").alias("alts"), F.get(parts, F.lit(5)).alias("qual"), F.get(parts, F.lit(6)).alias("filter"), F.get(parts, F.lit(7)).alias("info"), samples.alias("samples"), "ord")


def _cell_map(keys: Column, cell: Column) -> Column:
    values = F.split(cell, ":", -1)
    return F.map_from_entries(F.transform(keys, lambda k, i: F.struct(k, F.get(values, i))))


def sample_cell(cell: Column, alleles: Column, minimum_depth: int = 0) -> Column:
    """A sample's map decoded: called, alleles of the genotype, depth, depth by allele, and zygosity.

    ``alleles`` is the array of ref and alts. Phased and unphased genotypes alike; ``.`` is no allele.
    """
    gt = F.filter(F.transform(F.split(cell["GT"], r"[/|]"), lambda a: a.try_cast("int")), lambda a: a.isNotNull())
    ad = F.transform(F.split(cell["AD"], ","), lambda x: F.coalesce(x.try_cast("int"), F.lit(0)))

    def decoded(v: Column) -> Column:
        return F.struct(
            (F.size(v["distinct"]) > 0).alias("called"),
            F.sort_array(v["distinct"]).alias("genotype"),
            v["depth"].alias("depth"),
            F.map_from_entries(F.filter(F.transform(alleles, lambda a, i: F.struct(a.alias("key"), F.get(v["ad"], i).alias("value"))), lambda e: e["value"].isNotNull())).alias("by_allele"),
            (F.size(v["distinct"]) > 1).alias("heterozygous"),
            (F.size(v["distinct"]) == 1).alias("homozygous"),
            ((F.size(v["distinct"]) > 0) & (v["distinct"] != F.array(F.lit(0)))).alias("abnormal"),
            (v["depth"] >= minimum_depth).alias("deep"),
        )

    # Both fields are split once, whatever is read of them.
    depth = lambda x: F.coalesce(F.aggregate(x, F.lit(0), lambda s, n: s + n), F.lit(0))
    return let(ad, lambda x: let(F.struct(F.array_distinct(gt).alias("distinct"), x.alias("ad"), depth(x).alias("depth")), decoded))


def genotype_vcf(spark: SparkSession, paths: str | list[str], normal: str, tumor: str) -> DataFrame:
    """A row for each alternative, with both samples decoded."""
    rows = vcf(spark, paths)
    alleles = F.concat(F.array("ref"), "alts")
    rows = rows.withColumns({"n": sample_cell(F.col("samples")[normal], alleles), "t": sample_cell(F.col("samples")[tumor], alleles)})
    return rows.select("contig", "position", "ref", "alts", "filter", "n", "t", "ord")


def mutect(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Calls by each file's header; a judgement column is kept where any file has one."""
    rows = lines(spark, paths)
    judged = not headers(rows).where(F.exists("head", lambda n: F.lower(n) == "judgement")).isEmpty()
    aliases = dict(MUTECT_ALIASES) | ({"judgement": []} if judged else {})
    counts = dict.fromkeys(("t_ref_count", "t_alt_count", "n_ref_count", "n_alt_count"), "int") | {"position": "bigint"}
    found = with_header(rows, aliases, counts, optional=("judgement",))
    return found.withColumns({"normal_depth": F.col("n_ref_count") + F.col("n_alt_count"), "normal_supporting": F.col("n_alt_count"), "tumor_depth": F.col("t_ref_count") + F.col("t_alt_count"), "tumor_supporting": F.col("t_alt_count")})


def varscan_fixed(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The 23 columns; header lines don't parse and are dropped."""
    parts = F.split("value", "\t", -1)
    return lines(spark, paths).where(is_data() & (F.size(parts) >= 23)).select(*typed(parts, VARSCAN), "ord").where("position is not null")


def varscan_native(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return with_header(lines(spark, paths), VARSCAN_ALIASES, {"position": "bigint"})


def multi_caller_calls(spark: SparkSession, paths: str | list[str], places: dict[str, tuple[int, int, int, int]], otherwise: tuple[int, int, int, int] = (0, 1, 3, 4)) -> DataFrame:
    """Calls of several callers; the caller is the third path component from the end, up to its first dot.

    ``places``: for each caller where contig, position, ref and alt are; a ref field such as A>G or A/G holds both.
    """
    rows = lines(spark, paths)
    parts = F.split("value", "\t", -1)
    caller = F.regexp_extract("file", r"([^/.]*)[^/]*/[^/]*/[^/]*$", 1)
    fields = [otherwise, *places.values()]

    def pick(k: int) -> Column:
        out = F.get(parts, F.lit(otherwise[k]))
        for name, where in places.items():
            out = F.when(caller == name, F.get(parts, F.lit(where[k]))).otherwise(out)
        return out

    assert all(len(f) == 4 for f in fields)
    both = F.split(pick(2), "[>/]")
    paired = F.size(both) == 2
    return rows.where(is_data()).select(caller.alias("source"), pick(0).alias("contig"), pick(1).try_cast("bigint").alias("position"), F.when(paired, both[0]).otherwise(pick(2)).alias("ref"), F.when(paired, F.get(both, F.lit(1))).otherwise(pick(3)).alias("alt"), F.col("value").alias("detail"), "ord").where("position is not null")

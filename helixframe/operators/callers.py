"""From callers' tables to somatic calls, and the vote between callers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.functions import contig_key, fisher_exact, is_indel, odds_ratio, read_count_string, safe_ratio
from helixframe.operators.relational import KEY, keyword_rows, last_wins, priority_union

COUNTS = ["normal_depth", "normal_supporting", "tumor_depth", "tumor_supporting"]


def with_derived(calls: DataFrame) -> DataFrame:
    """Adds both fractions, the indel flag and the count text."""
    return calls.withColumns({
        "normal_fraction": safe_ratio(F.col("normal_supporting"), F.col("normal_depth")),
        "tumor_fraction": safe_ratio(F.col("tumor_supporting"), F.col("tumor_depth")),
        "is_indel": is_indel(F.col("ref"), F.col("alt")),
        "read_counts": read_count_string(*(F.col(c) for c in ("tumor_supporting", "tumor_depth", "normal_supporting", "normal_depth"))),
    })


def with_fisher(calls: DataFrame, complement: bool = False) -> DataFrame:
    """Adds p and odds ratio of [[normal support, normal depth], [tumour support, tumour depth]].

    Each distinct table is tested once. ``complement`` takes depth without support as the second column.
    """
    columns = ["normal_supporting", "_nd", "tumor_supporting", "_td"]
    calls = calls.withColumns({"_nd": F.col("normal_depth") - (F.col("normal_supporting") if complement else 0), "_td": F.col("tumor_depth") - (F.col("tumor_supporting") if complement else 0)})
    tables = calls.select(*columns).distinct().withColumns({"pvalue": fisher_exact(*columns), "odds_ratio": odds_ratio(*columns)})
    return calls.join(tables, columns, "left").drop("_nd", "_td")


def somatic_from_vcf(rows: DataFrame, min_depth: int = 10, max_p: float = 0.05, to_reference: bool = False) -> DataFrame:
    """Alleles that the tumour's genotype has and the normal's has not; rows as ``sources.genotype_vcf`` gives them."""
    # Behind an explode cells are decoded once a row; else each mention of a field, in filters too, decodes them anew.
    rows = rows.select(*(c for c in rows.columns if c not in ("n", "t")), F.explode(F.array(F.struct("n", "t"))).alias("_cells")).select("*", "_cells.n", "_cells.t").drop("_cells")
    called = rows.where(F.col("n.called") & F.col("t.called") & (F.col("n.depth") >= min_depth) & (F.col("t.depth") >= min_depth))
    alleles = F.concat(F.array("ref"), F.col("alts"))
    somatic = called.withColumn("allele", F.explode(F.array_except("t.genotype", "n.genotype")))
    somatic = somatic if to_reference else somatic.where("allele <> 0")
    named = somatic.withColumn("alt", F.get(alleles, F.col("allele")))
    calls = named.select("contig", "position", "ref", "alt", F.col("n.depth").alias("normal_depth"), F.coalesce(F.col("n.by_allele")[F.col("alt")], F.lit(0)).alias("normal_supporting"), F.col("t.depth").alias("tumor_depth"), F.coalesce(F.col("t.by_allele")[F.col("alt")], F.lit(0)).alias("tumor_supporting"), "ord")
    return with_fisher(last_wins(calls, KEY)).where(F.col("pvalue") <= max_p)


def somatic_from_mutect(rows: DataFrame, min_depth: int = 10) -> DataFrame:
    kept = keyword_rows(rows, "REJECT", judgement="judgement") if "judgement" in rows.columns else rows
    deep = kept.where((F.col("normal_depth") >= min_depth) & (F.col("tumor_depth") >= min_depth))
    return last_wins(deep.select(*KEY, *COUNTS, "ord"), KEY)


def somatic_from_varscan(rows: DataFrame, min_depth: int = 10) -> DataFrame:
    """From the 23-column table; reads1 support the reference, reads2 the variant."""
    calls = rows.select(*KEY, (F.col("normal_reads1") + F.col("normal_reads2")).alias("normal_depth"), F.col("normal_reads2").alias("normal_supporting"), (F.col("tumor_reads1") + F.col("tumor_reads2")).alias("tumor_depth"), F.col("tumor_reads2").alias("tumor_supporting"), "ord")
    return last_wins(calls.where((F.col("normal_depth") >= min_depth) & (F.col("tumor_depth") >= min_depth)), KEY)


def vcf_alternatives(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """A VCF's alternatives that are among the wanted keys."""
    return rows.withColumn("alt", F.explode("alts")).join(wanted.select(*KEY).distinct(), KEY, "left_semi")


def varscan_positions(rows: DataFrame) -> DataFrame:
    """contig, start and end of the reference stretch of each call."""
    return rows.select("contig", F.col("position").alias("start"), (F.col("position") + F.length("ref")).alias("end"))


def combine_snp_indel(snp: DataFrame, indel: DataFrame, indel_first: bool = False) -> DataFrame:
    """SNP rows win on equal keys, or indel rows."""
    return priority_union([indel, snp] if indel_first else [snp, indel], KEY)


def hits(calls: DataFrame) -> DataFrame:
    """How many sources have each key."""
    return calls.groupBy(*KEY).agg(F.count_distinct("source").alias("hits"))


def hit_range(calls: DataFrame, sources: int, min_hits: int | None = None, max_hits: int | None = None) -> tuple[int, int]:
    low, high = sources - 1 if min_hits is None else min_hits, sources if max_hits is None else max_hits
    if not 0 < low <= high <= sources:
        raise ValueError(f"hits from {low} to {high} among {sources} sources")
    return low, high


def consensus(calls: DataFrame, min_hits: int = 2, max_hits: int | None = None, test: bool = True) -> DataFrame:
    """Keys with enough sources: hits, rounded means of the four counts over the sources that have the key, and Fisher's test of them.

    ``calls``: one row a source and key (``last_wins``).
    """
    found = calls.groupBy(*KEY).agg(F.count("source").alias("hits"), *(F.bround(F.avg(c), 0).cast("int").alias(c) for c in COUNTS), F.map_from_entries(F.sort_array(F.collect_list(F.struct("source", F.struct(*COUNTS))))).alias("by_source"))
    kept = found.where(F.col("hits") >= min_hits)
    kept = kept.where(F.col("hits") <= max_hits) if max_hits else kept
    return with_fisher(kept) if test else kept


def record_tables(records: DataFrame) -> dict[str, DataFrame]:
    """Records of ``consensus`` (or rows joined to them) as one table for each content, by the key.

    ``combined`` has hits, counts and p; ``raw`` a row for each source with its own counts; ``rna``, where records have
    RNA evidence, its columns, only of records with some.
    """
    tests = [c for c in ("hits", *COUNTS, "pvalue") if c in records.columns]
    tables = {"combined": records.select(*KEY, *tests), "raw": records.select(*KEY, F.explode("by_source").alias("source", "_c")).select(*KEY, "source", "_c.*")}
    evidence = [c for c in records.columns if c.startswith("rna_")]
    if evidence:
        tables["rna"] = records.where(F.coalesce(*evidence).isNotNull()).select(*KEY, *evidence)
    return tables


def caller_matrix(calls: DataFrame, sources: list[str], min_share: float = 0.0) -> DataFrame:
    """One column a source with its count text, or NA; keys with more than ``min_share`` of all sources."""
    text = read_count_string(*(F.col(c) for c in ("tumor_supporting", "tumor_depth", "normal_supporting", "normal_depth")))
    wide = calls.groupBy(*KEY).pivot("source", sorted(sources)).agg(F.first(text))
    named = sum((F.col(f"`{s}`").isNotNull().cast("int") for s in sources), F.lit(0))
    return wide.withColumn("hits", named).where(F.col("hits") / len(sources) > min_share).na.fill("NA", sources)


def caller_combinations(calls: DataFrame) -> DataFrame:
    """How many keys each exact set of sources shares."""
    sets = calls.groupBy(*KEY).agg(F.array_join(F.sort_array(F.collect_set("source")), "_").alias("sources"))
    return sets.groupBy("sources").agg(F.count("*").alias("n_variants"))


def calls_by(calls: DataFrame, *keys: str) -> DataFrame:
    """How many calls there are by source, contig or other keys."""
    return calls.groupBy(*keys).agg(F.count("*").alias("n"))


def count_sources(calls: DataFrame) -> DataFrame:
    """Distinct sources; each file without one counts as one."""
    return calls.agg(F.count_distinct(F.coalesce("source", "file")).alias("n_sources"))


def karyotype_order(df: DataFrame, contig: str = "contig", position: str = "position") -> DataFrame:
    """By karyotype and position. The key is a column while rows are sorted: a sort works its expressions out anew at every comparison."""
    return df.withColumn("_karyotype", contig_key(F.col(contig))).orderBy("_karyotype", position).drop("_karyotype")


def karyotype_rank(df: DataFrame) -> DataFrame:
    """Adds the sort key of the contig."""
    return df.withColumn("contig_key", contig_key(F.col("contig")))

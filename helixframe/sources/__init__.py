"""Readers: text tables of sequencing tools as DataFrames with fixed schemas. No schema is ever inferred."""

from helixframe.sources.annotations import allele_list, binding_report, bed, maf, merge_intervals, pad_intervals, protein_fasta
from helixframe.sources.calls import genotype_vcf, info_map, multi_caller_calls, mutect, sample_cell, varscan_fixed, varscan_native, vcf
from helixframe.sources.columns import case_collisions, resolve_columns
from helixframe.sources.files import compressed_state, fastq_catalogue, fastq_names, gvcf_folder
from helixframe.sources.pileups import allele_read_counts, contig_rows, extracted_variants, joined_variants, legacy_variants, pileup, pileup_six, positional_counts
from helixframe.sources.reports import hla_report, sam_text

__all__ = [
    "allele_list", "allele_read_counts", "bed", "binding_report", "case_collisions", "compressed_state", "contig_rows", "extracted_variants", "fastq_catalogue", "fastq_names", "genotype_vcf",
    "gvcf_folder", "hla_report", "info_map", "joined_variants", "legacy_variants", "maf", "merge_intervals", "multi_caller_calls", "mutect", "pad_intervals", "pileup",
    "pileup_six", "positional_counts", "protein_fasta", "resolve_columns", "sam_text", "sample_cell", "varscan_fixed", "varscan_native", "vcf",
]

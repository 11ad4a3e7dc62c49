"""Scalar and statistical expressions: Column in, Column out."""

from helixframe.functions.fisher import fisher_exact, odds_ratio
from helixframe.functions.karyotype import contig_key, with_prefix, without_prefix
from helixframe.functions.text import (
    decode_ambiguity,
    base_name,
    hla_format,
    hla_two_fields,
    identifier,
    indel_code,
    indel_text,
    is_indel,
    mutate,
    parse_indel,
    parse_strands,
    protein_changes,
    read_count_string,
    residue_stem,
    rewrite_detail,
    safe_ratio,
    strand_string,
    strip_extension,
)

__all__ = [
    "base_name", "contig_key", "decode_ambiguity", "fisher_exact", "hla_format", "hla_two_fields", "identifier", "indel_code", "indel_text",
    "is_indel", "mutate", "odds_ratio", "parse_indel", "parse_strands", "protein_changes", "read_count_string", "residue_stem",
    "rewrite_detail", "safe_ratio", "strand_string", "strip_extension", "with_prefix", "without_prefix",
]

"""Scalar functions on alleles, changes, names and report fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Two-base ambiguity codes and the bases they stand for.
AMBIGUITY = {"R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC"}


def indel_text(kind: Column, size: Column, seq: Column) -> Column:
    """+2AC or -1T."""
    return F.concat(kind, size.cast("string"), seq)


def parse_indel(allele: Column) -> Column:
    """+2AC as struct(kind '+', size 2, seq 'AC'); null for a plain base."""
    pattern = r"^([+-])(\d+)(.+)$"
    parsed = F.struct(F.regexp_extract(allele, pattern, 1).alias("kind"), F.regexp_extract(allele, pattern, 2).try_cast("int").alias("size"), F.regexp_extract(allele, pattern, 3).alias("seq"))
    return F.when(allele.rlike(pattern), parsed)


def indel_code(allele: Column) -> Column:
    """I-2 for +2AC, D-1 for -1T; a plain base stays."""
    p = parse_indel(allele)
    return F.when(p.isNull(), allele).otherwise(F.concat(F.when(p["kind"] == "+", "I-").otherwise("D-"), p["size"].cast("string")))


def is_indel(ref: Column, alt: Column) -> Column:
    return (F.length(ref) > 1) | (F.length(alt) > 1) | alt.contains("*")


def strand_string(plus: Column, minus: Column) -> Column:
    return F.concat(F.lit("+"), plus.cast("string"), F.lit("-"), minus.cast("string"))


def parse_strands(text: Column) -> Column:
    """+3-2 as struct(plus 3, minus 2)."""
    return F.struct(F.regexp_extract(text, r"\+(\d+)-", 1).try_cast("int").alias("plus"), F.regexp_extract(text, r"-(\d+)$", 1).try_cast("int").alias("minus"))


def safe_ratio(x: Column, y: Column, otherwise: float | None = 0.0) -> Column:
    return F.coalesce(F.try_divide(x.cast("double"), y.cast("double")), F.lit(otherwise))


def read_count_string(tumor_support: Column, tumor_depth: Column, normal_support: Column, normal_depth: Column) -> Column:
    return F.concat_ws(",", *(c.cast("string") for c in (tumor_support, tumor_depth, normal_support, normal_depth)))


def protein_changes(change: Column) -> Column:
    """p.V600E or p.12_13GG>VV as array<struct<ref, pos, alt>> of residues that change; an empty array if none does."""
    bare = F.regexp_replace(change, r"^p\.", "")
    single, multi = r"^([A-Z*])(\d+)([A-Z*])$", r"^(\d+)_(\d+)([A-Z*]+)>([A-Z*]+)$"
    one = F.array(F.struct(F.regexp_extract(bare, single, 1).alias("ref"), F.regexp_extract(bare, single, 2).try_cast("int").alias("pos"), F.regexp_extract(bare, single, 3).alias("alt")))
    start = F.regexp_extract(bare, multi, 1).try_cast("int")
    pairs = F.arrays_zip(F.split(F.regexp_extract(bare, multi, 3), "").alias("ref"), F.split(F.regexp_extract(bare, multi, 4), "").alias("alt"))
    many = F.transform(pairs, lambda p, k: F.struct(p["ref"].alias("ref"), (start + k).alias("pos"), p["alt"].alias("alt")))
    found = F.when(bare.rlike(single), one).when(bare.rlike(multi), many).otherwise(F.array().cast("array<struct<ref:string,pos:int,alt:string>>"))
    return F.filter(found, lambda c: (c["ref"] != c["alt"]) & (c["ref"] != "") & (c["alt"] != ""))


def decode_ambiguity(ref: Column, code: Column) -> Column:
    """The base that an ambiguity code adds to ``ref``; other codes stay."""
    out = None
    for name, (one, two) in ((n, tuple(b)) for n, b in AMBIGUITY.items()):
        for base, other in ((one, two), (two, one)):
            test = (F.upper(code) == name) & (F.upper(ref) == base)
            out = F.when(test, other) if out is None else out.when(test, other)
    return out.otherwise(code)


def mutate(sequence: Column, changes: Column) -> Column:
    """The sequence with each change's residue in place (positions from 1)."""
    return F.aggregate(changes, sequence, lambda s, c: F.concat(F.substring(s, F.lit(1), c["pos"] - 1), c["alt"], F.substring(s, c["pos"] + 1, F.length(s))))


def hla_format(allele: Column) -> Column:
    """A*02:01 as HLA-A0201; an error for anything that is not a class I allele of two fields."""
    bare = F.regexp_replace(F.regexp_replace(F.upper(allele), "HLA", ""), r"\W", "")
    return F.when(bare.rlike(r"^[ABC]\d{4,5}$"), F.concat(F.lit("HLA-"), bare)).otherwise(F.raise_error(F.concat(F.lit("not an HLA class I allele: "), allele)))


def hla_two_fields(allele: Column) -> Column:
    return F.substring_index(allele, ":", 2)


def residue_stem(change: Column) -> Column:
    """A protein change without the letters at its end."""
    return F.regexp_replace(change, r"[A-Z*]+$", "")


def identifier(name: Column) -> Column:
    """Upper case, without the version."""
    return F.upper(F.substring_index(name, ".", 1))


def rewrite_detail(detail: Column, ref_count: Column, alt_count: Column, ref: Column, alt: Column) -> Column:
    """A detail line with its (n,m) counts and its :X/Y: alleles replaced."""
    counts = F.concat(F.lit("("), ref_count.cast("string"), F.lit(","), alt_count.cast("string"), F.lit(")"))
    return F.regexp_replace(F.regexp_replace(detail, F.lit(r"\(\d+,\d+\)"), counts), F.lit(r":[ACGTN*-]+/[ACGTN*-]+:"), F.concat(F.lit(":"), ref, F.lit("/"), alt, F.lit(":")))


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def strip_extension(path: Column) -> Column:
    """Without the last extension, or the last two if the file is compressed."""
    return F.regexp_replace(path, r"(\.[^./]*)?\.(gz|bz|bz2|zip)$|\.[^./]*$", "")

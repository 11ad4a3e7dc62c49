"""Contig names: order of the karyotype and the chr prefix."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def without_prefix(contig: Column) -> Column:
    return F.regexp_replace(contig, "(?i)^chr", "")


def with_prefix(contig: Column) -> Column:
    return F.when(contig.startswith("chr"), contig).otherwise(F.concat(F.lit("chr"), contig))


def contig_key(contig: Column, highest: int = 22) -> Column:
    """A text that sorts 1..highest, X, Y, M/MT, then all other contigs by their raw name."""
    bare = F.upper(without_prefix(contig))
    number = bare.try_cast("int")
    rank = F.when(number.between(1, highest), number)
    for k, names in enumerate((("X",), ("Y",), ("M", "MT")), start=1):
        rank = rank.when(bare.isin(*names), F.lit(highest + k))
    return F.coalesce(F.concat(F.lit("0"), F.lpad(rank.cast("string"), 3, "0")), F.concat(F.lit("1"), contig))

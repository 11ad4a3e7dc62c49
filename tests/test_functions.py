from math import comb, inf, isnan

import pytest
from pyspark.sql import functions as F

from helixframe import functions as fn


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def exact(a, b, c, d):
    """Fisher's test by whole numbers."""
    total, col, row = a + b + c + d, a + c, a + b
    weight = {k: comb(row, k) * comb(total - row, col - k) for k in range(max(0, col - (c + d)), min(row, col) + 1)}
    return sum(w for w in weight.values() if w * 10**9 <= weight[a] * (10**9 + 1)) / sum(weight.values())


@pytest.mark.parametrize("table", [(0, 20, 10, 25), (5, 50, 10, 25), (30, 50, 10, 40), (0, 0, 3, 4), (1, 0, 0, 1), (200, 3000, 150, 900)])
def test_fisher(spark, table):
    assert one(spark, fn.fisher_exact(*map(F.lit, table))) == pytest.approx(exact(*table), abs=1e-9)
    a, b, c, d = table
    assert one(spark, fn.fisher_exact(*map(F.lit, (c, d, a, b)))) == pytest.approx(exact(*table), abs=1e-9)


def test_fisher_worked_cases(spark):
    assert round(one(spark, fn.fisher_exact(*map(F.lit, (0, 20, 10, 25)))), 6) == 0.009046
    assert round(one(spark, fn.fisher_exact(*map(F.lit, (5, 50, 10, 25)))), 6) == 0.021168
    assert round(one(spark, fn.fisher_exact(*map(F.lit, (30, 50, 10, 40)))), 6) == 0.050169
    assert one(spark, fn.fisher_exact(F.lit(None), F.lit(1), F.lit(1), F.lit(1))) is None


def test_odds_ratio(spark):
    assert one(spark, fn.odds_ratio(*map(F.lit, (2, 4, 3, 9)))) == 1.5
    assert one(spark, fn.odds_ratio(*map(F.lit, (2, 0, 3, 9)))) == inf
    assert isnan(one(spark, fn.odds_ratio(*map(F.lit, (0, 4, 0, 9)))))


def test_karyotype(spark):
    names = ["chrUn", "chrM", "chrX", "chr10", "chr2", "chrMT", "Y", "1"]
    rows = spark.createDataFrame([(n,) for n in names], "c string").orderBy(fn.contig_key(F.col("c")), "c").collect()
    assert [r.c for r in rows] == ["1", "chr2", "chr10", "chrX", "Y", "chrM", "chrMT", "chrUn"]


def test_indels(spark):
    assert one(spark, fn.indel_code(F.lit("+2AC"))) == "I-2"
    assert one(spark, fn.indel_code(F.lit("-1T"))) == "D-1"
    assert one(spark, fn.indel_code(F.lit("A"))) == "A"
    assert tuple(one(spark, fn.parse_strands(F.lit("+3-2")))) == (3, 2)


@pytest.mark.parametrize("text, want", [("p.V600E", [("V", 600, "E")]), ("p.12_13GG>VV", [("G", 12, "V"), ("G", 13, "V")]), ("p.12_13GA>VA", [("G", 12, "V")]), ("p.R10*", [("R", 10, "*")]), ("p.L5L", []), ("", [])])
def test_protein_changes(spark, text, want):
    assert [tuple(r) for r in one(spark, fn.protein_changes(F.lit(text)))] == want


def test_ambiguity(spark):
    assert one(spark, fn.decode_ambiguity(F.lit("A"), F.lit("R"))) == "G"
    assert one(spark, fn.decode_ambiguity(F.lit("C"), F.lit("R"))) == "R"
    assert one(spark, fn.decode_ambiguity(F.lit("G"), F.lit("R"))) == "A"


def test_hla(spark):
    assert one(spark, fn.hla_format(F.lit("A*02:01"))) == "HLA-A0201"
    with pytest.raises(Exception, match="class I"):
        one(spark, fn.hla_format(F.lit("DRB1*01")))


def test_mutate_and_names(spark):
    changes = F.array(F.struct(F.lit("B").alias("ref"), F.lit(2).alias("pos"), F.lit("X").alias("alt")))
    assert one(spark, fn.mutate(F.lit("ABC"), changes)) == "AXC"
    assert one(spark, fn.strip_extension(F.lit("/a/b.fastq.gz"))) == "/a/b"
    assert one(spark, fn.identifier(F.lit("enst01.3"))) == "ENST01"
    assert one(spark, fn.residue_stem(F.lit("p.V600E"))) == "p.V600"
    assert one(spark, fn.rewrite_detail(F.lit("x (1,2) :A/T: y"), F.lit(3), F.lit(4), F.lit("AC"), F.lit("TG"))) == "x (3,4) :AC/TG: y"

"""What keeps the work of queries in step with their input, told from plans."""

import re

import pytest

from helixframe.plans import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["annotation_input", "tumor_normal_compare"])
def test_sort_keys_are_columns(spark, name):
    """A sort works an expression out anew at every comparison."""
    keys = re.findall(r"Sort \[(.*?)\], true", plan(QUERIES[name](spark, SF)))
    assert keys and not any("(" in k for k in keys), keys


def test_cigars_are_read_once(spark):
    from helixframe.operators import alignments

    reads = spark.createDataFrame([("c1", 5, "2M1D2M", "ACGT", "IIII", 0, 60)], "contig string, pos long, cigar string, seq string, qual string, flag int, mapq int")
    bases = alignments.read_bases(reads)
    assert plan(bases).count("regexp_extract_all") == 2  # letters and numbers, in one place
    assert sorted(map(tuple, bases.select("position", "base").collect())) == [(5, "A"), (6, "C"), (7, "*"), (8, "G"), (9, "T")]


def test_pileup_pieces_are_read_once(spark):
    from pyspark.sql import functions as F

    from helixframe.operators import pileup

    lines = spark.createDataFrame([(".+2ACg,-1t^I.$*", "A")], "bases string, ref string").select(pileup.alleles_of(F.col("bases"), F.col("ref")).alias("a"))
    assert plan(lines).count("regexp_extract(") == 2  # the number, and the letters after it
    assert [tuple(a) for a in lines.first()["a"]] == [("+2AC", True), ("G", False), ("-1T", False), ("A", True)]


@pytest.mark.parametrize("name", ["epitope_report", "neoepitopes", "protein_lookup", "kmer_peptides", "rejected_changes"])
def test_sequences_are_cleaned_once(spark, name):
    """A filter on a column is a filter on its expression: each mention cleaned the text of every document anew."""
    text = plan(QUERIES[name](spark, SF))
    assert 0 < text.count("regexp_replace(text#") <= len(re.findall(r"Relation \[[^\]]*\btext#", text))


def test_lengths_are_taken_before_the_join(spark):
    """A gene's proteins meet all its orders: what a row needs of a sequence is worked out once a protein, and no sequence is shuffled."""
    assert re.search(r"length\(seq#\d+\) AS residues", plan(QUERIES["protein_lookup"](spark, SF)).split("Join Inner")[1])


def test_both_sides_of_targets_take_one_pass(spark):
    text = plan(QUERIES["hla_reads"](spark, SF))
    assert "Sort [" not in text and text.count("Relation [l_orderkey") <= 2 + text.count("scalar-subquery")
    assert "Union" not in text


def test_marked_targets_are_both_results_of_the_job(spark):
    from helixframe.operators import alignments
    from helixframe.plans import jobs

    reads = spark.createDataFrame([("a", "c1", 1, 5), ("b", "c1", 9, 12), ("c", "c2", 1, 5), ("d", "c1", None, 5), ("a", "c1", 1, 5)], "name string, contig string, start long, end long")
    intervals = spark.createDataFrame([("c1", 4, 8), ("c1", 2, 3)], "contig string, start long, end long")
    inside, outside = jobs.hla_reads(reads, intervals)
    found = sorted((r.name, r.inside) for r in alignments.marked_targets(reads, intervals).collect())
    assert found == [("a", True), ("a", True), ("b", False), ("c", False), ("d", False)]
    assert found == sorted([(r.name, True) for r in inside.collect()] + [(r.name, False) for r in outside.collect()])


def test_cells_are_decoded_once(spark):
    """Two cells a row, two fields each; a scan for the calls and one for their distinct tables."""
    text = plan(QUERIES["somatic_vcf_filter"](spark, SF))
    assert text.count("split(") <= 4 * text.count("Relation [l_orderkey")


def test_metrics_shuffle_no_base(spark):
    """Positions and reference come to the reads by stretch: what is exchanged is reads, stretches and counts, and a base's quality is in none of them."""
    from helixframe.operators import alignments

    rows = [("c1", 5, "2M1D2M", "ACGT", "I5?I", 0, 60), ("c1", 5, "2M1D2M", "ACGT", "I5?I", 0, 60), ("c1", 1030, "4M", "TTTT", "IIII", 16, 20), ("c2", 1, "2M", "AC", "II", 0, 9), ("c1", None, "2M", "AC", "II", 0, 9)]
    reads = spark.createDataFrame(rows, "contig string, pos long, cigar string, seq string, qual string, flag int, mapq int")
    positions = spark.createDataFrame([("c1", 5, "a"), ("c1", 6, "G"), ("c1", 6, "T"), ("c1", 7, "C"), ("c1", 1031, None), ("c1", 1033, "A"), ("c1", 1033, "A")], "contig string, position long, ref string")
    found = alignments.allele_metrics(reads, positions)
    assert "read_id" not in plan(found) and not re.search(r"Join .*position", plan(found))
    got = {(r.position, r.allele): (r["count"], r.mmqs) for r in found.collect()}
    assert got == {(5, "A"): (2, 20), (6, "C"): (2, 20), (7, "*"): (2, 20), (1031, "T"): (1, 40), (1033, "T"): (1, 40)}
    apart = alignments.allele_metrics(reads, positions.select("contig", "position"), reference=positions)
    assert {(r.position, r.allele): (r["count"], r.mmqs) for r in apart.collect()} == got
    none = alignments.allele_metrics(reads, positions.select("contig", "position"))
    assert {(r.position, r.allele): (r["count"], r.mmqs) for r in none.collect()} == {k: (n, None) for k, (n, _) in got.items()}


def test_cigars_are_taken_apart_before_candidates_meet_reads(spark):
    text = plan(QUERIES["mnv_support"](spark, SF))
    pairs = text.split("Join Inner")[0]
    assert "regexp_extract_all" not in pairs and "regexp_extract_all" in text

import random

import pytest
from pyspark.sql import functions as F

from helixframe.operators import alignments, callers, catalog, compare, epitope, fpfilter, pileup, protein, relational, rna, tandem
from helixframe.plans import jobs

PILEUP = "contig string, position bigint, ref string, depth int, bases string, quals string"


def line(spark, bases, depth, ref="A"):
    return spark.createDataFrame([("chr1", 100, ref, depth, bases, "I" * depth)], PILEUP)


def test_allele_counts_worked_case(spark):
    rows = pileup.allele_counts(line(spark, "^I.$,.+2AC,-1tGg*.", 8)).collect()
    assert {(r.allele, r["count"]) for r in rows} == {("A", 3), ("+2AC", 1), ("-1T", 1), ("G", 2)}
    assert {r.coverage for r in rows} == {7}


def test_indel_length_bounds_letters(spark):
    rows = pileup.allele_counts(line(spark, ".+2ACG+1T.", 3)).collect()
    assert {(r.allele, r["count"]) for r in rows} == {("+2AC", 1), ("+1T", 1), ("A", 1)}


def test_extraction_and_strands(spark):
    rows = {r.alt: r for r in pileup.extract_variants(line(spark, "^I.$,.+2AC,-1tGg*.", 8)).collect()}
    assert {(a, r.mutCount, r.coverage, r.mutPercent, r.type, r.strand) for a, r in rows.items()} == {("+2AC", 1, 7, 0.1429, "I", "+1-0"), ("-1T", 1, 7, 0.1429, "I", "+0-1"), ("G", 2, 7, 0.2857, "S", "+1-1")}
    assert [r.alt for r in pileup.extract_variants(line(spark, "^I.$,.+2AC,-1tGg*.", 8), both_strands=True).collect()] == ["G"]


def test_counts_add_up(spark):
    rng = random.Random(4)
    rows = []
    for k in range(200):
        tokens = [rng.choice(["^].", ".", ",", "A$", "g", "t", ".+3ACG", ",-2tt", "*", "C-12ACGTACGTACGT", "^+T"]) for _ in range(rng.randint(1, 30))]
        rows.append(("c", k, "A", len(tokens), "".join(tokens), "I" * len(tokens)))
    df = spark.createDataFrame(rows, PILEUP)
    total = pileup.allele_counts(df).groupBy("position", "coverage").agg(F.sum("count").alias("n"))
    assert total.where("n <> coverage").count() == 0


def test_targets(spark):
    loci = spark.createDataFrame([("chr1", 100)], "contig string, position bigint")
    covered = pileup.extract_variants(line(spark, "..,,", 4), 5, targets=loci).first()
    assert (covered.alt, covered.type, covered.strand, covered.coverage) == ("None", "N", "+2-2", 4)
    bare = pileup.extract_variants(spark.createDataFrame([("chr1", 100, "A", 0, None, None)], PILEUP), targets=loci).first()
    assert (bare.alt, bare.type, bare.strand) == ("None", "U", "+0-0")
    with pytest.raises(ValueError):
        pileup.extract_variants(line(spark, "..", 2), min_fraction=1.0)


def test_compare(spark):
    t = pileup.extract_variants(line(spark, "^I.$,.+2AC,-1tGg*.", 8))
    n = pileup.extract_variants(line(spark, "." * 12, 12), targets=pileup.target_loci(t))
    rows = compare.compare_tumor_normal(t, n).collect()
    assert len(rows) == 3 and {(r.normalVarSupport, r.normalCoverage) for r in rows} == {(0, 12)}
    alone = compare.compare_tumor_normal(t, n.where("false")).collect()
    assert {(r.normalCoverage, r.normal_ref, r.normal_alt, r.normal_type) for r in alone} == {(0, "N", "Unread", "U")}
    assert len(alone[0]) == 31


def test_compare_many(spark):
    both = line(spark, "..GG", 4).withColumn("sample", F.explode(F.array(F.lit("a"), F.lit("b"))))
    assert {r["sample"] for r in jobs.compare_many(both, line(spark, "....", 4)).collect()} == {"a", "b"}


CALL = "contig string, position bigint, ref string, alt string, normal_depth int, normal_supporting int, tumor_depth int, tumor_supporting int"


def test_fusion(spark):
    df = spark.createDataFrame([("1", p, "A", "C", 20, 0, d, d // 2) for p, d in ((10, 30), (11, 40), (12, 30), (14, 30))], CALL)
    rows = {r.position: r for r in tandem.fuse(df).collect()}
    assert (rows[10].ref, rows[10].alt, rows[10].fused, rows[14].fused) == ("AAA", "CCC", True, False)
    pair = tandem.fuse(df.where("position < 12")).first()
    assert pair.tumor_depth == 35 and tandem.fuse(df.where("position < 12"), compat=True).first().tumor_depth == 70
    assert sorted(len(r.ref) for r in tandem.fuse(df, max_length=2).collect()) == [1, 1, 2]
    assert sorted(len(r.ref) for r in tandem.fuse(df, compat=True).collect()) == [1, 1, 2]


def test_runs_cross_stretches(spark):
    df = spark.createDataFrame([("1", p, "A", "C", 20, 0, 30, 10) for p in range(5, 27)], CALL)
    assert {(r.run_start, r.run_length) for r in tandem.runs(df, stride=100).collect()} == {(5, 22)}
    assert {(r.run_start, r.run_length) for r in tandem.runs(df.where("position < 16"), stride=8).collect()} == {(5, 11)}


def test_rna_levels(spark):
    rows = [(0, 0), (50, 0), (50, 2), (9, 9), (50, 20), (50, 30)]
    df = spark.createDataFrame([(str(k), k, "A", "C", 20, 0, 40 if k == 5 else 25, 10, d, s) for k, (d, s) in enumerate(rows)], CALL + ", rna_depth int, rna_support int")
    assert [r.rna_score for r in rna.score(df).orderBy("position").collect()] == [0, 1, 2, 2, 4, 4]


def test_false_positive_order(spark):
    fields = "contig string, position bigint, allele string, count double, plus double, minus double, readpos double, mmqs double, mapq double, readlen double, dist3 double"
    metrics = spark.createDataFrame([("1", 5, "A", 20.0, 10.0, 10.0, 0.5, 10.0, 60.0, 100.0, 0.5), ("1", 5, "G", 2.0, 1.0, 1.0, 0.05, 10.0, 60.0, 100.0, 0.5), ("1", 6, "A", 9.0, 4.0, 5.0, 0.5, 1.0, 60.0, 100.0, 0.5)], fields)
    variants = spark.createDataFrame([("1", 5, "A", "R"), ("1", 6, "A", "G"), ("1", 7, "A", "G")], "contig string, position bigint, ref string, alt string")
    found = {r.position: r.reason for r in fpfilter.classify(fpfilter.with_metrics(variants, metrics)).collect()}
    assert found == {5: "read_position", 6: "no_variant_reads", 7: "no_readcounts"}


def test_peptides(spark):
    df = spark.createDataFrame([("ABCDEFGHIJKL", [("L", 12, "X")])], "sequence string, changes array<struct<ref:string,pos:int,alt:string>>")
    rows = protein.peptides(df, (8,)).collect()
    assert [(r.start, r.wt_peptide, r.mut_peptide) for r in rows] == [(4, "EFGHIJKL", "EFGHIJKX")]
    assert protein.peptides(df, (8,), compat=True).count() == 0
    assert protein.check_reference(df.withColumn("sequence", F.lit("AAAAAAAAAAAA"))).count() == 0
    with pytest.raises(Exception, match="residues differ"):
        protein.check_reference(df.withColumn("sequence", F.lit("AAAAAAAAAAAA")), "fail").collect()


def test_top_two(spark):
    alleles = ["A*02:01:01", "A*02:05", "A*24:02", "A*02:01"]
    df = spark.createDataFrame([(1, "A", k, a) for k, a in enumerate(alleles)], "sample int, molecule string, ord int, allele string")
    assert {r.allele for r in epitope.top_two_alleles(df).collect()} == {"A*02:01", "A*24:02"}


def test_interval_join(spark):
    rng = random.Random(1)
    make = lambda n: [("c", s, s + rng.randint(0, 60)) for s in (rng.randint(0, 500) for _ in range(n))]
    one, two = make(80), make(40)
    a, b = (spark.createDataFrame(x, "contig string, start bigint, end bigint") for x in (one, two))
    want = sorted((x, y) for x in one for y in two if x[1] <= y[2] and y[1] <= x[2])
    got = sorted(((r.contig, r.start, r.end), (r.r_contig, r.r_start, r.r_end)) for r in relational.interval_join(a, b, bin_size=32).collect())
    assert got == want
    hit = {x for x, _ in want}
    assert relational.interval_join(a, b, 32, "semi").count() == sum(x in hit for x in one)
    assert relational.interval_join(a, b, 32, "anti").count() == sum(x not in hit for x in one)


def test_haplotypes_and_reads(spark):
    cut = lambda *row: spark.range(1).select(alignments.haplotype(*map(F.lit, row))).first()[0]
    assert cut(10, "4M1D3M", "ACGTACG", 12, 4) == "GT*A"
    assert cut(10, "4M2I3M", "ACGTTTACG", 12, 4) == "GTttAC"
    assert cut(10, "3M", "ACG", 12, 4) == ""
    reads = spark.createDataFrame([("r1", 0, "c", 10, 60, "4M", "ACGT", "IIII"), ("r2", 16, "c", 10, 255, "2M3N2M", "AGGT", "IIII")], "name string, flag int, contig string, pos bigint, mapq int, cigar string, seq string, qual string")
    reference = spark.createDataFrame([("c", 10 + k, b) for k, b in enumerate("ACGTACGT")], "contig string, position bigint, ref string")
    rows = {r.position: r for r in alignments.build_pileup(reads, reference, marks=False, base_alignment_quality=False).collect()}
    assert sorted(rows[10].bases) == [",", "."] and sorted(rows[11].bases) == [".", "g"]
    blocks = alignments.split_spliced(reads).where("name = 'r2'").orderBy("pos").collect()
    assert [(b.pos, b.cigar, b.seq, b.mapq) for b in blocks] == [(10, "2M", "AG", 60), (15, "2M", "GT", 60)]
    metrics = {(r.position, r.allele): r["count"] for r in alignments.allele_metrics(reads, reference.limit(2)).collect()}
    assert metrics[(10, "A")] == 2.0
    kept = lambda q: tuple(alignments.trim_cuts(spark.createDataFrame([(q,)], "q string"), "q", "c").first().c)
    assert kept("!!!!!" + "I" * 40 + "!!!!!!!!!!") == (5, 45)
    assert kept("!" * 50) == (0, 0) and kept("") == (0, 0)


def test_trim_routes(spark):
    good, bad = "I" * 30, "!" * 30
    df = spark.createDataFrame([("a", "A" * 30, good, "C" * 30, good), ("b", "A" * 30, good, "C" * 30, bad), ("c", "A" * 30, bad, "C" * 30, bad)], "name string, seq1 string, qual1 string, seq2 string, qual2 string")
    assert {r.name: r.route for r in alignments.trim_pairs(df).collect()} == {"a": "pe", "b": "single1", "c": "dropped"}


def test_duplicates_of_one_name(spark):
    df = spark.createDataFrame([("r", "c", 1, False, 9)] * 3 + [("s", "c", 1, False, 5)], "name string, contig string, five_prime int, reverse boolean, qual_sum int")
    assert alignments.mark_duplicates(df).where("not duplicate").count() == 1


def test_catalogue(spark):
    df = spark.createDataFrame([("x", ["ab", "cd", "tumor"])], "path string, tags array<string>")
    assert catalog.find(df, "b").count() == 1 and catalog.find(df, ["AB", "cd"]).count() == 1
    assert catalog.find(df, {3: "x"}).count() == 0 and catalog.find(df, 4).count() == 0
    files = spark.createDataFrame([("a", 1, 1, "p"), ("a", 1, 1, "q")], "sampleName string, lane int, pairedEnd int, path string")
    with pytest.raises(Exception, match="several files"):
        catalog.sample_lanes(files).collect()


def test_votes(spark):
    assert callers.hit_range(None, 3) == (2, 3)
    with pytest.raises(ValueError):
        callers.hit_range(None, 3, 2, 4)
    df = spark.createDataFrame([("a", "1", 5, "A", "C", 2, 0, 9, 1), ("b", "1", 5, "A", "C", 3, 0, 9, 1)], "source string, " + CALL)
    assert callers.consensus(df, test=False).first().normal_depth == 2
    assert callers.caller_combinations(df).first().sources == "a_b"


def test_order_conflicts(spark):
    a = spark.createDataFrame([("1", 0), ("2", 1), ("3", 2)], "contig string, ord int")
    b = spark.createDataFrame([("1", 0), ("3", 1), ("2", 2)], "contig string, ord int")
    assert relational.contig_order_conflicts(a, a).count() == 0 and relational.contig_order_conflicts(a, b).count() == 1
    assert relational.only_in_one(a, b.where("contig <> '2'")).first().contig == "2"


def test_fused_rows_carry_rna(spark):
    df = spark.createDataFrame([("1", p, "A", "C", 20, 0, 40, 20, 4, s, 30) for p, s in ((10, 6), (11, 9), (20, 3))], CALL + ", rna_score int, rna_support int, rna_depth int")
    rows = {r.position: r for r in rna.tested(tandem.fuse(df)).collect()}
    assert (rows[10].alt, rows[10].rna_support, rows[10].rna_depth, rows[10].rna_score) == ("CC", 8, 30, 4) and rows[20].rna_support == 3
    assert 0 < rows[10].rna_pvalue <= 1


def test_full_run(spark):
    calls = spark.createDataFrame([("1", p, "A", "C", 20, 0, 40, 20) for p in (10, 11)], CALL)
    pileups = spark.createDataFrame([("1", p, "A", 20, "." * 12 + "C" * 8, "I" * 20) for p in (10, 11)], PILEUP)
    notes = spark.createDataFrame([("1", 10, "AA", "CC", "G", "Missense", "p.V6E", "ENST1.1")], "contig string, position bigint, ref string, alt string, gene string, variant_class string, protein_change string, transcript string")
    proteins = spark.createDataFrame([("ENSP1", "ENST1", "ENSG1", "MKLVVVKLMNPQ")], "protein string, transcript string, gene string, sequence string")
    predictions = spark.createDataFrame([(p, "A*02:01", a, 0) for p, a in (("MKLVVVKL", 500.0), ("MKLVVEKL", 50.0))], "peptide string, hla string, affinity double, ord int")
    rows = jobs.full_run({c: (calls, calls.where("false")) for c in "ab"}, pileups, notes, proteins, predictions).collect()
    assert [(r.position, r.alt, r.mut_peptide, r.affinity_ratio, r.rna_support, r.rna_depth) for r in rows] == [(10, "CC", "MKLVVEKL", 0.1, 8, 20)]


def test_metrics_feed_the_cascade(spark):
    reads = spark.createDataFrame([(f"r{k}", 16 * (k % 2), "c", 10, 60, "8M", "ACGTACGA" if k < 6 else "AGGTACGT", "I" * 8) for k in range(12)], "name string, flag int, contig string, pos bigint, mapq int, cigar string, seq string, qual string")
    reference = spark.createDataFrame([("c", 10 + k, b) for k, b in enumerate("ACGTACGT")], "contig string, position bigint, ref string")
    metrics = alignments.allele_metrics(reads, reference)
    found = {(r.position, r.allele): r.mmqs for r in metrics.collect()}
    assert found[(11, "G")] == 40.0 and found[(17, "T")] == 40.0 and found[(17, "A")] == 40.0
    variants = spark.createDataFrame([("c", 11, "C", "G")], "contig string, position bigint, ref string, alt string")
    assert fpfilter.classify(fpfilter.with_metrics(variants, metrics)).first().reason in ("PASS", "read_position", "dist3")


def test_hla_calls_of_one_file_each(spark):
    rows = spark.createDataFrame([("s",)], "sample string")
    calls = spark.createDataFrame([("s", "A", "A*02:01", "x"), ("s", "B", "B*07:02", "y")], "sample string, molecule string, allele string, file string")
    assert epitope.attach_hla(rows, calls).first().hla == {"A": ["A*02:01"], "B": ["B*07:02"]}
    for other in (("s", "a", "A*03:01", "z"), ("s", "C", "C*03:01", "y")):
        with pytest.raises(Exception, match="several"):
            epitope.attach_hla(rows, calls.unionByName(spark.createDataFrame([other], calls.schema))).collect()


def test_spliced_blocks_keep_clips(spark):
    reads = spark.createDataFrame([("r", 0, "c", 10, 60, "2S3M4N1D2M1I2M", "ttACGACTGG", "0123456789")], "name string, flag int, contig string, pos bigint, mapq int, cigar string, seq string, qual string")
    assert [(b.pos, b.cigar, b.seq, b.qual) for b in alignments.split_spliced(reads).orderBy("pos").collect()] == [(10, "2S3M", "ttACG", "01234"), (17, "1D2M1I2M", "ACTGG", "56789")]


def test_text_order(spark):
    df = spark.createDataFrame([("chr2", 5, "b"), ("chr10", 30, "a"), ("chr10", 4, "a"), (None, 1, "a")], "contig string, position bigint, `n.x` string")
    assert [(r.contig, r.position) for r in relational.text_order(df, ["n.x", 2]).collect()] == [(None, 1), ("chr10", 30), ("chr10", 4), ("chr2", 5)]
    # Joined, nulls take no place, and the separator counts.
    assert [r.position for r in relational.text_order(df, ["contig", "position"], joined=True).collect()] == [1, 30, 4, 5]


def test_last_wins_near_sorts_rows_once(spark):
    """With ``near`` the same rows, without a sort before the shuffle, and votes by these keys need no shuffle of their own."""
    rows = [("v" if k % 2 else "m", "1", k % 7, "A", "C", 20 + k % 3, k % 4, 30, k % 5, k // 3) for k in range(200)]
    df = spark.createDataFrame(rows, "source string, contig string, position bigint, ref string, alt string, normal_depth int, normal_supporting int, tumor_depth int, tumor_supporting int, ord bigint")
    keys = ["source", *relational.KEY]
    plain, near = relational.last_wins(df, keys), relational.last_wins(df, keys, near=relational.KEY)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, near.collect()))
    votes = callers.consensus(near, test=False)
    assert votes.drop("by_source")._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted(r.hits for r in votes.collect()) == [2] * 7


def test_rna_evidence_reads_lines_once(spark):
    pile = spark.createDataFrame([("1", 5, "A", 5, "..CCc", "IIIII"), ("1", 6, "A", 2, "**", "II"), ("1", 7, "A", 0, None, None), ("1", 8, "G", 3, ".+2ACTt", "III")], PILEUP)
    wanted = spark.createDataFrame([("1", p, "A", a) for p, a in ((5, "C"), (5, "G"), (6, "C"), (7, "C"), (8, "T"), (9, "C"), (5, "CC"))], "contig string, position bigint, ref string, alt string")
    found = rna.pileup_evidence(wanted, pile)
    assert {(r.position, r.alt): (r.rna_depth, r.rna_support) for r in found.collect()} == {(5, "C"): (5, 3), (5, "G"): (5, 0), (6, "C"): (0, 0), (7, "C"): (None, 0), (8, "T"): (3, 2), (9, "C"): (None, 0)}
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_lines_without_indels_are_left_before_alleles(spark):
    pile = spark.createDataFrame([("1", 5, "A", 3, "..C", "III"), ("1", 6, "A", 2, ".+2AC,", "II"), ("1", 7, "A", 1, "^+.", "I"), ("1", 8, "A", 1, ",-1t", "I")], PILEUP)
    assert sorted(r.position for r in pileup.indel_lines(pile).collect()) == [6, 8]
    every, some = (pileup.top_indel(pileup.allele_counts(p)).select("position", "code", "count").collect() for p in (pile, pileup.indel_lines(pile)))
    assert sorted(map(tuple, every)) == sorted(map(tuple, some)) and len(some) == 2

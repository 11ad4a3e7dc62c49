import gzip
import os

import pytest
from pyspark.sql import functions as F

from helixframe import sources, streaming
from helixframe.operators import callers, protein
from helixframe.sources import columns, sinks


def put(folder, name, text, zipped=False):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress(text.encode()) if zipped else text.encode("latin-1"))
    return str(path)


def test_pileups(spark, tmp_path):
    text = '# c\nchr1\t5\ta\t3\t.,G\t"I\\\n\nchr1\t6\tC\t0\nbad\tline\n'
    rows = sources.pileup(spark, put(tmp_path, "p.txt", text)).orderBy("position").collect()
    assert [(r.position, r.ref, r.depth, r.bases, r.quals) for r in rows] == [(5, "A", 3, ".,G", '"I\\'), (6, "C", 0, None, None)]
    assert sources.pileup_six(spark, put(tmp_path, "p.gz", text, True)).count() == 1
    counts = sources.positional_counts(spark, put(tmp_path, "p.txt", text), "chr1").orderBy("position").collect()
    assert counts[0]["counts"] == {"A": 2, "G": 1} and counts[1]["counts"] == {} and counts[1].bases == "--"


def test_variant_tables(spark, tmp_path):
    rows = sources.extracted_variants(spark, put(tmp_path, "e.tsv", "#mutCount\tx\n2\t7\t0.2857\tchr1\t5\tA\t+2AC\tI\t+1-1\tchr1\t5\tA\n")).collect()
    assert (rows[0].mutCount, rows[0].plus, rows[0].minus, rows[0].indel.size, rows[0].rawPileUpLine) == (2, 1, 1, 2, "chr1\t5\tA")
    line = "2\t7\t0.3\tchr1\t5\t.\tA\tG\t0\t.\tINDEL;DP=3\tNA\tNA"
    assert sources.legacy_variants(spark, put(tmp_path, "l.tsv", f"#h\n{line}\na\tb\n")).first().position == 5
    joined = sources.joined_variants(spark, put(tmp_path, "j.tsv", f"{line}\t{line.replace('INDEL;DP=3', 'NA')}\n"), "chr1").first()
    assert joined.tumor_info == {"DP": "3", "type": "Indel"} and joined.normal_info == {"type": "Substitution"}


def test_read_counts(spark, tmp_path):
    cell = lambda b, n: f"{b}:{n}:60:30:0:1:1:0.5:0:0:0:0:100:0.5"
    text = f"c\t5\tA\t9\tx\t{cell('A', 7)}\t{cell('G', 2)}\tbad:1\nc\t5\tA\t9\tx\t{cell('A', 8)}\n"
    rows = sources.allele_read_counts(spark, put(tmp_path, "r.tsv", text)).collect()
    assert [(r.allele, r["count"], r.dist3) for r in rows] == [("A", 8.0, 0.5)]


VCF = """##x
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tN\tT
1\t10\t.\tA\tC,G\t5\tPASS\tDP=3\tGT:AD\t0/0:20,0,0\t0|1:15,10,0
1\t11\t.\tA\tC\t5\tPASS\t.\tGT:AD\t./.\t0/1:15,10
1\t12\t.\tA\tC\t5\tPASS\t.\tGT:AD\t0/0:3,0\t0/1:15,10
"""


def test_vcf(spark, tmp_path):
    path = put(tmp_path, "a.g.vcf", VCF)
    rows = sources.genotype_vcf(spark, path, "N", "T")
    somatic = callers.somatic_from_vcf(rows).collect()
    assert [(r.position, r.alt, r.normal_depth, r.tumor_supporting, r.tumor_depth) for r in somatic] == [(10, "C", 20, 10, 25)]
    assert round(somatic[0].pvalue, 6) == 0.009046
    wanted = spark.createDataFrame([("1", 10, "A", "G")], "contig string, position bigint, ref string, alt string")
    assert callers.vcf_alternatives(sources.vcf(spark, path), wanted).first().alt == "G"
    assert sources.gvcf_folder(spark, str(tmp_path)).count() == 3
    with pytest.raises(FileNotFoundError):
        sources.gvcf_folder(spark, str(tmp_path), None) if (tmp_path / "a.g.vcf").rename(tmp_path / "a.txt") else None


def test_vcf_files_of_different_samples(spark, tmp_path):
    head = "##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t"
    paths = [put(tmp_path, f"{n}.g.vcf", f"{head}{n}\n1\t{k}\t.\tA\tC\t5\tPASS\t.\tGT:AD\t0/1:{k},1\n") for k, n in ((9, "zeta"), (7, "alpha"))]
    rows = sources.vcf(spark, paths).collect()
    assert {(r.position, *r.samples) for r in rows} == {(9, "zeta"), (7, "alpha")} and {r.samples[n]["AD"] for r in rows for n in r.samples} == {"9,1", "7,1"}
    assert sources.gvcf_folder(spark, str(tmp_path)).count() == 2
    with pytest.raises(Exception, match="no header line"):
        sources.vcf(spark, put(tmp_path, "bare.vcf", "1\t5\t.\tA\tC\n")).collect()


def test_last_file_wins(spark, tmp_path):
    """The order of the given paths counts, not that of sizes or names."""
    text = "contig\tposition\tref\talt\tt_ref_count\tt_alt_count\tn_ref_count\tn_alt_count\n" + "1\t5\tA\tC\t15\t{}\t20\t0\n"
    long, short = put(tmp_path, "a.tsv", text.format(11) + text.format(12).split("\n")[1] + "\n" * 500), put(tmp_path, "b.tsv", text.format(13))
    for paths, want in (([long, short], 13), ([short, long], 12)):
        assert callers.somatic_from_mutect(sources.mutect(spark, paths)).first().tumor_supporting == want


def test_caller_tables(spark, tmp_path):
    mutect = "## v\ncontig\tposition\tref_allele\talt_allele\tt_ref_count\tt_alt_count\tn_ref_count\tn_alt_count\tjudgement\n1\t5\tA\tC\t15\t10\t20\t0\tKEEP\n1\t6\tA\tC\t15\t10\t20\t0\tREJECT\n"
    assert [r.position for r in callers.somatic_from_mutect(sources.mutect(spark, put(tmp_path, "m.tsv", mutect))).collect()] == [5]
    varscan = "chrom\tposition\tref\tvar\n" + "\t".join("1 5 A C 20 0 0% A 15 10 40% M Somatic 1.0 0.01".split() + ["1"] * 8) + "\n"
    path = put(tmp_path, "v.tsv", varscan)
    assert callers.somatic_from_varscan(sources.varscan_fixed(spark, path)).first().tumor_depth == 25
    assert callers.varscan_positions(sources.varscan_native(spark, path)).first().end == 6
    paths = [put(tmp_path, f"{c}.x/run/calls.txt", t) for c, t in (("one", "1\t5\t.\tA\tC\n"), ("two", "1\t5\tA>C\n"))]
    rows = sources.multi_caller_calls(spark, paths, {"two": (0, 1, 2, 2)}).collect()
    assert {(r.source, r.ref, r.alt) for r in rows} == {("one", "A", "C"), ("two", "A", "C")}


def test_annotations(spark, tmp_path):
    names = "Hugo_Symbol Chromosome Start_position Reference_Allele Tumor_Seq_Allele2 Variant_Classification Variant_Type Protein_Change Annotation_Transcript description Genome_Change Transcript_Exon cDNA_Change".split()
    maf = "#v\n" + "\t".join(names) + "\nG\t1\t5\tA\tC\tMissense\tSNP\tp.V6E\tENST1.2\té\tg\te\tc\nG\t1\t6\tA\tC\tSilent\tSNP\tp.L5L\tENST1.2\td\tg\te\tc\n"
    rows = sources.maf(spark, put(tmp_path, "a.maf", maf))
    assert rows.where("position = 5").first().description == "é" and protein.coding_changes(rows).count() == 1
    fasta = ">ENSP1.1 pep transcript:ENST1.9 gene:ENSG1.1\nMKLV\nVV\n>ENSP2.1 pep transcript:ENST2.9 gene:ENSG1.1\nMM\n"
    proteins = sources.protein_fasta(spark, put(tmp_path, "p.fa", fasta))
    assert {(r.protein, r.transcript, r.gene, r.sequence) for r in proteins.collect()} == {("ENSP1", "ENST1", "ENSG1", "MKLVVV"), ("ENSP2", "ENST2", "ENSG1", "MM")}
    found = protein.sequences_of(protein.coding_changes(rows), proteins)
    assert found.first().sequence == "MKLVVV" and protein.gene_transcripts(proteins).first().transcripts == ["ENST1", "ENST2"]
    assert protein.sequences_of(spark.createDataFrame([("ENSG1.5",)], "transcript string"), proteins).count() == 2


def test_reports(spark, tmp_path):
    row = "0 HLA-A*02:01 AAAAAAAAA AAAAAAAAA 0 0 0 0 0 AAAAAAAAA Gene 0.5 100.0 1.5"
    rows = sources.binding_report(spark, put(tmp_path, "b.txt", f"# c\n-----\npos HLA peptide\n{row}\n{row} <= SB\n")).collect()
    assert [(r.hla, r.affinity, r.bindingFlag) for r in rows] == [("A*02:01", 100.0, None), ("A*02:01", 100.0, "SB")]
    with pytest.raises(Exception, match="neither 14 nor 16"):
        sources.binding_report(spark, put(tmp_path, "c.txt", row + " x\n")).collect()
    report = "x\nInferred Allelic Pairs\n-----\nhead\nA*02:01:01\tA*24:02 0.5\n\nB*07:02 B*08:01 0.1\n"
    found = sources.hla_report(spark, put(tmp_path, "h.txt", report)).orderBy("ord").collect()
    assert [(r.molecule, r.allele) for r in found] == [("A", "A*02:01:01"), ("A", "A*24:02"), ("B", "B*07:02"), ("B", "B*08:01")]
    assert sources.allele_list(spark, put(tmp_path, "l.txt", "A1 x\n\nB2\n")).count() == 2
    sam = "@HD\nr\t16\tc\t5\t60\t4M\t*\t0\t0\tACGT\tIIII\n"
    assert sources.sam_text(spark, put(tmp_path, "s.sam", sam)).first().flag == 16


def test_intervals(spark, tmp_path):
    rows = sources.bed(spark, put(tmp_path, "i.bed", "track\nc\t10\t20\nc\t15\t30\nc\t40\t50\n"))
    assert sorted((r.start, r.end) for r in sources.merge_intervals(rows).collect()) == [(10, 30), (40, 50)]
    assert sources.merge_intervals(sources.pad_intervals(rows)).first().start == 0


def test_files(spark, tmp_path):
    for name in ("a-b-c_S1_L001_R1_001.fastq.gz", "sub/a_b_S2_L002_R2_001.fastq", "sub/more/x_S3_L001_R1_001.fastq", "other.fq.txt"):
        put(tmp_path, name, "x")
    rows = {r.sampleName: r for r in sources.fastq_catalogue(spark, str(tmp_path)).collect()}
    assert rows["a-b-c"].tags == ["a", "b", "c"] and rows["a-b-c"].gzip and rows["a_b"].tags == ["a", "b"] and set(rows) == {"a-b-c", "a_b", "x"}
    assert sources.fastq_catalogue(spark, str(tmp_path), depth=1).count() == 2


def test_columns():
    assert sources.resolve_columns(["Chrom", "POS"], {"contig": ["chrom"], "pos": []}) == {"contig": 0, "pos": 1}
    assert sources.case_collisions(["a", "A", "b"]) == {"A"}
    with pytest.raises(ValueError):
        sources.resolve_columns(["x"], {"contig": []})


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("1", 5, "A", "C", 20, 0, 25, 10, "one", 0.5)], "contig string, position bigint, ref string, alt string, normal_depth int, normal_supporting int, tumor_depth int, tumor_supporting int, source string, x double")
    sinks.consensus_table(df, ["one", "two"], f"{tmp_path}/c")
    assert spark.read.text(f"{tmp_path}/c").collect()[1][0].split("\t") == ["1", "5", "A", "C", "10,25,0,20", "NA", "1"]
    sinks.caller_tables(df, f"{tmp_path}/s")
    sinks.annotation_input(df, f"{tmp_path}/a")
    sinks.fused_table(df, f"{tmp_path}/f")
    sinks.compressed(df, f"{tmp_path}/z")
    sinks.peptide_files(spark.createDataFrame([(8, "AAAAAAAA")], "k int, peptide string"), f"{tmp_path}/p")
    assert spark.read.text(f"{tmp_path}/p/k=8").first()[0] == "AAAAAAAA"


def test_stream(spark, tmp_path):
    put(tmp_path, "in/p.txt", "chr1\t5\ta\t3\t.,G\tIII\n")
    stream = streaming.variant_stream(spark, str(tmp_path / "in")).writeStream.format("memory").queryName("found").option("checkpointLocation", str(tmp_path / "cp")).start()
    stream.processAllAvailable()
    stream.stop()
    assert spark.table("found").select("alt", "mutCount").where(F.col("alt") == "G").count() == 1


def test_headers_by_file(spark, tmp_path):
    head = "contig\tposition\tref_allele\talt_allele\t{}\t{}\t{}\t{}"
    counts = ("t_ref_count", "t_alt_count", "n_ref_count", "n_alt_count")
    (tmp_path / "a.tsv").write_text("## x\n" + head.format(*counts) + "\tjudgement\n1\t5\tA\tC\t10\t5\t20\t0\tKEEP\n")
    (tmp_path / "b.tsv").write_text(head.format(*counts[2:], *counts[:2]) + "\n1\t6\tA\tC\t20\t0\t10\t5\n\n# note\n1\t7\tA\tC\t21\t1\t11\t6\n")
    rows = {r.position: r for r in sources.mutect(spark, [str(tmp_path / "a.tsv"), str(tmp_path / "b.tsv")]).collect()}
    assert [(rows[p].tumor_supporting, rows[p].normal_supporting, rows[p].tumor_depth, rows[p].judgement) for p in (5, 6, 7)] == [(5, 0, 15, "KEEP"), (5, 0, 15, None), (6, 1, 17, None)]
    assert "judgement" not in sources.mutect(spark, str(tmp_path / "b.tsv")).columns
    (tmp_path / "c.tsv").write_text("contig\tposition\tref\n1\t5\tA\n")
    with pytest.raises(Exception, match="no column for alt"):
        sources.varscan_native(spark, [str(tmp_path / "b.tsv"), str(tmp_path / "c.tsv")]).collect()
    (tmp_path / "d.tsv").write_text("Chrom\tpos\tPOS\tref\tvar\n1\t5\t6\tA\tC\n")  # names that differ in case alone are told by it
    assert [(r.contig, r.position, r.alt) for r in sources.varscan_native(spark, str(tmp_path / "d.tsv")).collect()] == [("1", 5, "C")]


def test_paths_with_like_names(spark, tmp_path):
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "a.tsv").write_text("inner\n")
    (tmp_path / "a.tsv").write_text("outer\n")
    for given in ([str(tmp_path / "b" / "a.tsv"), str(tmp_path / "a.tsv")], [str(tmp_path / "a.tsv"), str(tmp_path / "b")]):
        got = [r.value for r in columns.lines(spark, given).orderBy("ord").collect()]
        assert got == (["inner", "outer"] if given[0].endswith("b/a.tsv") else ["outer", "inner"])


def test_state_of_compressed_files(spark, tmp_path):
    whole = gzip.compress(os.urandom(3_000_000))
    files = {"whole.gz": whole, "two.gz": gzip.compress(b"one") + gzip.compress(b"two" * 100_000), "short.gz": whole[:-5], "half.gz": whole[:1_500_000], "plain.gz": b"ACGT\n", "more.gz": whole + b"text", "bad.gz": whole[:-6] + b"\0\0" + whole[-4:]}
    (tmp_path / "sub").mkdir()
    for name, blob in files.items():
        (tmp_path / ("sub" if name == "two.gz" else "") / name).write_bytes(blob)
    got = {r.path.rsplit("/", 1)[1]: (r.state, r.bytes) for r in sources.compressed_state(spark, str(tmp_path), step=100_000).collect()}
    assert {k: v[0] for k, v in got.items()} == {"whole.gz": "whole", "two.gz": "whole", "short.gz": "truncated", "half.gz": "truncated", "plain.gz": "not gzip", "more.gz": "trailing", "bad.gz": "damaged"}
    assert got["whole.gz"][1] == 3_000_000 and got["two.gz"][1] == 300_003


def test_one_contig_is_read_alone(spark, tmp_path, capsys):
    df = spark.createDataFrame([(c, p, f"{c}{p}") for c in ("c1", "c2", "c3") for p in range(1, 4001)], "contig string, position bigint, what string")
    sinks.clustered(df, str(tmp_path / "t"), rows_a_file=1000)
    rows = sources.contig_rows(spark, str(tmp_path / "t"), "c2", 3500, 3600)
    assert sorted(r.what for r in rows.collect()) == sorted(f"c2{p}" for p in range(3500, 3601))
    read = {r[0] for r in sources.contig_rows(spark, str(tmp_path / "t"), "c2").select("_metadata.file_path").distinct().collect()}
    assert read and all("contig=c2" in f for f in read) and len(read) >= 4
    rows.explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(contig" in plan and "GreaterThanOrEqual(position,3500)" in plan
    assert spark.read.parquet(str(tmp_path / "t")).count() == 12_000

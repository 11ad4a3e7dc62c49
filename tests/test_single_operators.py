"""Operators that no registered query shows by itself, and spreading of hot contigs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from helixframe.functions import text
from helixframe.operators import alignments, callers, compare, epitope, relational, rna
from helixframe.sources import annotations, info_map

KEYED = "contig string, position bigint, ref string, alt string"


def value(spark, expression):
    return spark.range(1).select(expression).first()[0]


def test_info_text(spark):
    read = lambda t: value(spark, info_map(F.lit(t)))
    assert read("INDEL;DP=7;AF=0.5") == {"DP": "7", "AF": "0.5", "type": "Indel"}
    assert read("DP=7") == {"DP": "7", "type": "Substitution"} and read("NA") == {"type": "Substitution"} and read("INDEL;NA=NA")["type"] == "Indel"


def test_indel_text_is_what_is_parsed(spark):
    assert value(spark, text.indel_text(F.lit("+"), F.lit(2), F.lit("AC"))) == "+2AC"
    parsed = value(spark, text.parse_indel(text.indel_text(F.lit("-"), F.lit(1), F.lit("T"))))
    assert (parsed.kind, parsed.size, parsed.seq) == ("-", 1, "T")


def test_read_texts_and_counts(spark):
    lit = lambda t: F.lit(t)
    assert value(spark, rna.normalised_reads(lit(".,Gg+2ACt*^I."), lit("A"))) == "AAGGA"  # the insertion swallows the t
    assert value(spark, rna.normalised_reads(lit(".,Gg+2ACt"), lit("A"), compat=False)) == "AAGGACT"
    assert [value(spark, rna.text_count(lit(t), lit(a))) for t, a in (("AAGGA", "A"), ("AAGGA", "AG"), ("AAAA", "AA"), ("", "A"), ("AA", ""))] == [3, 1, 2, 0, 0]


def test_support_fraction(spark):
    rows = spark.createDataFrame([(1, 4), (0, 0), (0, 5)], "rna_support int, rna_depth int")
    found = [r.rna_fraction for r in rna.support_fraction(rows).collect()]
    assert found[0] == 0.25 and math.isnan(found[1]) and found[2] == 0.0


def test_normal_columns_by_locus(spark):
    tumor = spark.createDataFrame([("chr2", 5, "A", "C"), ("chr10", 7, "A", "G"), ("chr10", 3, "A", "T")], KEYED)
    normal = spark.createDataFrame([("chr10", 7, 30, None)], "contig string, position bigint, depth int, note string")
    rows = [tuple(r) for r in compare.variants_with_normal(tumor, normal, ["depth", "note"]).collect()]
    # Contigs in the order of their texts; what the normal lacks is NA.
    assert rows == [("chr10", 3, "A", "T", "NA", "NA"), ("chr10", 7, "A", "G", "30", "NA"), ("chr2", 5, "A", "C", "NA", "NA")]


def test_gathered_parts(spark):
    one, two = (spark.createDataFrame(rows, "k int, v string") for rows in ([(1, "a"), (2, "b")], [(2, "c"), (3, "d")]))
    assert sorted(map(tuple, relational.gather([one, two], ["k"]).collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_lanes_and_read_groups(spark):
    lanes = [spark.createDataFrame([(c, p, f"{c}{p}") for c, p in rows], "contig string, pos bigint, name string") for rows in ([("c2", 9), ("c1", 5)], [("c1", 3), ("c2", 1)])]
    assert [r.name for r in alignments.merge_lanes(lanes).collect()] == ["c13", "c15", "c21", "c29"]
    assert [r.name for r in alignments.merge_lanes(lanes[:1]).collect()] == ["c29", "c15"]  # one lane stays as it is
    assert [r.name for r in alignments.coordinate_sort(lanes[0]).collect()] == ["c15", "c29"]
    row = alignments.tag_read_group(lanes[0], "g1", "s1", library="l1").first()
    assert (row.RGID, row.RGSM, row.RGLB, row.RGPL, row.RGPU) == ("g1", "s1", "l1", "ILLUMINA", "")


def test_last_prediction(spark):
    rows = spark.createDataFrame([("P", "A", 5.0, 1), ("P", "A", 7.0, 3), ("P", "A", 6.0, 2), ("P", "B", 1.0, 9)], "peptide string, hla string, affinity double, ord int")
    assert {(r.peptide, r.hla): r.affinity for r in epitope.prediction_index(rows).collect()} == {("P", "A"): 7.0, ("P", "B"): 1.0}


def test_keyword_rows(spark):
    rows = spark.createDataFrame([("x REJECT y",), ("KEEP",), (None,)], "value string")
    assert relational.keyword_rows(rows, "REJECT").count() == 2 and relational.keyword_rows(rows, "REJECT", reject=False).first().value == "x REJECT y"


def test_tables_of_records(spark):
    call = f"source string, {KEYED}, normal_depth int, normal_supporting int, tumor_depth int, tumor_supporting int"
    df = spark.createDataFrame([("a", "1", 5, "A", "C", 20, 0, 30, 9), ("b", "1", 5, "A", "C", 22, 0, 34, 11), ("a", "1", 9, "A", "C", 20, 0, 30, 9), ("b", "1", 9, "A", "C", 20, 0, 30, 9)], call)
    evidence = spark.createDataFrame([("1", 5, "A", "C", 3, 4)], f"{KEYED}, rna_support int, rna_depth int")
    tables = callers.record_tables(callers.consensus(df).join(evidence, ["contig", "position", "ref", "alt"], "left"))
    assert set(tables) == {"combined", "raw", "rna"} and tables["combined"].count() == 2 and "by_source" not in tables["combined"].columns
    assert sorted((r.source, r.tumor_depth) for r in tables["raw"].where("position = 5").collect()) == [("a", 30), ("b", 34)]
    assert [tuple(r)[4:] for r in tables["rna"].collect()] == [(3, 4)]
    assert set(callers.record_tables(callers.consensus(df, test=False))) == {"combined", "raw"}


# ---------------------------------------------------------------- intervals


def intervals(spark, rows):
    return spark.createDataFrame(rows, "contig string, start bigint, end bigint, n int")


def random_intervals(seed, n, longest):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        start = rng.randint(-50, 5000)
        out.append((rng.choice(("a", "b")), start, start + int(longest ** rng.random()) - 1, k))
    return out


def test_interval_join_of_all_lengths(spark):
    one, two = random_intervals(1, 150, 5000), random_intervals(2, 120, 60)
    one += [("a", 10, 5, 900), (None, 1, 9, 901), ("a", None, 9, 902), ("b", -50, 10**9, 903)]
    two += [("a", 0, 10**9, 900), ("b", 64, 63, 901), ("b", 70, None, 902)]
    meet = lambda x, y: None not in x and None not in y and x[0] == y[0] and x[1] <= y[2] and y[1] <= x[2]
    want = sorted((x[3], y[3]) for x in one for y in two if meet(x, y))
    a, b = intervals(spark, one), intervals(spark, two)
    for size, fan in ((16, 2), (64, 8), (1000, 8)):
        assert sorted((r.n, r.r_n) for r in relational.interval_join(a, b, size, fan=fan).collect()) == want
    hit = {k for k, _ in want}
    assert sorted(r.n for r in relational.interval_join(a, b, 64, "semi").collect()) == sorted(hit)
    assert sorted(r.n for r in relational.interval_join(a, b, 64, "anti").collect()) == sorted({x[3] for x in one} - hit)
    assert relational.interval_join(a, b.where("false"), 64).count() == 0 and relational.interval_join(a, b.where("false"), 64, "anti").count() == a.count()


def test_long_intervals_are_not_copied_to_every_bin(spark):
    """Contig-long intervals against short ones: the rows that reach the join stay few."""
    long, short = intervals(spark, [("a", 0, 250_000_000, k) for k in range(5)]), intervals(spark, [("a", 1000 * k, 1000 * k + 99, k) for k in range(400)])
    joined = relational.interval_join(long, short)
    assert joined.count() == 2000
    rows = {r["n"]: r["count"] for r in joined.groupBy("n").count().collect()}
    assert rows == dict.fromkeys(range(5), 400)
    # Rows of the long side after it is dealt to bins, as Spark counted them.
    dealt = [n for n in generated_rows(joined) if n]
    assert dealt and max(dealt) <= 400 * 2 * 7 + 5 * 2 * 7  # flat bins would make 5 * 250,000


def generated_rows(df):
    """Numbers of output rows of all Generate nodes of a plan that has run."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.collectToPython()
    final = plan.finalPhysicalPlan() if hasattr(plan, "finalPhysicalPlan") else plan
    out, stack = [], [final]
    while stack:
        node = stack.pop()
        if node.nodeName().startswith("Generate"):
            out.append(node.metrics().apply("numOutputRows").value())
        if hasattr(node, "plan") and "QueryStage" in node.nodeName():
            stack.append(node.plan())
        stack += [node.children().apply(k) for k in range(node.children().size())]
    return out


@pytest.mark.parametrize("stride", [7, 100, 100_000])
def test_merged_intervals_across_stretches(spark, stride):
    rows = [r for r in random_intervals(5, 300, 300)]
    want = []
    for contig in ("a", "b"):
        run = None
        for _, s, e, _ in sorted((r for r in rows if r[0] == contig), key=lambda r: r[1:3]):
            if run and s <= run[2]:
                run[2] = max(run[2], e)
            else:
                run = [contig, s, e]
                want.append(run)
    got = annotations.merge_intervals(intervals(spark, [*rows, (None, 1, 2, 0), ("a", None, 5, 0)]), stride)
    assert sorted(map(list, got.select("contig", "start", "end").collect())) == sorted(want)

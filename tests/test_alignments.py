"""Reads to pileups: indels, read ends, depth, base alignment quality, fragments, haplotypes and trimming, against plain versions."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixframe.operators import alignments, pileup, realign, tandem
from helixframe.plans import jobs

READ = "name string, flag int, contig string, pos bigint, mapq int, cigar string, seq string, qual string"


def reference_of(spark, text, contig="c", first=1):
    return spark.createDataFrame([(contig, first + k, b) for k, b in enumerate(text)], "contig string, position bigint, ref string")


def steps_of(cigar):
    return [(int(n), op) for n, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar)]


# ---------------------------------------------------------------- pileups


def test_indels_and_read_ends(spark):
    reads = spark.createDataFrame(
        [("a", 0, "c", 1, 60, "2M2I2M", "ACTTGT", "IIIIII"), ("b", 16, "c", 1, 9, "2M2D2M", "ACAC", "IIII"), ("c", 0, "c", 2, 60, "1S2M1P1I2M", "GCGAAC", "IIIIII"), ("d", 0, "c", 1, 60, "3M2N1M", "ACGC", "II!I")], READ
    )
    rows = {r.position: r for r in alignments.build_pileup(reads, reference_of(spark, "ACGTAC"), base_alignment_quality=False).collect()}
    # Of equal quality bases are in the order of base, strand, inserted letters and so on.
    assert [rows[p].bases for p in range(1, 7)] == ["^].^].^*,", ".^]..+2TT,-2gt", "..+1A*", "A.$*", ",C$", ".$,$"]
    assert rows[1].depth == 3 and rows[3].depth == 3
    counts = {(r.position, r.allele): (r["count"], r.plus, r.minus) for r in pileup.allele_counts(alignments.build_pileup(reads, reference_of(spark, "ACGTAC"), base_alignment_quality=False)).collect()}
    assert counts[2, "+2TT"] == (1, 1, 0) and counts[2, "-2GT"] == (1, 0, 1) and counts[3, "+1A"] == (1, 1, 0)


def test_metrics_of_indels(spark):
    reads = spark.createDataFrame([("a", 0, "c", 1, 60, "2M2I2M", "ACTTGT", "II!III"), ("b", 16, "c", 1, 20, "2M2D2M", "ACAC", "I5II"), ("c", 0, "c", 1, 40, "2M2D2M", "ACAC", "I?II")], READ)
    reference = reference_of(spark, "ACGTAC")
    found = {(r.position, r.allele): r for r in alignments.allele_metrics(reads, reference, indels=True).collect()}
    assert {k for k in found if k[1][0] in "+-"} == {(2, "+2TT"), (2, "-2GT")}
    one, two = found[2, "+2TT"], found[2, "-2GT"]
    assert (one["count"], one.mapq, one.basequal, one.plus) == (1.0, 60.0, 40.0, 1.0) and (two["count"], two.mapq, two.basequal, two.plus, two.minus) == (2.0, 30.0, 25.0, 1.0, 1.0)
    plain = {(r.position, r.allele): r for r in alignments.allele_metrics(reads, reference).collect()}
    assert plain == {k: r for k, r in found.items() if k[1][0] not in "+-"} and plain[2, "C"]["count"] == 3.0


def test_long_indels_and_missing_reference(spark):
    reads = spark.createDataFrame([("a", 0, "c", 1, 60, "2M70D2M", "ACGT", "IIII"), ("b", 0, "c", 1, 60, "2M65I2M", "AC" + "G" * 65 + "GT", "I" * 69)], READ)
    reference = reference_of(spark, "ACGT" + "A" * 40)  # ends within the deletion
    counts = {r.allele for r in pileup.allele_counts(alignments.build_pileup(reads, reference, base_alignment_quality=False)).where("position = 2").collect()}
    assert counts == {"-70GT" + "A" * 40 + "N" * 28, "+65" + "G" * 65}


def test_depth_cap_equals_the_first_of_the_whole(spark):
    rng = random.Random(5)
    reads = [(f"r{k}", 16 * rng.randint(0, 1), "c", rng.randint(1, 4), rng.randint(0, 60), "6M", "".join(rng.choice("ACGT") for _ in range(6)), "".join(chr(33 + rng.randint(13, 40)) for _ in range(6))) for k in range(300)]
    df, reference = spark.createDataFrame(reads, READ), reference_of(spark, "ACGTACGTAC")
    for marks in (False, True):
        whole = {r.position: r for r in alignments.build_pileup(df, reference, marks=marks, base_alignment_quality=False).collect()}
        for most in (1, 7, 1000):
            got = {r.position: r for r in alignments.build_pileup(df, reference, max_depth=most, marks=marks, base_alignment_quality=False).collect()}
            assert set(got) == set(whole)
            for p, r in got.items():
                assert r.depth == min(most, whole[p].depth) == len(r.quals) and whole[p].quals.startswith(r.quals) and whole[p].bases.startswith(r.bases)


def test_tokens_of_any_length(spark):
    text = ".+61" + "A" * 61 + "C.,-3acgt^+A$*+2NNg>+1Tt#-1AC"
    df = spark.createDataFrame([("c", 1, "G", 9, text)], "contig string, position bigint, ref string, depth int, bases string")
    found = {(r.allele, r.plus, r.minus) for r in pileup.allele_counts(df).collect()}
    assert found == {("+61" + "A" * 61, 1, 0), ("C", 2, 0), ("G", 1, 1), ("-3ACG", 0, 1), ("T", 0, 2), ("A", 1, 0), ("+2NN", 1, 0)}


def plain_tokens(bases, ref):
    """Left to right, one symbol and what belongs to it at a time."""
    text, k, out = re.sub(r"\^.", "", bases).replace("$", ""), 0, []
    while k < len(text):
        c, last = text[k], None
        k += 1
        if c in ".,*ACGTNacgtn":
            last = c
        while (m := re.match(r"[+-](\d+)", text[k:])) is not None:
            k += len(m[0])
            letters = re.match("[A-Za-z]*", text[k:])[0][: int(m[1])]
            k += len(letters)
            if last is not None and letters:
                out.append((f"{m[0]}{letters}".upper(), letters.upper() == letters))
                last = None
        if last is not None and last.upper() not in "*N":
            out.append((ref if last in ".," else last.upper(), last == "." or (last.isupper())))
    return sorted(out)


def test_tokens_of_random_lines(spark):
    rng = random.Random(2)
    pieces = [".", ",", "A", "c", "*", "N", "^I.", "$", "+2AC", "-1t", "+12" + "ACGTACGTACGT", "-3acg"]
    lines = []
    for _ in range(200):
        parts = [rng.choice(pieces) for _ in range(rng.randint(0, 12))]
        parts = [p for k, p in enumerate(parts) if p[0] not in "+-" or (k and parts[k - 1][0] not in "+-$" and parts[k - 1] not in "*N")]
        lines.append("".join(parts))
    df = spark.createDataFrame([(k, t) for k, t in enumerate(lines)], "k int, t string")
    got = {r.k: sorted((a.allele, a.plus) for a in r.a) for r in df.select("k", pileup.alleles_of(F.col("t"), F.lit("G")).alias("a")).collect()}
    assert got == {k: plain_tokens(t, "G") for k, t in enumerate(lines)}


# ---------------------------------------------------------------- base alignment quality


def plain_posteriors(query, window, error, width, o=1e-3, x=0.1):
    """The same model over the full matrix of a read and its window, as plain loops."""
    n, m = len(query), len(window)
    end = 1 / (2 * n)
    fits = lambda i, j: 0 <= j - i < width
    to = {"M": {"M": (1 - 2 * o) * (1 - end), "I": o * (1 - end), "D": o * (1 - end)}, "I": {"M": (1 - x) * (1 - end), "I": x * (1 - end), "D": 0}, "D": {"M": 1 - x, "I": 0, "D": x}}

    def emit(i, j):
        return 0.25 if query[i] > 3 or window[j] > 3 else 1 - error[i] if query[i] == window[j] else error[i] / 3

    f = {s: np.zeros((n, m)) for s in "MID"}
    b = {s: np.zeros((n, m)) for s in "MID"}
    for i in range(n):
        for j in range(m):
            if fits(i, j):
                if i == 0:
                    f["M"][i, j], f["I"][i, j] = emit(0, j) * (1 - o) / width, 0.25 * o / width
                else:
                    f["M"][i, j] = emit(i, j) * sum(f[s][i - 1, j - 1] * to[s]["M"] for s in "MID") if j else 0
                    f["I"][i, j] = 0.25 * sum(f[s][i - 1, j] * to[s]["I"] for s in "MID")
                f["D"][i, j] = sum(f[s][i, j - 1] * to[s]["D"] for s in "MID") if j and fits(i, j - 1) else 0
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            if fits(i, j):
                for s in "MID":
                    if i == n - 1:
                        b[s][i, j] = 0 if s == "D" else end
                        continue
                    total = emit(i + 1, j + 1) * to[s]["M"] * b["M"][i + 1, j + 1] if j + 1 < m else 0
                    total += 0.25 * to[s]["I"] * b["I"][i + 1, j]
                    total += to[s]["D"] * b["D"][i, j + 1] if j + 1 < m and fits(i, j + 1) else 0
                    b[s][i, j] = total
    whole = (f["M"][n - 1].sum() + f["I"][n - 1].sum()) * end
    post = f["M"] * b["M"] / whole
    return np.array([[post[i, i + k] for k in range(width)] for i in range(n)])


def test_posteriors_equal_the_full_matrix():
    rng = np.random.default_rng(0)
    for n, width in ((1, 3), (6, 5), (25, 9), (40, 15)):
        window = rng.integers(0, 5, (4, n + width - 1)).astype(np.uint8)
        query = np.stack([w[width // 2 : width // 2 + n] for w in window])
        query = np.where(rng.random(query.shape) < 0.1, rng.integers(0, 4, query.shape), query).astype(np.uint8)
        error = 10.0 ** (-rng.integers(1, 41, query.shape) / 10)
        got = realign.posteriors(query, window, error)
        for k in range(4):
            assert np.allclose(got[:, k], plain_posteriors(query[k], window[k], error[k], width), atol=1e-9)


def test_base_alignment_quality_lowers_misplaced_ends(spark):
    """A read whose end was laid over an insertion as mismatches loses quality there; a matching read keeps it."""
    rng = random.Random(3)
    text = "".join(rng.choice("ACGT") for _ in range(3000))
    seq = text[1000:1060]
    wrong = seq[:50] + "GATTACA" + seq[50:53]  # the true read has an insertion of 7 near its end
    reads = [("good", 0, "c", 1001, 60, "60M", seq, "I" * 60), ("bad", 0, "c", 1001, 60, "60M", wrong, "I" * 60), ("clip", 0, "c", 1001, 60, "5S60M", "AAAAA" + seq, "I" * 65)]
    reads += [("spliced", 0, "c", 1001, 60, "30M5N30M", seq, "I" * 60), ("far", 0, "other", 5, 60, "60M", seq, "I" * 60), ("deleted", 0, "c", 1001, 60, "30M4D30M", text[1000:1030] + text[1034:1064], "I" * 60), ("none", 0, "c", 7, 60, None, None, None)]
    df = spark.createDataFrame(reads, READ)
    out = realign.lower_qualities(df, reference_of(spark, text))
    assert out.schema == df.schema
    found = {r.name: r.qual for r in out.collect()}
    assert len(found) == 7 and found["none"] is None and found["spliced"] == found["far"] == "I" * 60
    q = {k: np.frombuffer(v.encode(), np.uint8).astype(int) - 33 for k, v in found.items() if v}
    assert (q["good"][3:57] >= 30).all() and (q["clip"][8:62] >= 30).all() and (q["clip"][:5] == 40).all() and (q["deleted"][3:25] >= 30).all()
    assert (q["bad"][5:45] >= 30).all() and q["bad"][51:].max() < 20
    on, off = (alignments.build_pileup(df.where("name = 'bad'"), reference_of(spark, text), base_alignment_quality=b).count() for b in (True, False))
    assert on < off == 60


def test_long_reads_take_longer_stretches(spark):
    rng = random.Random(4)
    text = "".join(rng.choice("ACGT") for _ in range(5000))
    reads = [("long", 0, "c", 501, 60, "2400M", text[500:2900], "I" * 2400), ("edge", 0, "c", 1, 60, "50M", text[:50], "I" * 50), ("end", 0, "c", 4971, 60, "30M", text[4970:], "I" * 30)]
    found = {r.name: np.frombuffer(r.qual.encode(), np.uint8) - 33 for r in realign.lower_qualities(spark.createDataFrame(reads, READ), reference_of(spark, text)).collect()}
    assert (found["long"][5:-5] >= 35).all() and (found["edge"][5:-5] >= 30).all() and (found["end"][5:-5] >= 30).all()


# ---------------------------------------------------------------- duplicates


def test_duplicates_of_equal_quality_keep_the_least_name(spark):
    for names in ("abc", "cba"):
        df = spark.createDataFrame([(n, "c", 1, False, 9) for n in names], "name string, contig string, five_prime int, reverse boolean, qual_sum int")
        assert [r.name for r in alignments.mark_duplicates(df).where("not duplicate").collect()] == ["a"]


def test_fragments(spark):
    end = lambda name, which, five, reverse, q, more=0: (name, 1 + which + 16 * reverse + more, "c", five, reverse, q)
    rows = [
        end("p1", 64, 10, False, 50), end("p1", 128, 90, True, 50), end("p2", 128, 10, False, 60), end("p2", 64, 90, True, 50),  # the same ends
        end("p3", 64, 10, False, 50), end("p3", 128, 91, True, 90),  # another mate
        ("s1", 0, "c", 10, False, 99), ("s2", 0, "c", 50, False, 5), ("s3", 0, "c", 50, False, 5), ("s4", 16, "c", 50, True, 1),  # singles
        end("p2", 64, 90, True, 50, 2048), ("u", 4, None, None, None, 7), end("h", 64, 50, False, 4), (end("h", 128, 50, False, 4, 4)),  # supplementary, unplaced, half placed
        (None, 0, "c", 10, False, 1),
    ]
    df = spark.createDataFrame(rows, "name string, flag int, contig string, five_prime int, reverse boolean, qual_sum int")
    got = sorted((r.name or "", r.flag, r.duplicate) for r in alignments.mark_fragment_duplicates(df).collect())
    gone = {"p1", "s1", "s3", "h"}
    assert got == sorted((n or "", f, n in gone and not f & 4) for n, f, *_ in rows)


def test_reads_to_rows_finds_planted_indels(spark):
    rng = random.Random(6)
    text = "".join(rng.choice("ACGT") for _ in range(400))
    reads = []
    for k in range(12):
        at = 100 + k
        left, right = text[at : 150], text[150 : 150 + 40]
        if k % 2:
            reads.append((f"r{k}", 16 * (k % 4 == 1), "c", at + 1, 60, f"{len(left)}M3I{len(right)}M", left + "GGC" + right, "I" * (len(left) + 3 + len(right))))
        else:
            reads.append((f"r{k}", 0, "c", at + 1, 60, f"{len(left)}M4D{len(right) - 4}M", left + right[4:], "I" * (len(left) + len(right) - 4)))
    reads += [(f"copy{k}", *reads[0][1:]) for k in range(5)]  # copies of one read
    found = {(r.position, r.alt): r["count"] for r in jobs.reads_to_rows(spark.createDataFrame(reads, READ), reference_of(spark, text)).collect()}
    # Reads on the reverse strand end at one place, so one of the three stays.
    assert found[150, "+3GGC"] == 4 and found[150, f"-4{text[150:154]}"] == 6


# ---------------------------------------------------------------- haplotypes and trimming


def plain_haplotype(pos, cigar, seq, start, length):
    out, covered, ref, read = [], 0, pos, 0
    for n, op in steps_of(cigar):
        k = min(ref + n, start + length) - max(ref, start)
        if op in "M=X" and k > 0:
            out.append(seq[read + max(ref, start) - ref :][:k])
            covered += k
        elif op == "D" and k > 0:
            out.append("*" * k)
            covered += k
        elif op == "I" and start < ref < start + length:
            out.append(seq[read : read + n].lower())
        ref += n * (op in "M=XDN")
        read += n * (op in "M=XIS")
    return "".join(out) if covered == length else ""


def test_haplotypes_of_random_reads(spark):
    rng = random.Random(8)
    rows = [(0, 10, "4M1D3M", "ACGTACG", 12, 4), (1, 10, "4M2I3M", "ACGTTTACG", 12, 4), (2, 10, "3M", "ACG", 12, 4)]
    for k in range(3, 300):
        steps = [(rng.randint(1, 5), op) for op in ["M", *(rng.choice("MIDNSX=") for _ in range(rng.randint(0, 6))), "M"]]
        seq = "".join(rng.choice("ACGT") for _ in range(sum(n for n, op in steps if op in "MIS=X")))
        rows.append((k, 10, "".join(f"{n}{op}" for n, op in steps), seq, rng.randint(8, 25), rng.randint(1, 9)))
    df = spark.createDataFrame(rows, "k int, pos bigint, cigar string, seq string, start bigint, length bigint")
    found = df.select("k", alignments.haplotype(*map(F.col, ("pos", "cigar", "seq", "start", "length"))).alias("h"))
    got = {r.k: r.h for r in found.collect()}
    assert got == {r[0]: plain_haplotype(*r[1:]) for r in rows} and [got[k] for k in range(3)] == ["GT*A", "GTttAC", ""]


def test_haplotype_support_needs_no_python(spark, capsys):
    text = "ACGTACGTACGTACGTACGT"
    reads = spark.createDataFrame([(f"r{k}", 0, "c", 1, 60, "20M", text[:9] + ("GG" if k < 5 else text[9:11]) + text[11:], "I" * 20) for k in range(9)], READ)
    notes = spark.createDataFrame([("c", p, r, "G", "g", "7", "x", k) for k, (p, r) in enumerate(((10, "C"), (11, "G"))) if True], "contig string, position bigint, ref string, alt string, gene string, residue string, detail string, ord int")
    found = alignments.haplotype_support(tandem.mnv_candidates(notes), reads)
    assert [(r.start, r.end, r.alt, r.ref_reads, r.alt_reads) for r in found.collect()] == [(10, 11, "GG", 4, 5)]
    found.explain()
    trimmed = alignments.trim_pairs(spark.createDataFrame([("a", "ACGT", "IIII", "ACGT", "IIII")], "name string, seq1 string, qual1 string, seq2 string, qual2 string"))
    trimmed.explain()
    assert "Python" not in capsys.readouterr().out


def test_mnv_support_job(spark):
    text = "ACGTACGTACGTACGTACGT"
    reads = spark.createDataFrame([(f"r{k}", 0, "c", 1, 60, "20M", text[:9] + ("TT" if k < 5 else text[9:11]) + text[11:], "I" * 20) for k in range(9)], READ)
    notes = spark.createDataFrame([("c", 10, "C", "T", "g", "7", "x (1,2) :C/T:", 0), ("c", 11, "G", "T", "g", "7", "y (3,4) :G/T:", 1)], "contig string, position bigint, ref string, alt string, gene string, residue string, detail string, ord int")
    row = jobs.mnv_support(notes, reads).first()
    assert (row.ref, row.alt, row.ref_reads, row.alt_reads, row.detail) == ("CG", "TT", 4, 5, "x (4,5) :CG/TT:")


def plain_cuts(qual, offset=33, min_mean=20, min_length=20):
    q = [ord(c) - offset for c in qual]
    size = max(1, len(q) // 10) if q else 1
    start, end, began = 0, len(q), False
    for at in range(len(q) - size + 1):
        good = sum(q[at : at + size]) / size >= min_mean
        if good and not began:
            began, start = True, next((k for k in range(at, at + size) if q[k] >= min_mean), at)
        elif began and not good:
            end = next((k for k in range(at, at + size) if q[k] < min_mean), at)
            break
    return (start, end) if began and end - start >= min_length else (0, 0)


def test_trimming_of_random_reads(spark):
    rng = random.Random(9)
    texts = ["", "!!!!!" + "I" * 40 + "!!!!!!!!!!", "!" * 50, "5" * 20, "I" * 19, "I" * 20]
    for _ in range(300):
        level = 5
        parts = []
        for _ in range(rng.randint(0, 90)):
            level = min(40, max(0, level + rng.randint(-6, 7)))
            parts.append(chr(33 + level))
        texts.append("".join(parts))
    df = spark.createDataFrame([*enumerate(texts), (-1, None)], "k int, q string")
    got = {r.k: (r.c.start, r.c.end) for r in alignments.trim_cuts(df, "q", "c").collect()}
    assert got == {-1: (0, 0)} | {k: plain_cuts(t) for k, t in enumerate(texts)} and got[1] == (5, 45) and got[2] == got[0] == (0, 0)
    assert alignments.trim_cuts(df, "q", "c").columns == ["k", "q", "c"]


# ---------------------------------------------------------------- stretches


def test_runs_within_a_gene_are_the_same_however_it_is_cut(spark):
    rng = random.Random(10)
    rows, position = [], 0
    for k in range(400):
        position += rng.choice((0, 1, 1, 1, 2, 9))
        rows.append(("c", position, rng.choice("ACGT"), rng.choice("ACGT"), rng.choice(("g", "h", "NA")), rng.choice((str(position // 3), "NA", None)), f"d{k}", k))
    df = spark.createDataFrame(rows, "contig string, position bigint, ref string, alt string, gene string, residue string, detail string, ord int")
    want = []
    for gene in ("g", "h"):
        run = []
        for r in [*(x for x in rows if x[4] == gene), (None, -9, *[None] * 6)]:
            if run and (r[1] != run[-1][1] + 1 or r[5] is None or r[5] != run[-1][5] or r[5] == "NA"):
                if len(run) > 1:
                    want.append((gene, run[0][1], run[-1][1], "".join(x[2] for x in run), run[0][6]))
                run = []
            run.append(r)
    for stride in (4, 10, 1_000_000):
        runs = tandem.same_residue_runs(df, stride=stride)
        ids = [r.run_id for r in runs.collect()]
        assert len(ids) == 400 and None not in ids
        got = tandem.mnv_candidates(df) if stride == 1_000_000 else None
        if got is not None:
            assert sorted((r.gene, r.start, r.end, r.ref, r.detail) for r in got.collect()) == sorted(want)
        sizes = sorted(r["count"] for r in runs.groupBy("gene", "run_id").count().collect())
        assert sizes[-1] == max((len(w[3]) for w in want), default=1) and sum(s > 1 for s in sizes) == len(want)


def test_fisher_at_high_depth(spark):
    from helixframe.functions import fisher_exact

    def exact(a, b, c, d):
        lg = lambda n: math.lgamma(n + 1)
        base = lg(a + b) + lg(c + d) + lg(a + c) + lg(b + d) - lg(a + b + c + d)
        p = lambda x: base - lg(x) - lg(a + b - x) - lg(a + c - x) - lg(d - a + x)
        lo, hi = max(0, a - d), min(a + b, a + c)
        own = p(a)
        total = [p(x) for x in range(lo, hi + 1)]
        return min(1.0, math.fsum(math.exp(x) for x in total if x <= own + 1e-7))

    tables = [(0, 0, 0, 0), (3, 1, 1, 3), (0, 9, 9, 0), (10, 990, 40, 960), (500, 500, 520, 480), (2000, 3000, 2000, 3000), (1, 20000, 30, 20000), (0, 5000, 5000, 0), (4000, 1000, 1000, 4000)]
    df = spark.createDataFrame([(k, *t) for k, t in enumerate([*tables, (500_000, 500_000, 500_900, 499_100), (1_000_000, 0, 0, 1_000_000)])], "k int, a bigint, b bigint, c bigint, d bigint")
    got = {r.k: r.p for r in df.select("k", fisher_exact("a", "b", "c", "d").alias("p")).collect()}
    for k, t in enumerate(tables):
        assert got[k] == pytest.approx(exact(*t), rel=1e-8, abs=1e-12), t
    z = 900 / math.sqrt(500_000)  # the normal approximation, with its correction, at a depth of a million each
    assert got[len(tables)] == pytest.approx(math.erfc((900 - 1) / math.sqrt(2 * 500_000)), rel=1e-2) and z > 1 and got[len(tables) + 1] == 0.0

"""Alignment tables: tags, merge, duplicates, depth, pileups, metrics, haplotypes, spliced reads, trimming."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixframe.operators.callers import with_fisher
from helixframe.operators.relational import interval_join


def tag_read_group(reads: DataFrame, rgid: str, sample: str, library: str = "", platform: str = "ILLUMINA", unit: str = "") -> DataFrame:
    return reads.withColumns({n: F.lit(v) for n, v in (("RGID", rgid), ("RGSM", sample), ("RGLB", library), ("RGPL", platform), ("RGPU", unit))})


def coordinate_sort(reads: DataFrame, contig: str = "contig", pos: str = "pos") -> DataFrame:
    return reads.orderBy(contig, pos)


def merge_lanes(lanes: list[DataFrame], sort: bool = True) -> DataFrame:
    merged = reduce(DataFrame.unionByName, lanes)
    return coordinate_sort(merged) if sort and len(lanes) > 1 else merged


def reference_length(cigar):
    """Reference bases that a CIGAR covers."""
    counts = F.transform(F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), F.lit(1)), lambda n: n.cast("bigint"))
    return F.aggregate(counts, F.lit(0).cast("bigint"), lambda s, n: s + n)


def five_prime(pos, cigar, flag):
    """The unclipped 5' position of a read."""
    clip = lambda at: F.coalesce(F.regexp_extract(cigar, at, 1).try_cast("bigint"), F.lit(0))
    front, back = clip(r"^(?:\d+H)?(\d+)S"), clip(r"(\d+)S(?:\d+H)?$")
    return F.when(flag.bitwiseAND(F.lit(16)) != 0, pos + reference_length(cigar) - 1 + back).otherwise(pos - front)


def mark_duplicates(reads: DataFrame, quality: str = "qual_sum", keys: tuple[str, ...] = ("contig", "five_prime", "reverse"), tie: str = "name") -> DataFrame:
    """Adds ``duplicate``: all of a group but the read with the highest base quality sum (of equals the least name).

    The best of each group is found by an aggregate that merges on the map side, so a pile of copies is no hot task.
    """
    best = reads.groupBy(*keys).agg(F.min_by(tie, F.struct(F.negative(F.col(quality)), tie)).alias("_best"))
    again = F.row_number().over(Window.partitionBy(*keys, tie).orderBy(F.desc(quality)))  # rows that share a name
    return reads.join(best, list(keys)).withColumn("duplicate", (F.col(tie) != F.col("_best")) | (again > 1)).drop("_best")


#: Flag bits of a read that is unmapped, secondary or supplementary, and of the two reads of a pair.
NO_END, FIRST, SECOND = 0x4 | 0x100 | 0x800, 0x40, 0x80


def quality_sum(qual, least: int = 15):
    """Sum of a read's base qualities of at least ``least``."""
    codes = F.transform(F.split(qual, ""), lambda c: F.ascii(c) - 33)
    return F.aggregate(F.filter(codes, lambda q: q >= least), F.lit(0).cast("bigint"), lambda a, q: a + q)


def fragments(reads: DataFrame, quality: str = "qual_sum") -> DataFrame:
    """A row a name: both 5' ends (contig, five_prime, reverse) in order, the sum of qualities, and whether both reads of a pair are placed.

    One aggregate by name. ``reads`` has name, flag, contig, five_prime and reverse; secondary, supplementary and
    unmapped rows are no ends, and rows that repeat a read count once.
    """
    placed = reads.where(F.col("flag").bitwiseAND(F.lit(NO_END)) == 0)
    end, bit = F.struct("contig", "five_prime", "reverse"), lambda b: F.col("flag").bitwiseAND(F.lit(b)) != 0
    best = lambda b: F.max(F.when(bit(b), F.col(quality)))
    paired = F.count_if(bit(FIRST) & ~bit(SECOND)).alias("_first"), F.count_if(bit(SECOND) & ~bit(FIRST)).alias("_second")
    ends = placed.groupBy("name").agg(F.min(end).alias("one"), F.max(end).alias("two"), *paired, best(FIRST).alias("_q1"), best(SECOND).alias("_q2"), F.max(quality).alias("_q"))
    pair = (F.col("_first") > 0) & (F.col("_second") > 0)
    return ends.select("name", "one", F.when(pair, F.col("two")).alias("two"), pair.alias("paired"), F.when(pair, F.col("_q1") + F.col("_q2")).otherwise(F.col("_q")).alias("quality"))


def mark_fragment_duplicates(reads: DataFrame, quality: str = "qual_sum") -> DataFrame:
    """Adds ``duplicate`` by fragment: of pairs with the same two ends, and of single reads with the same end, all but the best.

    The best has the highest sum of qualities, of equals the least name; a single read at an end of any pair is a
    duplicate. All placed rows of a fragment are told alike (secondary and supplementary ones too), unmapped ones
    never, nor rows without a name. The best are found by aggregates, and singles meet pairs' ends by place, so a pile of
    copies is no hot group.
    """
    found = fragments(reads.where("name is not null"), quality)
    pairs, singles = found.where("paired"), found.where("not paired")
    best = lambda df, keys: df.groupBy(*keys).agg(F.min_by("name", F.struct(F.negative("quality"), "name")).alias("_best"))
    later = pairs.join(best(pairs, ["one", "two"]), ["one", "two"]).where("name <> _best").select("name")
    taken = pairs.select(F.explode(F.array("one", "two")).alias("one")).distinct().withColumn("_taken", F.lit(True))
    ends = best(singles, ["one"]).join(taken, "one", "left")
    alone = singles.join(ends, "one").where(F.col("_taken").isNotNull() | (F.col("name") != F.col("_best"))).select("name")
    gone = later.unionByName(alone).withColumn("_gone", F.lit(True))
    placed = F.col("flag").bitwiseAND(F.lit(4)) == 0
    return reads.join(gone, "name", "left").withColumn("duplicate", F.col("_gone").isNotNull() & placed).select(*reads.columns, "duplicate")


def duplicate_metrics(marked: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    return marked.groupBy(*keys).agg(F.count("*").alias("reads"), F.count_if("duplicate").alias("duplicates"), (F.count_if("duplicate") / F.count("*")).alias("share"))


def on_target(reads: DataFrame, intervals: DataFrame, keep: bool = True) -> DataFrame:
    """Reads (contig, start, end) that overlap an interval, or those that overlap none."""
    return interval_join(reads, intervals, how="semi" if keep else "anti")


def marked_targets(reads: DataFrame, intervals: DataFrame, into: str = "inside") -> DataFrame:
    """All reads, and in the column ``into`` whether they overlap an interval: both sides of ``on_target`` in one pass."""
    return interval_join(reads, intervals, how="mark").withColumnRenamed("hit", into)


def depth(reads: DataFrame, intervals: DataFrame | None = None, contig: str = "contig", start: str = "start", end: str = "end", stretch: int = 100_000) -> DataFrame:
    """Depth of every covered position, from events of starts and ends.

    Reads are cut at borders of stretches of the contig, so running sums are over (contig, stretch) and a hot
    contig is spread.
    """
    parts = reads.where(F.col(end) >= F.col(start)).withColumn("_s", F.explode(F.sequence(F.floor(F.col(start) / stretch), F.floor(F.col(end) / stretch))))
    lo, hi = F.greatest(F.col(start), F.col("_s") * stretch), F.least(F.col(end), (F.col("_s") + 1) * stretch - 1)
    events = parts.select(contig, "_s", F.explode(F.array(F.struct(lo.alias("position"), F.lit(1).alias("step")), F.struct((hi + 1).alias("position"), F.lit(-1).alias("step")))).alias("e"))
    steps = events.groupBy(contig, "_s", "e.position").agg(F.sum("e.step").alias("step"))
    w = Window.partitionBy(contig, "_s").orderBy("position")
    spans = steps.withColumns({"depth": F.sum("step").over(w), "next": F.lead("position").over(w)}).where("depth > 0")
    rows = spans.select(contig, F.explode(F.sequence("position", F.col("next") - 1)).alias("position"), "depth")
    if intervals is None:
        return rows
    return interval_join(rows.withColumns({"start": F.col("position"), "end": F.col("position")}), intervals, how="semi", contig=contig).drop("start", "end")


def cigar_steps(pos, cigar):
    """Array of struct(op, ref, read, n): each step of a CIGAR with its reference position and offset in the read."""
    # Both texts are read once for a CIGAR, not once for each of its steps.
    ops = F.regexp_extract_all(cigar, F.lit(r"\d+([MIDNSHP=X])"), F.lit(1))
    sizes = F.regexp_extract_all(cigar, F.lit(r"(\d+)[MIDNSHP=X]"), F.lit(1))
    pairs = F.zip_with(ops, sizes, lambda o, n: F.struct(o.alias("op"), n.cast("int").alias("n")))
    none = F.array().cast("array<struct<op:string,ref:bigint,read:int,n:int>>")
    start = F.struct(pos.cast("bigint").alias("ref"), F.lit(0).alias("read"), none.alias("steps"))

    def on(s, p):
        by = lambda letters: F.when(p["op"].isin(*letters), p["n"]).otherwise(0)
        step = F.struct(p["op"].alias("op"), s["ref"].alias("ref"), s["read"].alias("read"), p["n"].alias("n"))
        return F.struct((s["ref"] + by("M=XDN")).alias("ref"), (s["read"] + by("M=XIS")).alias("read"), F.concat(s["steps"], F.array(step)).alias("steps"))

    return F.aggregate(pairs, start, on, lambda s: s["steps"])


def haplotype(pos, cigar, seq, start, length, steps=None):
    """A read's bases at ``length`` reference positions from ``start``: * for a deletion, insertions in small letters; '' if it doesn't reach.

    ``steps``: those of the CIGAR, if they are known already.
    """
    end = start + length

    def part(s):
        lo, n = F.greatest(s["ref"], start), F.least(s["ref"] + s["n"], end) - F.greatest(s["ref"], start)
        inside = n > 0
        bases = F.when(s["op"].isin("M", "=", "X") & inside, F.substring(seq, (s["read"] + lo - s["ref"] + 1).cast("int"), n.cast("int")))
        gap = F.when((s["op"] == "D") & inside, F.repeat(F.lit("*"), n.cast("int")))
        inserted = F.when((s["op"] == "I") & (s["ref"] > start) & (s["ref"] < end), F.lower(F.substring(seq, s["read"] + 1, s["n"])))
        covered = F.when(s["op"].isin("M", "=", "X", "D") & inside, n).otherwise(0)
        return F.struct(F.coalesce(bases, gap, inserted, F.lit("")).alias("text"), covered.cast("bigint").alias("covered"))

    parts = F.transform(cigar_steps(pos, cigar) if steps is None else steps, part)
    whole = F.aggregate(parts, F.struct(F.lit("").alias("text"), F.lit(0).cast("bigint").alias("covered")), lambda a, x: F.struct(F.concat(a["text"], x["text"]).alias("text"), (a["covered"] + x["covered"]).alias("covered")))
    return F.when(whole["covered"] == length, whole["text"]).otherwise("")


def haplotype_support(candidates: DataFrame, reads: DataFrame, least: int = 3) -> DataFrame:
    """Reads of each candidate (contig, start, end, ref, alt) whose bases there are its ref or its alt; those with more than ``least`` mutant reads."""
    spans = reads.withColumns({"start": F.col("pos"), "end": F.col("pos") + reference_length(F.col("cigar")) - 1, "steps": cigar_steps(F.col("pos"), F.col("cigar"))}).select("contig", "start", "end", "steps", "seq")
    # A read's CIGAR is taken apart once, not for each candidate that it covers.
    pairs = interval_join(candidates, spans).withColumn("found", haplotype(None, None, F.col("r_seq"), F.col("start"), F.col("end") - F.col("start") + 1, F.col("r_steps")))
    counts = pairs.groupBy(*candidates.columns).agg(F.count_if(F.col("found") == F.col("ref")).alias("ref_reads"), F.count_if(F.col("found") == F.col("alt")).alias("alt_reads"))
    return counts.where(F.col("alt_reads") > least)


def near_places(reads: DataFrame, size: int = 10_000) -> DataFrame:
    """The reads, those that begin in one stretch of a contig together where Spark can: what is then counted by place meets before it is shuffled.

    A deep stretch is split between tasks.
    """
    return reads.withColumn("_stretch", F.floor(F.col("pos") / size)).hint("rebalance", "contig", "_stretch").drop("_stretch")


def read_bases(reads: DataFrame, min_quality: int = 13, marks: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """A row for each aligned base of at least the quality, and each deleted one (*): contig, position, base, quality, and what metrics need of the read (``keep``: its columns by name).

    ``marks`` adds what a pileup shows beside the base, from the CIGAR step that follows its own: ``inserted`` (letters
    after it), ``deleted`` (number of bases after it), ``head`` (the first base's mapping quality as a letter) and ``tail``.
    """
    given = reads.where("seq is not null and cigar is not null and qual is not null").select(F.struct(F.xxhash64(*reads.columns).alias("a"), F.xxhash64(F.lit(1), *reads.columns).alias("b")).alias("read_id"), "contig", "pos", "cigar", "seq", "qual", "flag", "mapq", *keep)
    steps = given.withColumn("_steps", F.filter(cigar_steps(F.col("pos"), F.col("cigar")), lambda s: ~s["op"].isin("P", "H") & (s["n"] > 0)))
    if marks:
        placed = F.filter("_steps", lambda s: s["op"].isin("M", "=", "X", "D"))
        steps = steps.withColumns({"_from": placed[0]["ref"], "_to": F.element_at(placed, -1)["ref"] + F.element_at(placed, -1)["n"] - 1})
        steps = steps.withColumn("_steps", F.transform("_steps", lambda s, k: F.struct(s["op"].alias("op"), s["ref"].alias("ref"), s["read"].alias("read"), s["n"].alias("n"), F.get("_steps", k + 1).alias("next"))))
    # Spark would filter the arrays of an inner explode first, and work them out a second time for that.
    steps = steps.withColumn("_s", F.explode_outer("_steps")).drop("_steps").where(F.col("_s.op").isin("M", "=", "X", "D"))
    rows = steps.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_s.n") - 1)))
    gap, at = F.col("_s.op") == "D", F.col("_s.read") + F.col("_i")
    code, reverse, n = F.ascii(F.substring("qual", at + 1, F.lit(1))), F.col("flag").bitwiseAND(F.lit(16)) != 0, F.length("seq")
    quality = F.when(gap | (code == 0), 0).otherwise(code - 33)
    place = at / F.greatest(n - 1, F.lit(1))
    position = F.col("_s.ref") + F.col("_i")
    values = {
        "position": position, "base": F.when(gap, "*").otherwise(F.upper(F.substring("seq", at + 1, F.lit(1)))), "quality": quality, "reverse": reverse,
        "read_pos": F.when(gap, 0.0).otherwise(1 - F.abs(2 * place - 1)), "read_len": n, "dist3": F.when(gap, 0.0).when(reverse, place).otherwise(1 - place),
    }
    if marks:
        last, follows = F.col("_i") == F.col("_s.n") - 1, F.col("_s.next.op")
        values |= {
            "inserted": F.when(last & (follows == "I"), F.upper(F.substring("seq", F.col("_s.next.read") + 1, F.col("_s.next.n")))).otherwise(""),
            "deleted": F.when(last & (follows == "D") & ~gap, F.col("_s.next.n")).otherwise(0),
            "head": F.when(position == F.col("_from"), F.char(F.least(F.coalesce("mapq", F.lit(0)) + 33, F.lit(126)))).otherwise(""), "tail": position == F.col("_to"),
        }
    return rows.where(gap | (quality >= min_quality)).select("read_id", "contig", "mapq", *keep, *(v.alias(k) for k, v in values.items()))


def deleted_letters(deletions: DataFrame, reference: DataFrame) -> DataFrame:
    """contig, position, deleted and letters: the reference bases after each distinct (contig, position, deleted); N where none is given."""
    one = deletions.select("contig", "position", "deleted").where("deleted > 0").distinct()
    places = one.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("deleted")))).withColumn("_at", F.col("position") + F.col("_i"))
    bases = reference.select(F.col("contig").alias("_c"), F.col("position").alias("_p"), F.upper("ref").alias("_ref"))
    found = places.join(bases, (F.col("contig") == F.col("_c")) & (F.col("_at") == F.col("_p")), "left")
    letters = F.sort_array(F.collect_list(F.struct("_i", F.coalesce("_ref", F.lit("N")).alias("_ref"))))
    return found.groupBy("contig", "position", "deleted").agg(F.array_join(F.transform(letters, lambda x: x["_ref"]), "").alias("letters"))


def deepest(counted: DataFrame, order: list, most: int, salts: int = 16) -> DataFrame:
    """Of rows that stand for ``n`` bases of a locus, those that hold its first ``most`` bases in the order, ``n`` cut to fit.

    First within (locus, salt), then within the locus. A row has a base at least, so ranks beyond ``most`` are
    dropped before either shuffle, and no task holds more than ``most`` rows a locus and salt.
    """
    columns = counted.columns
    out = counted.withColumn("_salt", F.pmod(F.xxhash64(*(c for c in columns if c not in ("contig", "position", "n"))), F.lit(salts)))
    for keys in (["contig", "position", "_salt"], ["contig", "position"]):
        w = Window.partitionBy(*keys).orderBy(*order)
        out = out.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= most)
        out = out.withColumn("_before", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).where(F.col("_before") < most)
    return out.withColumn("n", F.least(F.col("n"), most - F.col("_before"))).select(columns)


def build_pileup(reads: DataFrame, reference: DataFrame, min_quality: int = 13, max_depth: int | None = None, count_orphans: bool = False, marks: bool = True, base_alignment_quality: bool = True) -> DataFrame:
    """Pileup lines of reads against reference bases (contig, position, ref); unpaired reads only if asked for.

    All bases are kept, the best quality first; ``max_depth``, if given, keeps the first of them. With ``marks`` lines
    show insertions and deletions after the base before them, and where reads begin and end. Qualities are lowered by
    base alignment quality first, unless switched off. Equal bases of a locus are counted before anything is collected,
    so a line is put together from its distinct ones, and the reference is joined by locus, not by base.
    """
    from helixframe.operators.realign import lower_qualities

    usable = reads.where(F.col("flag").bitwiseAND(F.lit(4)) == 0)
    usable = usable if count_orphans else usable.where((F.col("flag").bitwiseAND(F.lit(1)) == 0) | (F.col("flag").bitwiseAND(F.lit(2)) != 0))
    usable = lower_qualities(usable, reference) if base_alignment_quality else usable
    order = ["base", "reverse", *(("inserted", "deleted", "head", "tail") if marks else ())]
    counted = read_bases(usable, min_quality, marks).groupBy("contig", "position", F.negative("quality").alias("_q"), *order).agg(F.count("*").alias("n"))
    counted = deepest(counted, ["_q", *order], max_depth) if max_depth else counted
    lines = counted.groupBy("contig", "position").agg(F.sum("n").cast("int").alias("depth"), F.sort_array(F.collect_list(F.struct("_q", *order, "n"))).alias("_l"))
    lines = lines.join(reference.select("contig", "position", "ref"), ["contig", "position"])
    cased = lambda x, text: F.when(x["reverse"], F.lower(text)).otherwise(F.upper(text))
    if marks:
        gone = deleted_letters(counted, reference).groupBy("contig", "position").agg(F.map_from_entries(F.collect_list(F.struct("deleted", "letters"))).alias("_gone"))
        lines = lines.join(gone, ["contig", "position"], "left")

    def symbol(x):
        own = F.when(x["base"] == "*", "*").when(x["base"] == F.upper("ref"), F.when(x["reverse"], ",").otherwise(".")).otherwise(cased(x, x["base"]))
        if not marks:
            return own
        inserted = F.when(x["inserted"] != "", F.concat(F.lit("+"), F.length(x["inserted"]).cast("string"), cased(x, x["inserted"]))).otherwise("")
        deleted = F.when(x["deleted"] > 0, F.concat(F.lit("-"), x["deleted"].cast("string"), cased(x, F.col("_gone")[x["deleted"]]))).otherwise("")
        return F.concat(F.when(x["head"] != "", F.concat(F.lit("^"), x["head"])).otherwise(""), own, inserted, deleted, F.when(x["tail"], "$").otherwise(""))

    text = lambda item: F.array_join(F.transform("_l", lambda x: F.repeat(item(x), x["n"].cast("int"))), "")
    return lines.select("contig", "position", "ref", "depth", text(symbol).alias("bases"), text(lambda x: F.char(33 - x["_q"])).alias("quals"))


def _with_places(reads: DataFrame, positions: DataFrame, reference: DataFrame | None, min_quality: int) -> DataFrame:
    """Reads that may cover one of the positions, with these as a text (``_listed``, a blank where none is) from ``_begins`` on, and the summed qualities of their mismatches."""
    from helixframe.operators.realign import LEVEL, reference_texts

    usable = reads.where("pos is not null and cigar is not null")
    level = F.greatest(F.lit(LEVEL), F.ceil(F.log2(F.greatest(reference_length(F.col("cigar")), F.lit(1))))).cast("int")
    levels = usable.select(level.alias("level")).agg(F.collect_set("level")).scalar()
    key = ["contig", "_level", "_bin"]
    texts = lambda bases, text, begins: reference_texts(bases, levels, " ").select("contig", F.col("level").alias("_level"), F.col("bin").alias("_bin"), F.col("text").alias(text), F.col("begins").alias(begins))
    placed = usable.withColumn("_level", level).withColumn("_bin", F.floor(F.col("pos") / F.pow(F.lit(2), F.col("_level"))).cast("bigint"))

    def part(text, begins):
        """What the read covers of its stretch's text, letter by letter from its first position on."""
        first = F.greatest("pos", begins)
        covered = F.substring(text, (first - F.col(begins) + 1).cast("int"), reference_length(F.col("cigar")).cast("int"))
        return F.concat(F.repeat(F.lit(" "), (first - F.col("pos")).cast("int")), covered)

    def signs(bases):
        """One sign a position: its letter, a dot if it has none, a wave if that is no base's equal, such as two different letters."""
        one = bases.groupBy("contig", "position").agg(F.min(F.upper("ref")).alias("_least"), F.max(F.upper("ref")).alias("_most"))
        plain = (F.col("_least") == F.col("_most")) & (F.length("_least") == 1) & ~F.col("_least").isin(".", " ")
        return one.select("contig", "position", F.when(F.col("_least").isNull(), ".").when(plain, F.col("_least")).otherwise("~").alias("ref"))

    # A merge has reads of one stretch meet in a task, so that what is counted there is hardly shuffled again.
    given = signs(positions) if reference is positions else positions.select("contig", "position", F.lit(".").alias("ref")).distinct()
    listed = placed.join(texts(given, "_listed", "_begins").hint("merge"), key).withColumn("_listed", part("_listed", "_begins"))
    if reference is None:
        return listed.withColumns({"_begins": F.col("pos"), "mismatches": F.lit(None).cast("double")}).drop("_level", "_bin")
    if reference is positions:
        joined = listed.withColumn("_ref", F.col("_listed"))
    else:
        joined = listed.join(texts(signs(reference), "_ref", "_from").hint("merge"), key, "left").withColumn("_ref", part("_ref", "_from"))

    def differing(total, s):
        base, qual = (F.substring(c, s["read"] + 1, s["n"]) for c in ("seq", "qual"))
        base, ref = F.upper(base), F.substring("_ref", (s["ref"] - F.col("pos") + 1).cast("int"), s["n"])
        differs = F.zip_with(F.split(base, ""), F.split(ref, ""), lambda x, r: (F.coalesce(x, F.lit("")) != r) & (F.coalesce(x, F.lit("")) != "*") & ~r.isin("", " ", "."))
        codes = F.transform(F.split(qual, ""), lambda c: F.ascii(c) - 33)
        sums = F.zip_with(differs, codes, lambda d, q: F.when(d & (F.greatest(q, F.lit(0)) >= min_quality), F.greatest(q, F.lit(0))).otherwise(0))
        return F.when(base == ref, total).otherwise(F.aggregate(sums, total, lambda t, q: t + q))

    steps = F.filter(cigar_steps(F.col("pos"), F.col("cigar")), lambda s: s["op"].isin("M", "=", "X") & (s["n"] > 0))
    mismatches = F.when(F.col("_ref").isNull(), 0).otherwise(F.aggregate(steps, F.lit(0), differing)).cast("double")
    return joined.withColumns({"_begins": F.col("pos"), "mismatches": mismatches}).drop("_level", "_bin", "_ref", "_from")


def allele_metrics(reads: DataFrame, positions: DataFrame, min_quality: int = 0, reference: DataFrame | None = None, indels: bool = False) -> DataFrame:
    """Per-allele read metrics at listed positions.

    With ``indels``, what follows a base is an allele of its own too (+2AC, -1T, deleted letters from the reference),
    with the metrics of the base before it.

    ``mmqs`` is the mean over an allele's reads of the summed qualities of their mismatches, against ``reference``
    (contig, position, ref), or against ``positions`` where they have a ref; null without either. No base is shuffled:
    listed positions and reference bases come to the reads as texts of stretches, and what reads of a stretch share is
    counted there.
    """
    reference = positions if reference is None and "ref" in positions.columns else reference
    bases = read_bases(_with_places(reads, positions, reference, min_quality), min_quality, marks=indels, keep=("mismatches", "_listed", "_begins"))
    at = F.col("position") - F.col("_begins")
    rows = bases.where((at >= 0) & ~F.substring("_listed", (at + 1).cast("int"), F.lit(1)).isin("", " ")).drop("_listed", "_begins")
    named = rows.withColumn("allele", F.col("base"))
    if indels:
        letters = deleted_letters(rows, reference if reference is not None else rows.select("contig", "position", F.lit("N").alias("ref")).where("false"))
        longer = rows.where("inserted <> ''").withColumn("allele", F.concat(F.lit("+"), F.length("inserted").cast("string"), F.col("inserted")))
        shorter = rows.where("deleted > 0").join(letters, ["contig", "position", "deleted"]).withColumn("allele", F.concat(F.lit("-"), F.col("deleted").cast("string"), F.col("letters")))
        named = named.unionByName(longer).unionByName(shorter.select(named.columns))
    rows = named
    means = {"mapq": "mapq", "basequal": "quality", "readpos": "read_pos", "mmqs": "mismatches", "readlen": "read_len", "dist3": "dist3"}
    return rows.groupBy("contig", "position", "allele").agg(F.count("*").cast("double").alias("count"), *(F.avg(c).alias(n) for n, c in means.items()), F.count_if(~F.col("reverse")).cast("double").alias("plus"), F.count_if("reverse").cast("double").alias("minus"))


def classify_pairs(tumor: DataFrame, normal: DataFrame, min_tumor_frequency: float = 0.05, homozygous: float = 0.75, max_p: float = 0.05, purity: float = 1.0, sure_tumor: float = 0.1, sure_normal: float = 0.05, sure_p: float = 0.07) -> DataFrame:
    """Germline, LOH, Somatic or Reference for each tumour allele (contig, position, ref, allele, count, coverage), by frequencies and Fisher's test.

    ``high_confidence``: a tumour frequency of at least ``sure_tumor`` with p of at most ``sure_p`` and, for somatic
    alleles, a normal frequency of at most ``sure_normal``.
    """
    n = normal.select("contig", "position", "allele", F.col("count").alias("normal_supporting"))
    depth = normal.groupBy("contig", "position").agg(F.max("coverage").alias("normal_depth"))
    t = tumor.where(F.col("allele") != F.upper("ref")).select("contig", "position", "ref", "allele", F.col("count").alias("tumor_supporting"), F.col("coverage").alias("tumor_depth"))
    rows = t.join(depth, ["contig", "position"]).join(n, ["contig", "position", "allele"], "left").withColumn("normal_supporting", F.coalesce("normal_supporting", F.lit(0)))
    tf = F.try_divide(F.try_divide("tumor_supporting", "tumor_depth"), F.lit(purity))
    nf = F.try_divide("normal_supporting", "normal_depth")
    tested = with_fisher(rows, complement=True).withColumns({"tumor_frequency": tf, "normal_frequency": nf})
    differs, in_tumor, in_normal = F.col("pvalue") <= max_p, F.col("tumor_frequency") >= min_tumor_frequency, F.col("normal_frequency") >= min_tumor_frequency
    genotype = lambda c: F.when(F.col(c) >= homozygous, "hom").when(F.col(c) >= min_tumor_frequency, "het").otherwise("ref")
    status = F.when(~in_tumor & ~in_normal, "Reference").when(in_tumor & ~in_normal & differs, "Somatic").when(in_normal & differs & (genotype("normal_frequency") == "het") & (genotype("tumor_frequency") != "het"), "LOH").otherwise("Germline")
    sure = (F.col("tumor_frequency") >= sure_tumor) & (F.col("pvalue") <= sure_p) & ((status != "Somatic") | (F.col("normal_frequency") <= sure_normal))
    return tested.withColumns({"tumor_genotype": genotype("tumor_frequency"), "normal_genotype": genotype("normal_frequency"), "status": status, "high_confidence": sure})


def split_spliced(reads: DataFrame, from_mapq: int = 255, to_mapq: int = 60) -> DataFrame:
    """One row for each block between N steps of a CIGAR; an unknown mapping quality gets a value."""
    mapped = reads.withColumn("mapq", F.when(F.col("mapq") == from_mapq, to_mapq).otherwise(F.col("mapq")).cast(dict(reads.dtypes)["mapq"]))
    steps = cigar_steps(F.col("pos"), F.col("cigar"))
    cuts = F.concat(F.array(F.lit(-1)), F.filter(F.transform(F.col("_s"), lambda s, i: F.when(s["op"] == "N", i)), lambda i: i.isNotNull()), F.array(F.size("_s")))
    blocks = F.transform(F.sequence(F.lit(0), F.size("_c") - 2), lambda k: F.filter("_s", lambda s, i: (i > F.get("_c", k)) & (i < F.get("_c", k + 1))))
    spliced = mapped.where(F.col("cigar").contains("N")).withColumn("_s", steps).withColumn("_c", cuts).withColumn("_b", F.explode(F.filter(blocks, lambda b: F.size(b) > 0)))
    first, last = F.col("_b")[0], F.element_at("_b", -1)
    size = last["read"] + F.when(last["op"].isin("M", "=", "X", "I", "S"), last["n"]).otherwise(0) - first["read"]
    new = {"pos": first["ref"], "cigar": F.array_join(F.transform("_b", lambda s: F.concat(s["n"].cast("string"), s["op"])), ""), "seq": F.substring("seq", first["read"] + 1, size), "qual": F.substring("qual", first["read"] + 1, size)}
    cut = spliced.select(*(new[f.name].cast(f.dataType).alias(f.name) if f.name in new else F.col(f.name) for f in reads.schema))
    return mapped.where(~F.col("cigar").contains("N") | F.col("cigar").isNull()).unionByName(cut)


#: The offset of each quality scale.
SCALES = {"sanger": 33, "solexa": 64, "illumina": 64}


def trim_cuts(df: DataFrame, qual: str, into: str, offset: int = 33, min_mean: float = 20, min_length: int = 20) -> DataFrame:
    """Adds ``into``, a struct of start and end: the stretch of qualities kept by sliding windows of a tenth of the read.

    It goes from the first good quality of the first window with a good mean to the first bad one of the next window
    without; (0, 0) if too short. Window sums are differences of running sums.
    """
    q = F.transform(F.filter(F.split(F.col(qual), ""), lambda c: c != ""), lambda c: (F.ascii(c) - offset).cast("double"))
    df = df.withColumn("_q", F.coalesce(q, F.array().cast("array<double>"))).withColumn("_n", F.greatest(F.floor(F.size("_q") / 10).cast("int"), F.lit(1)))
    sums = F.aggregate("_q", F.array(F.lit(0.0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    windows = F.when(F.size("_q") > 0, F.sequence(F.lit(0), F.size("_q") - F.col("_n"))).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("_sums", sums).withColumn("_good", F.transform(windows, lambda k: (F.get("_sums", k + F.col("_n")) - F.get("_sums", k)) / F.col("_n") >= min_mean))
    first = F.array_position("_good", True) - 1
    df = df.withColumn("_first", first.cast("int")).withColumn("_bad", F.when(F.col("_first") >= 0, F.array_position(F.slice("_good", F.col("_first") + 1, F.greatest(F.size("_good") - F.col("_first"), F.lit(0))), False)).otherwise(0).cast("int"))
    within = lambda at, hit: F.array_position(F.transform(F.slice("_q", at + 1, F.col("_n")), hit), True)
    start = F.col("_first") + F.greatest(within(F.greatest(F.col("_first"), F.lit(0)), lambda x: x >= min_mean) - 1, F.lit(0))
    stop = F.col("_first") + F.col("_bad") - 1  # the first window without a good mean
    end = F.when(F.col("_bad") > 0, stop + F.greatest(within(F.greatest(stop, F.lit(0)), lambda x: x < min_mean) - 1, F.lit(0))).otherwise(F.size("_q"))
    kept = (F.col("_first") >= 0) & (end - start >= min_length)
    cut = F.struct(F.when(kept, start).otherwise(0).cast("int").alias("start"), F.when(kept, end).otherwise(0).cast("int").alias("end"))
    return df.withColumn(into, cut).drop("_q", "_n", "_sums", "_good", "_first", "_bad")


def trim_pairs(pairs: DataFrame, scale: str = "sanger", min_mean: float = 20, min_length: int = 20) -> DataFrame:
    """Pairs (name, seq1, qual1, seq2, qual2) trimmed, and their route: pe, single1, single2 or dropped."""
    out = pairs
    for k in "12":
        out = trim_cuts(out, f"qual{k}", f"c{k}", SCALES[scale], min_mean, min_length)
        for c in ("seq", "qual"):
            out = out.withColumn(f"{c}{k}", F.substring(F.col(f"{c}{k}"), F.col(f"c{k}.start") + 1, F.col(f"c{k}.end") - F.col(f"c{k}.start")))
    one, two = F.coalesce(F.length("seq1"), F.lit(0)) > 0, F.coalesce(F.length("seq2"), F.lit(0)) > 0
    return out.withColumn("route", F.when(one & two, "pe").when(one, "single1").when(two, "single2").otherwise("dropped")).drop("c1", "c2")

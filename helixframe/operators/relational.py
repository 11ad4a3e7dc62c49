"""Operators of no particular table: last wins, priority union, interval joins, checks of order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ["contig", "position", "ref", "alt"]


def last_wins(df: DataFrame, keys: list[str], ord: str = "ord", near: list[str] | None = None) -> DataFrame:
    """The row with the greatest ordinal of each key; of equal ones the greatest by its other columns.

    One aggregate: rows meet on the map side first. That sorts all rows of a task's input, as a struct is the
    aggregate's buffer. ``near``, some of the keys, has rows shuffled by these first: they are sorted once, in the
    shuffle's smaller parts, and what groups by these keys next needs no shuffle. For keys with few rows each.
    """
    df = df.repartition(*near) if near else df
    rest = [c for c in df.columns if c not in keys]
    ordered = [c for c, t in df.dtypes if c in rest and c != ord and "map<" not in t]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(ord, *ordered)).alias("_last"))
    return best.select(*keys, "_last.*").select(df.columns)


def priority_union(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """One row a key: that of the first frame that has it."""
    ranked = [f.withColumn("_priority", F.lit(-k)) for k, f in enumerate(frames)]
    return last_wins(reduce(DataFrame.unionByName, ranked), keys, "_priority").drop("_priority")


def gather(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Union of partial results; of equal keys the later frame's row stays."""
    return priority_union(frames[::-1], keys)


def interval_join(left: DataFrame, right: DataFrame, bin_size: int = 1000, how: str = "inner", contig: str = "contig", start: str = "start", end: str = "end", fan: int = 8) -> DataFrame:
    """Pairs of closed intervals that overlap; right columns get the prefix r_.

    Bins are hierarchical: ``bin_size`` bases, then ``fan`` times as many a level. An interval lies in the one or two
    bins of its own level (the first whose bins are as long as it is) and, for longer partners, in those of higher
    levels that occur on the other side; so a contig-long interval is a row or two, and none is copied more often than
    twice a level. An equi-join on (contig, level, bin) follows. A pair counts at the higher of its two levels, in the
    bin of its overlap's start, so no distinct is needed. ``semi`` and ``anti`` keep left rows with and without a
    partner, by their contig, start and end; ``mark`` keeps all, and says in the column hit which has one. Rows with a
    null there have no partner; an interval that ends before it starts overlaps what covers both.
    """
    if how in ("semi", "anti", "mark"):
        places = left.select(contig, start, end).distinct()
        hit = interval_join(places, right.select(contig, start, end).distinct(), bin_size, "inner", contig, start, end, fan).select(contig, start, end).distinct()
        if how == "mark":
            return left.join(hit.withColumn("hit", F.lit(True)), [contig, start, end], "left").select(*left.columns, F.coalesce("hit", F.lit(False)).alias("hit"))
        return left.join(hit, [contig, start, end], f"left_{how}").select(left.columns)

    def level(s: str, e: str) -> Column:
        """0 for intervals of at most bin_size bases, and so on; corrected by comparison, as logarithms round."""
        size = F.greatest(F.col(e) - F.col(s) + 1, F.lit(1))
        guess = F.greatest(F.ceil(F.log(size / F.lit(bin_size)) / F.log(F.lit(float(fan)))), F.lit(0)).cast("int")
        return guess + F.when(size > width(guess), 1).otherwise(0)

    def width(k: Column) -> Column:
        return (F.lit(bin_size) * F.round(F.pow(F.lit(float(fan)), k))).cast("bigint")

    r = right.select(*(F.col(c).alias(f"r_{c}") for c in right.columns))
    whole = lambda df, s, e: df.where(F.col(s).isNotNull() & F.col(e).isNotNull())
    sides = (whole(left, start, end), start, end), (whole(r, f"r_{start}", f"r_{end}"), f"r_{start}", f"r_{end}")
    # The levels of a side are an array of a few numbers, found in a subquery.
    occur = [df.select(level(s, e).alias("k")).agg(F.collect_set("k")).scalar() for df, s, e in sides]

    def binned(df: DataFrame, s: str, e: str, others: Column, prefix: str) -> DataFrame:
        out = df.withColumn(f"{prefix}own", level(s, e)).withColumn("_others", others)
        out = out.withColumn(f"{prefix}level", F.explode(F.array_union(F.array(f"{prefix}own"), F.filter("_others", lambda k: k > F.col(f"{prefix}own"))))).drop("_others")
        size, last = width(F.col(f"{prefix}level")), F.greatest(F.col(e), F.col(s))
        return out.withColumn(f"{prefix}bin", F.explode(F.sequence(F.floor(F.col(s) / size), F.floor(last / size))))

    one, two = binned(*sides[0], occur[1], "_l"), binned(*sides[1], occur[0], "_r")
    same = (F.col(contig) == F.col(f"r_{contig}")) & (F.col("_llevel") == F.col("_rlevel")) & (F.col("_lbin") == F.col("_rbin"))
    overlap = (F.col(start) <= F.col(f"r_{end}")) & (F.col(f"r_{start}") <= F.col(end)) & (F.greatest("_lown", "_rown") == F.col("_llevel"))
    first = F.floor(F.greatest(F.col(start), F.col(f"r_{start}")) / width(F.col("_llevel"))) == F.col("_lbin")
    return one.join(two, same & overlap & first).drop("_lown", "_llevel", "_lbin", "_rown", "_rlevel", "_rbin")


def contig_order_conflicts(one: DataFrame, two: DataFrame, contig: str = "contig", ord: str = "ord") -> DataFrame:
    """Neighbouring shared contigs that come in another order in the second input; empty if both agree."""
    a = one.groupBy(contig).agg(F.min(ord).alias("a"))
    b = two.groupBy(contig).agg(F.min(ord).alias("b"))
    shared = a.join(b, contig)  # one row a contig
    w = Window.orderBy("a")
    return shared.withColumns({"before": F.lag(contig).over(w), "b_before": F.lag("b").over(w)}).where("b < b_before").select("before", contig)


def only_in_one(one: DataFrame, two: DataFrame, column: str = "contig") -> DataFrame:
    """Values of a column that only one input has, and which."""
    a, b = one.select(column).distinct(), two.select(column).distinct()
    return a.join(b, column, "left_anti").withColumn("only_in", F.lit("first")).unionByName(b.join(a, column, "left_anti").withColumn("only_in", F.lit("second")))


def text_order(df: DataFrame, columns: list[str | int], joined: bool = False) -> DataFrame:
    """Rows by the texts of columns (names, or places from 1), one after another, or ``joined`` by tabs as one text."""
    texts = [F.col(f"`{df.columns[c - 1] if isinstance(c, int) else c}`").cast("string") for c in columns]
    return df.orderBy(F.concat_ws("\t", *texts)) if joined else df.orderBy(*texts)


def keyword_rows(df: DataFrame, word: str, column: str = "value", reject: bool = True, judgement: str | None = None) -> DataFrame:
    """Rows without (or with) a keyword; a judgement column is compared as a whole where there is one."""
    hit: Column = F.coalesce(F.col(judgement) == word, F.lit(False)) if judgement in df.columns else F.coalesce(F.col(column).contains(word), F.lit(False))
    return df.where(~hit if reject else hit)


def flag_rows(df: DataFrame, require: int = 0, exclude: int = 0, flag: str = "flag") -> DataFrame:
    """Alignments with one flag bit, without another; each is a power of two, or 0 for no test."""
    for bit in (require, exclude):
        if bit and bit & (bit - 1):
            raise ValueError(f"{bit} is not one flag bit")
    out = df.where(F.col(flag).bitwiseAND(F.lit(require)) != 0) if require else df
    return out.where(F.col(flag).bitwiseAND(F.lit(exclude)) == 0) if exclude else out

"""How far each source of a language is from the others: an audit by counts of terms.

1. Each partition counts terms, and the documents that have them, by (lang, source); sums merge on the way.
2. Terms in enough documents of their language are kept. Shares are smoothed and floored in decimals, so exact.
3. Part ``term``: a group's terms fall into cells (count in the group, count in the language). The difference of
   shares is worked out once a cell; cells of one value merge, values are ranked with their number of terms added
   up, and only those that reach the wanted ranks are expanded to terms, in UTF-8 order.
4. Part ``pair``: a sum over all kept terms falls apart into what the terms of one source alone give, which follows
   from its cells, and a correction for terms that both have. Tasks add up the corrections of their terms as
   matrices of sources, so no pair of sources is emitted for a term.

Defined results: null text, lang or source are read as ''; a group without terms has a row for each other source
of its language, and each pair is 0 where no term is kept; repeated rows count as often as they come; values that
tie are ranked by the item's bytes; other columns, whatever their names, are not read; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.llm.common import materialize, slices

#: A term, in UTF-8: no ASCII but letters. Bytes of other characters are all over 0x7F.
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
#: Terms that a task counts before it passes them on, and terms of a matrix block.
HELD_TERMS, BLOCK_TERMS = 300_000, 4_096
_COUNTED = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents with it)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        added = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, d) in groups.items():
                terms = pa.array(list(n), pa.binary()).cast(pa.string())
                same = lambda x, k=len(n): pa.array([x] * k, pa.string())
                yield pa.RecordBatch.from_arrays([same(lang), same(source), terms, pa.array(n.values(), pa.int64()), pa.array([d[t] for t in n], pa.int64())], schema=_COUNTED)
            groups.clear()

        for part in slices(batches, "text"):
            for lang, source, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                terms = TERM.findall(text.encode().lower())  # of bytes, lower() knows A to Z only
                if terms:
                    n, d = groups.setdefault((lang, source), (Counter(), Counter()))
                    before = len(n)
                    n.update(terms)
                    d.update(set(terms))
                    added += len(n) - before
                    if added > HELD_TERMS:
                        yield from flush()
                        added = 0
        yield from flush()

    given = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    return given.mapInArrow(count, "lang string, source string, term string, n bigint, docs bigint").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _corrections(by_term: DataFrame) -> DataFrame:
    """(lang, a, b, part) of sources a < b: what the terms that both have add beyond what each adds alone."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[dict[str, int], list[int]]] = {}  # numbers and zero shares of a language's sources
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_TERMS):
                part = batch.slice(at, BLOCK_TERMS)
                langs = part.column(0).to_pylist()
                rows: dict[str, list[list[dict]]] = {}
                for lang, shares in zip(langs, part.column(1).to_pylist(), strict=True):
                    rows.setdefault(lang, []).append(shares)
                for lang, terms in rows.items():
                    numbers, zero = known.setdefault(lang, ({}, []))
                    for s in (s for shares in terms for s in shares):
                        if s["source"] not in numbers:
                            numbers[s["source"]] = len(zero)
                            zero.append(s["zero"])
                    z = np.array(zero, np.int64)
                    p = np.tile(z, (len(terms), 1))
                    for k, shares in enumerate(terms):
                        for s in shares:
                            p[k, numbers[s["source"]]] = s["p"]
                    old, total = sums.get(lang), np.zeros((len(z), len(z)), np.int64)
                    if old is not None:
                        total[: len(old), : len(old)] = old
                    apart = np.abs(z[:, None] - z[None, :])
                    for a in range(len(z)):
                        own = p[:, a : a + 1]
                        total[a] += (np.abs(own - p) - np.abs(own - z) - np.abs(z[a] - p) + apart[a]).sum(axis=0)
                    sums[lang] = total
        for lang, total in sums.items():
            names = list(known[lang][0])
            for k, a in enumerate(names):
                others = [j for j, b in enumerate(names) if a.encode() < b.encode() and total[k, j]]
                if others:
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(others)), pa.array([a] * len(others)), pa.array([names[j] for j in others]), pa.array(total[k, others])], ["lang", "a", "b", "part"])

    parts = by_term.mapInArrow(add, "lang string, a string, b string, part bigint")
    return parts.groupBy("lang", "a", "b").agg(F.sum("part").alias("both"))


def audit(docs: DataFrame, least_docs: int = 30, ranks: int = 50, scale: int = 10**9, smooth: int = 5) -> DataFrame:
    """lang, source, part, item, value, rank: the distance of each group (lang, source) from the language's other
    sources (part ``pair``), and the terms it uses more than its language does (part ``term``, up to ``ranks``)."""

    def share(n: str, total: str, name: str) -> Column:
        over = f"cast({scale} as decimal(12,0)) * cast({n} + {smooth} as decimal(20,0))"
        return F.expr(f"1 + ({over} div cast({total} + {smooth} * n_terms as decimal(22,0)))").alias(name)

    counts = materialize(term_counts(docs), "term-counts")
    terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("_docs")).where(F.col("_docs") >= least_docs).drop("_docs")
    kept = materialize(counts.join(terms, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "kept-terms")
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # A language's terms are counted through its terms' first sources, as each is in one source at least.
    langs = kept.groupBy("lang", "term").agg(F.max("lang_n").alias("lang_n")).groupBy("lang").agg(F.count("*").alias("n_terms"), F.sum("lang_n").alias("lang_total"))
    groups = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    groups = groups.join(own, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "lang_total", "n_terms"])
    groups = materialize(groups, "groups")
    with_terms = groups.where("n_terms > 0")

    cells = kept.groupBy("lang", "source", "n", "lang_n").agg(F.count("*").alias("m"))
    cells = cells.join(with_terms, ["lang", "source"]).select("lang", "source", "n", "lang_n", "m", share("n", "total", "p"), share("lang_n", "lang_total", "q"), share("0", "total", "zero"))
    cells = materialize(cells, "cells")

    over = cells.where("p > q").withColumn("value", F.col("p") - F.col("q"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    values = over.groupBy("lang", "source", "value").agg(F.sum("m").alias("m"))
    # A value has a term at least, so no more values than ranks matter; the rest goes before the shuffle.
    best = values.withColumn("_k", F.row_number().over(ranked)).where(F.col("_k") <= ranks)
    best = best.withColumn("_before", F.sum("m").over(ranked.rowsBetween(Window.unboundedPreceding, 0)) - F.col("m")).where(F.col("_before") < ranks)
    wanted = over.join(best.select("lang", "source", "value", "_before"), ["lang", "source", "value"]).select("lang", "source", "n", "lang_n", "value", "_before")
    same = Window.partitionBy("lang", "source", "value").orderBy("term")
    found = kept.join(wanted, ["lang", "source", "n", "lang_n"]).withColumn("_k", F.row_number().over(same)).where(F.col("_k") <= ranks)
    found = found.withColumn("rank", (F.col("_before") + F.col("_k")).cast("int")).where(F.col("rank") <= ranks)
    term_part = found.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")

    zeros = groups.select("lang", "source", "n_terms", F.when(F.col("n_terms") > 0, share("0", "total", "zero")).otherwise(0).alias("zero"))
    pairs = zeros.select("lang", "n_terms", F.col("source").alias("a"), F.col("zero").alias("za")).join(zeros.select("lang", F.col("source").alias("b"), F.col("zero").alias("zb")), "lang").where("a <> b")
    shares = cells.groupBy("lang", F.col("source").alias("a"), "p").agg(F.sum("m").alias("m"))
    alone = shares.join(pairs, ["lang", "a"]).groupBy("lang", "a", "b").agg(F.sum(F.col("m") * (F.abs(F.col("p") - F.col("zb")) - F.abs(F.col("za") - F.col("zb")))).alias("alone"))
    cell_shares = cells.select("lang", "source", "n", "lang_n", "p", "zero")
    by_term = kept.join(cell_shares, ["lang", "source", "n", "lang_n"]).groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "zero")).alias("shares"))
    both = _corrections(by_term.where(F.size("shares") > 1).select("lang", "shares"))
    both = both.unionByName(both.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "both"))
    mirrored = alone.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), F.col("alone").alias("mirrored"))
    summed = pairs.join(alone, ["lang", "a", "b"], "left").join(mirrored, ["lang", "a", "b"], "left").join(both, ["lang", "a", "b"], "left").fillna(0, ["alone", "mirrored", "both"])
    value = F.col("n_terms") * F.abs(F.col("za") - F.col("zb")) + F.col("alone") + F.col("mirrored") + F.col("both")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair_part = summed.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), value.alias("value")).withColumn("rank", F.row_number().over(order))
    return pair_part.unionByName(term_part)

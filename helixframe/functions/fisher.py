"""Fisher's exact test as a Catalyst expression."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from helixframe.functions.binding import let


#: Logarithms of the factorials of 0 to 15; beyond, the series of Stirling is exact to the last digit.
_LOG_FACTORIALS = [math.lgamma(n + 1) for n in range(16)]


def log_factorial(n: Column) -> Column:
    m = F.greatest(n, F.lit(1.0))
    series = m * F.log(m) - m + 0.5 * F.log(2 * math.pi * m) + 1 / (12 * m) - 1 / (360 * m * m * m) + 1 / (1260 * m * m * m * m * m)
    return F.when(n < 16, F.get(F.array(*map(F.lit, _LOG_FACTORIALS)), n.cast("int"))).otherwise(series)


def fisher_exact(a, b, c, d) -> Column:
    """Two-sided p of the table [[a, b], [c, d]]: the sum over tables with the same margins that are no likelier.

    Weights of the possible tables relative to the given one follow from the ratio of neighbouring hypergeometric
    terms, upwards and downwards from it, as far as 12 standard deviations (and 30) beyond the most likely table,
    where nothing is left to add; so the work grows with the root of the depth. A given table that lies further out
    has its own probability from logarithms of factorials, and only the tail behind it is added. Null for a negative
    or null count.
    """
    a, b, c, d = (F.col(x) if isinstance(x, str) else x for x in (a, b, c, d))
    a, b, c, d = (x.cast("double") for x in (a, b, c, d))
    n, row, column = a + b + c + d, a + b, a + c
    mode = F.floor((row + 1) * (column + 1) / (n + 2))
    some = F.greatest(n, F.lit(2.0))
    spread = F.sqrt(row / some * ((c + d) / some) * column * ((b + d) / (some - 1)))
    reach = F.coalesce(F.ceil(12 * spread), F.lit(0)) + 30

    def walk(v: Column, steps: Column, up: bool) -> Column:
        def term(acc: Column, k: Column) -> Column:
            k = k.cast("double")
            ratio = (v["b"] - k + 1) * (v["c"] - k + 1) / ((v["a"] + k) * (v["d"] + k)) if up else (v["a"] - k + 1) * (v["d"] - k + 1) / ((v["b"] + k) * (v["c"] + k))
            log = acc["log"] + F.log(ratio)
            return let(log, lambda x: let(F.exp(x), lambda w: F.struct(x.alias("log"), (acc["all"] + w).alias("all"), (acc["tail"] + F.when(x <= 1e-9, w).otherwise(0.0)).alias("tail"))))

        start = F.struct(F.lit(0.0).alias("log"), F.lit(0.0).alias("all"), F.lit(0.0).alias("tail"))
        return let(steps, lambda n: F.aggregate(F.when(n > 0, F.sequence(F.lit(1), n.cast("int"))).otherwise(F.array().cast("array<int>")), start, term))

    def summed(v: Column) -> Column:
        # Far out, only the side away from the most likely table is walked.
        upward = F.when(v["far"], F.when(v["a"] > v["mode"], v["reach"]).otherwise(0)).otherwise(v["mode"] + v["reach"] - v["a"])
        downward = F.when(v["far"], F.when(v["a"] < v["mode"], v["reach"]).otherwise(0)).otherwise(v["a"] - v["mode"] + v["reach"])
        walks = F.struct(walk(v, F.least(v["b"], v["c"], upward), True).alias("up"), walk(v, F.least(v["a"], v["d"], downward), False).alias("down"))
        own = sum((log_factorial(x) for x in (row, c + d, column, b + d)), F.lit(0.0)) - sum((log_factorial(x) for x in (n, a, b, c, d)), F.lit(0.0))
        return let(walks, lambda w: (1.0 + w["up"]["tail"] + w["down"]["tail"]) * F.when(v["far"], F.exp(own)).otherwise(1 / (1.0 + w["up"]["all"] + w["down"]["all"])))

    given = F.struct(a.alias("a"), b.alias("b"), c.alias("c"), d.alias("d"), mode.alias("mode"), reach.alias("reach"), (F.abs(a - mode) > reach).alias("far"))
    return F.when((a >= 0) & (b >= 0) & (c >= 0) & (d >= 0), F.least(F.lit(1.0), let(given, summed)))


def odds_ratio(a, b, c, d) -> Column:
    """a d / (b c); infinite if only the denominator is 0, NaN if a margin is 0."""
    a, b, c, d = (F.col(x) if isinstance(x, str) else x for x in (a, b, c, d))
    a, b, c, d = (x.cast("double") for x in (a, b, c, d))
    empty = (a + b == 0) | (c + d == 0) | (a + c == 0) | (b + d == 0)
    return F.when(empty, F.lit(float("nan"))).when(b * c == 0, F.lit(float("inf"))).otherwise(F.try_divide(a * d, b * c))

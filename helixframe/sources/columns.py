"""Lines with an order, and headers with aliases."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _full_path(spark: SparkSession, path: str) -> str:
    """A path with its scheme, relative ones from the working folder; local files with one slash."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return re.sub("^file:/+", "file:/", system.makeQualified(found).toUri().toString())


def lines(spark: SparkSession, paths: str | list[str], encoding: str | None = None) -> DataFrame:
    """value, file and ord: the place of the file's path among ``paths`` (files of one folder by name), and of the line in the file."""
    value = F.decode(F.col("value").cast("binary"), encoding).alias("value") if encoding else F.col("value")
    file, given = F.col("_metadata.file_path"), [paths] if isinstance(paths, str) else list(paths)
    whole = [_full_path(spark, p) for p in given] if len(given) > 1 else []
    local = F.regexp_replace(file, "^file:/+", "file:/")
    place = F.coalesce(*(F.when((local == p) | local.startswith(p.rstrip("/") + "/"), F.lit(k)) for k, p in enumerate(whole)), F.lit(0))
    ord_ = F.struct(place.alias("path"), file.alias("name"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"))
    return spark.read.text(paths).select(value, file.alias("file"), ord_.alias("ord"))


def is_data(value: str = "value"):
    """Neither a comment nor blank."""
    return ~F.col(value).startswith("#") & (F.trim(F.col(value)) != "")


def typed(parts, schema: list[tuple[str, str]]):
    """Columns from an array of texts; what doesn't parse is null."""
    return [(F.get(parts, F.lit(k)) if t == "string" else F.get(parts, F.lit(k)).try_cast(t)).alias(n) for k, (n, t) in enumerate(schema)]


def case_collisions(names: list[str]) -> set[str]:
    """Upper-case names that several columns share."""
    return {n for n, k in Counter(x.upper() for x in names).items() if k > 1}


def resolve_columns(names: list[str], aliases: dict[str, list[str]]) -> dict[str, int]:
    """Position of each canonical name's column, by any alias; case counts only for names that differ in it alone."""
    collisions = case_collisions(names)
    place = {n if n.upper() in collisions else n.upper(): k for k, n in enumerate(names)}
    out = {}
    for canonical, others in aliases.items():
        for alias in [canonical, *others]:
            k = place.get(alias, place.get(alias.upper()))
            if k is not None:
                out[canonical] = k
                break
        else:
            raise ValueError(f"no column for {canonical}; tried {[canonical, *others]}")
    return out


def headers(rows: DataFrame, comment: str = "##") -> DataFrame:
    """file and head: the names on each file's first line that is neither a comment nor blank. Only starts of files are looked at."""
    lines_ = rows.where((F.col("ord.start") == 0) & ~F.col("value").startswith(comment) & (F.trim("value") != ""))
    first = lines_.groupBy("file").agg(F.min_by("value", "ord").alias("_first"))
    return first.select("file", F.split(F.regexp_replace("_first", "^#+", ""), "\t", -1).alias("head"))


def place_of(head, aliases: list[str]):
    """The place in a header of the first alias that it has: ``resolve_columns`` as an expression; null if it has none."""
    upper = F.transform(head, F.upper)
    keys = F.transform(head, lambda n: F.when(F.size(F.filter(upper, lambda u: u == F.upper(n))) > 1, n).otherwise(F.upper(n)))
    last = lambda name: F.size(head) - F.nullif(F.array_position(F.reverse(keys), name), F.lit(0))
    return F.coalesce(*(last(n) for alias in aliases for n in dict.fromkeys((alias, alias.upper()))))


def with_header(rows: DataFrame, aliases: dict[str, list[str]], types: dict[str, str] | None = None, comment: str = "##", optional: tuple[str, ...] = ()) -> DataFrame:
    """Rows below a header as columns with canonical names, and ord.

    Columns are told by each file's own header, so files may order them differently. A file without a header, or
    without one of the columns, is an error; of ``optional`` columns it is null.
    """
    types = types or {}
    heads = headers(rows, comment)
    missing = lambda n, others: F.raise_error(F.concat(F.lit(f"no column for {n}; tried {[n, *others]} in "), F.col("file")))
    places = {n: place_of(F.col("head"), [n, *others]) for n, others in aliases.items()}
    heads = heads.select("file", F.col("head")[0].alias("_zero"), *((p if n in optional else F.coalesce(p, missing(n, aliases[n]).cast("bigint"))).cast("int").alias(f"_at_{n}") for n, p in places.items()))
    parts = F.split("value", "\t", -1)
    body = rows.where(~F.col("value").startswith("#") & (F.trim("value") != "")).join(heads, "file", "left")
    zero = F.coalesce("_zero", F.raise_error(F.concat(F.lit("no header line in "), F.col("file"))))
    return body.where(F.get(parts, F.lit(0)) != zero).select(*(F.get(parts, F.col(f"_at_{n}")).try_cast(types.get(n, "string")).alias(n) for n in aliases), "ord")

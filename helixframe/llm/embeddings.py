"""Near-duplicate vectors by sorted projection passes.

Each pass hashes every vector to the signs of random projections, concatenated, and sorts by that hash.
Vectors are compared with those in their window of the order, pairs with a cosine of at least the threshold
are verified in double precision, and the pairs of all passes are united into components.

Links are then counted exactly within components: where all members lie within half the threshold's angle of
the component's centre, every pair is a link (angles are a metric), and counting needs no comparison; other
components are compared in blocks. Equal vectors are one row with a count throughout.

A pair at angle a shares a prefix of p bits with probability (1 - a/pi)^p, and windows of WINDOW to 2 x WINDOW
rows hold what shares about log2(rows / (1.5 x WINDOW)) bits. The number of passes follows from the number of
distinct vectors, so that RECALL of the pairs at the threshold meet at every size, and more of closer ones: at
0.9 there are 16 passes for 50,000 vectors, 29 for 600,000 and 43 for 3 million. That holds for vectors that
hashes spread evenly; windows go on over Arrow batches, but not over the ends of a pass's partitions.

Defined results: rows with a null, zero or non-finite vector link with nothing and are components of their own;
vectors of several lengths are compared within each length; rows with a null id come back with a null component;
of an id with several vectors one is taken; ties don't matter; an empty table gives an empty table. Other columns
are not read.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import materialize, remembered
from helixframe.llm.graph import connected_components
from helixframe.llm.vectors import classes, matrix, valid

#: Passes at least; more where RECALL needs them.
PASSES, BITS, WINDOW = 16, 48, 256
#: The share of pairs at the threshold that meet in some pass.
RECALL = 0.998
BLOCK_ROWS = 2_048


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # neither overflow nor underflow
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _roots(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The least id of each row's component."""
    label = ids.copy()
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (new == label).all():
            return label
        label = new


def passes_for(rows: int, threshold: float) -> int:
    """Passes that let RECALL of the pairs at the threshold meet among so many distinct vectors."""
    bits = math.log2(max(rows / (1.5 * WINDOW), 1))
    meets = (1 - math.acos(threshold) / math.pi) ** bits
    return PASSES if meets >= 1 else max(PASSES, math.ceil(math.log(1 - RECALL) / math.log1p(-meets)))


def pass_links(distinct: DataFrame, threshold: float, passes: int = PASSES, seed: int = 17) -> DataFrame:
    """(a, b): what the windows of all passes connect; b is the least class of a's component in a window."""
    mine = uuid.uuid4().hex

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, planes = 2 ** np.arange(BITS - 1, -1, -1, dtype=np.int64), remembered(mine, dict)
        for batch in batches:
            sizes = pc.list_value_length(batch.column(1)).to_numpy()
            for dims in np.unique(sizes).tolist():
                part = batch.take(pa.array(np.flatnonzero(sizes == dims)))
                if dims not in planes:
                    planes[dims] = np.random.default_rng([seed, dims]).normal(size=(passes, dims, BITS))
                x = matrix(part.column(1))
                for k in range(passes):
                    key = (x @ planes[dims][k] > 0) @ weights
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), dims, np.int32)), pa.array(np.full(len(x), k, np.int32)), pa.array(key), *part.columns], ["dims", "pass", "hash", "class", "vector"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, ids, x = None, np.zeros(0, np.int64), np.zeros((0, 0))
        for batch in batches:
            of_pass = batch.column(0).to_numpy().astype(np.int64) * passes + batch.column(1).to_numpy()
            for at in range(0, batch.num_rows, WINDOW):
                own = of_pass[at : at + WINDOW]
                for k in np.unique(own).tolist():
                    part = batch.slice(at, WINDOW).take(pa.array(np.flatnonzero(own == k)))
                    new_ids, new_x = part.column(3).to_numpy(), _unit(matrix(part.column(4)))
                    if k != turn:
                        turn, ids, x = k, new_ids[:0], new_x[:0]
                    both, y = np.concatenate([ids, new_ids]), np.concatenate([x, new_x])
                    linked = y @ y.T >= threshold
                    rows = np.flatnonzero(linked.sum(axis=1) > 1)
                    if len(rows):
                        roots = _roots(linked[np.ix_(rows, rows)], both[rows])
                        yield pa.RecordBatch.from_arrays([pa.array(both[rows]), pa.array(roots)], ["a", "b"])
                    ids, x = both[-WINDOW:], y[-WINDOW:]

    keyed = distinct.select("class", "vector").mapInArrow(hashes, f"dims int, pass int, hash bigint, class bigint, vector {dict(distinct.dtypes)['vector']}")
    order = ["dims", "pass", "hash", "class"]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(windows, "a bigint, b bigint").where("a <> b").distinct()


def _centred(rows: DataFrame, dims: int) -> DataFrame:
    """Adds the angle of each row from the centre of its component, null for vectors shorter than ``dims``."""
    size = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    rows = rows.withColumn("size", size)
    centre = rows.groupBy("component").agg(F.array(*(F.sum(F.get("vector", F.lit(k)) / F.col("size")) for k in range(dims))).alias("centre"))
    centre = materialize(centre, "centres")  # as a table of known size: a hot component is split, or nothing is shuffled
    dot = F.aggregate(F.zip_with("vector", "centre", lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    norm = F.sqrt(F.aggregate("centre", F.lit(0.0), lambda s, x: s + x * x))
    return rows.join(centre, "component").withColumn("angle", F.acos(F.least(F.lit(1.0), F.try_divide(dot, norm * F.col("size"))))).drop("centre", "size")


def _counted(rows: DataFrame, threshold: float) -> DataFrame:
    """(class, others): how many vectors of other classes each is linked with, compared in blocks per component."""
    sizes = materialize(rows.groupBy("component").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks")), "block-counts")
    mine = rows.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    mine = mine.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    mine = mine.select("component", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "class", "copies", "vector")

    def compare(group: pa.Table) -> pa.Table:
        x, copies, block = _unit(matrix(group.column("vector"))), group.column("copies").to_numpy(), group.column("block").to_numpy()
        lo, hi = group.column("lo")[0].as_py(), group.column("hi")[0].as_py()
        ids, found = group.column("class").to_numpy(), np.zeros(len(x), np.int64)
        left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        for at in range(0, len(left), 512):
            some = left[at : at + 512]
            linked = x[some] @ x[right].T >= threshold
            linked &= ids[some][:, None] != ids[right][None, :]
            found[some] += linked @ copies[right]
            if lo != hi:
                found[right] += copies[some] @ linked
        return pa.table({"class": ids, "others": found})

    pairs = mine.groupBy("component", "lo", "hi").applyInArrow(compare, "class bigint, others bigint")
    return pairs.groupBy("class").agg(F.sum("others").alias("others"))


def near_duplicates(df: DataFrame, threshold: float = 0.9, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per input row: key, n_links, component_id (the least key of the component), kept."""
    fine = df.where(valid(vector) & F.col(key).isNotNull())
    distinct, members = classes(fine, key, vector)
    members = materialize(members, "vector-classes")
    copies = members.groupBy("class").agg(F.count("*").alias("copies"))
    distinct = materialize(distinct.join(copies, "class"), "distinct-vectors")
    n_rows, dims = distinct.agg(F.count("*"), F.max(F.size("vector"))).first()
    alone = df.select(F.col(key).cast("bigint").alias(key))
    if not n_rows:
        return alone.select(key, F.lit(0).cast("bigint").alias("n_links"), F.col(key).alias("component_id"), F.lit(True).alias("kept"))
    components = connected_components(pass_links(distinct, threshold, passes_for(n_rows, threshold)))
    rows = materialize(_centred(distinct.join(components.withColumnRenamed("node", "class"), "class"), dims), "components")
    # Half the angle, less what rounding could move.
    limit = math.acos(threshold) / 2 - 1e-6
    known = F.count("angle") == F.count("*")
    shape = materialize(rows.groupBy("component").agg(F.sum("copies").alias("total"), F.when(known, F.max("angle")).alias("widest")), "component-shapes")
    tight = rows.join(shape.where(F.col("widest") <= limit), "component").select("class", "component", (F.col("total") - F.col("copies")).alias("others"))
    wide = rows.join(shape.where(~(F.coalesce(F.col("widest"), F.lit(9.0)) <= limit)).select("component"), "component")
    counted = _counted(wide, threshold).join(wide.select("class", "component"), "class")
    linked = tight.select("class", "component", "others").unionByName(counted.select("class", "component", "others"))
    of_class = distinct.select("class", "copies").join(linked, "class", "left")
    found = members.join(of_class, "class").select(
        F.col(key).alias("_key"),
        (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        F.coalesce("component", "class").alias("component_id"),
    )
    out = alone.join(found.dropDuplicates(["_key"]), F.col(key) == F.col("_key"), "left")
    return out.select(key, F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", key).alias("component_id"), F.coalesce(F.col("component_id") == F.col(key), F.lit(True)).alias("kept"))

"""Corpus preparation: toxic texts go, then texts without a language, then near copies; personal data is masked; the rest is packed.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; all but the last return the
columns of ``documents``. The classifier learns from the labelled documents of ``sf_dir``, scores ``docs``.
Packing fits no SQL, nor do the other stages, so tests compare them with plain versions.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm import langid, minhash, packing, pii, queries, toxicity
from helixframe.llm.common import fold, free_name, materialize, table

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under the operator's threshold; each row is scored where it stands.

    Null and empty texts get the score of a text without words; repeated rows go or stay together; an empty table
    stays empty, and other columns go along whatever their names.
    """
    name = free_name(docs, "toxicity_score")
    scored = toxicity.add_score(docs, queries.toxicity_model(spark, sf_dir), name=name)
    return scored.where(F.col(name) < toxicity.THRESHOLD).select(docs.columns)


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; learnt from the labelled part of the source table.

    Null texts, and texts without a letter, go; an empty table stays empty, and other columns go along whatever
    their names.
    """
    known, name = table(spark, sf_dir, "documents").where(fold("doc_id", 3) != 1), free_name(docs, "language")
    named = langid.add_language(docs, langid.learn(langid.sample(known)), name=name)
    return named.where(F.col(name) != langid.UNDETERMINED).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the least id.

    Rows that share an id are told apart by their texts (a 64-bit hash of both): of equal ones one stays, and each
    other text stays or goes by itself. Rows with a null id, and null texts, are copies of nothing but stay.
    """
    columns = docs.columns
    docs = docs.select("*").toDF(*(f"c{k}" if c not in ("doc_id", "text") else c for k, c in enumerate(columns)))
    keyed = docs.withColumn("_row", F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text")))
    found = minhash.near_duplicates(keyed, key="_row").where("_row is not null").distinct()
    found = materialize(found, "row-classes")
    groups = found.where(~F.col("kept")).select("class_id").distinct()
    ids = keyed.groupBy("_row").agg(F.min("doc_id").alias("doc_id"))
    rows = materialize(found.join(groups, "class_id", "left_semi").select("_row", "class_id").join(ids, "_row"), "copies")
    least = rows.groupBy("class_id").agg(F.min(F.struct("doc_id", "_row"))["_row"].alias("_least"))
    gone = rows.join(least, "class_id").where("_row <> _least").select("_row")
    again = keyed.where("_row is not null").groupBy("_row").count().where("count > 1").select("_row")
    # Both lists are stored, so that Spark knows their size and shuffles documents only for long ones.
    gone, again = materialize(gone, "gone"), materialize(again, "again")
    once = keyed.join(gone.unionByName(again).distinct(), "_row", "left_anti")
    rest = keyed.join(again, "_row", "left_semi").join(gone, "_row", "left_anti").dropDuplicates(["doc_id", "text"])
    return once.select(docs.columns).unionByName(rest.select(docs.columns)).toDF(*columns)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets replaced by their kind; n_chars follows. Null texts stay null, every row stays."""
    return pii.redact_pii(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in sequences of 2048 tokens; a null text is the end id alone."""
    with open(public_tokenizers.path("word_bpe_49k.json")) as f:
        return packing.pack(docs, f.read(), end_id=1, capacity=2048, keep_ids=False)


STAGES = [("toxicity", drop_toxic), ("language", keep_languages), ("near copies", drop_near_copies), ("personal data", mask_pii), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

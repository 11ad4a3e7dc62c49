"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm import bpe, collocations, divergence, embeddings, langid, minhash, neighbours, packing, pages, pii, quality, repeats, sql, toxicity
from helixframe.llm.common import fold, table


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(table(spark, sf_dir, "documents"))


def _digest(scored: DataFrame, n: int, held: int, threshold: float) -> DataFrame:
    return scored.select("doc_id", (fold("doc_id", n) == held).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    known = table(spark, sf_dir, "labels").where(fold("doc_id", 4) != 2)
    texts, labels = toxicity.labelled(table(spark, sf_dir, "documents"), known, "toxic", toxicity.SAMPLE_DOCS)
    return toxicity.learn(texts, labels, toxicity.share_of_ones(known, "toxic"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))
    return _digest(scored, 4, 2, toxicity.THRESHOLD)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = langid.learn(langid.sample(documents.where(fold("doc_id", 3) != 1)))
    return langid.identify(documents, model).select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, known = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    model = quality.learn(*toxicity.labelled(documents, known, "quality", quality.SAMPLE_DOCS))
    return _digest(quality.score(documents, model), 5, 0, quality.THRESHOLD)


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("word_bpe_49k.json")) as f:
        tokenizer = f.read()
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer, end_id=1, capacity=2048, keep_ids=False, remember=500_000)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.digest(bpe.decode(encoded, ranks))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("bigint"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), length=200).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"), least=10, ranks=2000)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), least_docs=30, ranks=50)


QUERIES = {
    f.__name__: f
    for f in (
        op1_embedding_dedup, op2_pii, op3_neighbours, op4_toxicity, op5_language, op6_minhash, op7_packing, op8_quality, op9_byte_bpe, op10_html,
        op11_suffix_dedup, op12_collocations, op13_source_divergence,
    )
}
ORACLE_SQL = sql.ORACLE_SQL

"""Sequencing-shaped tables derived from the given ones, in SQL that Spark and DuckDB read alike."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CONTIG = "CASE l_partkey % 24 WHEN 22 THEN 'chrX' WHEN 23 THEN 'chrY' ELSE concat('chr', CAST(l_partkey % 24 + 1 AS STRING)) END"
_BASE = "substr('ACGT', CAST(({}) % 4 AS INT) + 1, 1)"

PILEUP_TOKENS = f"""SELECT CASE l_linenumber % 2 WHEN 1 THEN 'tumor' ELSE 'normal' END AS sample, {_CONTIG} AS contig,
 l_partkey * 10 + l_suppkey % 10 AS position, {_BASE.format('l_partkey')} AS ref,
 concat(CASE WHEN l_linenumber = 1 THEN '^I' ELSE '' END, CASE l_orderkey % 12 WHEN 7 THEN {_BASE.format('l_partkey + 1')} WHEN 8 THEN lower({_BASE.format('l_partkey + 1')})
  WHEN 9 THEN '.+2AC' WHEN 10 THEN ',-1t' WHEN 11 THEN '*' WHEN 4 THEN ',' WHEN 5 THEN ',' WHEN 6 THEN ',' ELSE '.' END, CASE WHEN l_linenumber >= 6 THEN '$' ELSE '' END) AS tok,
 l_orderkey * 10 + l_linenumber AS ord FROM lineitem"""

CALLER_CALLS = f"""SELECT CASE l_linenumber % 3 WHEN 0 THEN 'haplotypecaller' WHEN 1 THEN 'mutect1' ELSE 'varscan' END AS source, {_CONTIG} AS contig,
 l_partkey * 10 + l_suppkey % 10 AS position, {_BASE.format('l_partkey')} AS ref, {_BASE.format('l_partkey + 1 + l_suppkey % 3')} AS alt,
 CAST(floor(l_quantity) AS INT) + 5 AS normal_depth, CAST(l_orderkey % 3 AS INT) AS normal_supporting,
 CAST(floor(l_quantity) AS INT) + CAST(l_partkey % 20 AS INT) + 5 AS tumor_depth, CAST(l_orderkey % 11 AS INT) AS tumor_supporting,
 l_orderkey * 10 + l_linenumber AS ord FROM lineitem"""

READ_METRICS = """SELECT l_partkey * 10 + l_suppkey % 10 AS position, l_returnflag AS allele_group, CAST(count(*) AS DOUBLE) AS reads,
 CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS DOUBLE) AS plus_reads, CAST(sum(CASE WHEN l_linestatus = 'O' THEN 0 ELSE 1 END) AS DOUBLE) AS minus_reads,
 round(avg(l_quantity), 6) AS avg_mapq, round(avg(l_discount * 10), 6) AS avg_read_pos, round(avg(l_tax * 1000), 6) AS avg_mmqs, round(avg(l_quantity * 3), 6) AS avg_len, round(avg(l_tax * 10), 6) AS avg_dist3
 FROM lineitem GROUP BY l_partkey * 10 + l_suppkey % 10, l_returnflag"""

_SEQUENCE = "upper(regexp_replace(text, '[^A-Za-z]', ''@@))"
_SEQUENCES = f"(SELECT doc_id, {_SEQUENCE} AS seq FROM documents)"

PROTEINS = f"""SELECT doc_id, seq, ppos AS pos, substr(seq, ppos, 1) AS ref_aa, CASE substr(seq, ppos, 1) WHEN 'A' THEN 'C' ELSE 'A' END AS alt_aa
 FROM (SELECT doc_id, seq, CAST(doc_id % length(seq) AS INT) + 1 AS ppos FROM {_SEQUENCES} a WHERE length(seq) >= 12) b"""

READS = """SELECT l_orderkey * 10 + l_linenumber AS read_id, concat('c', CAST(l_partkey % 24 AS STRING)) AS contig, l_partkey * 5 + l_suppkey % 10 AS start_pos,
 l_partkey * 5 + l_suppkey % 10 + CAST(floor(l_quantity) AS INT) - 1 AS end_pos, CASE l_returnflag WHEN 'R' THEN 16 WHEN 'N' THEN 4 ELSE 0 END AS flag,
 CAST(floor(l_extendedprice) AS BIGINT) AS qual_sum FROM lineitem"""

READ_ENDS = """SELECT concat('f', CAST(CAST(l_orderkey * 4 + floor((l_linenumber - 1) / 2) AS BIGINT) AS STRING)) AS name, CASE l_linenumber % 2 WHEN 1 THEN 65 ELSE 129 END + CASE l_partkey % 2 WHEN 1 THEN 16 ELSE 0 END + CASE l_suppkey % 17 WHEN 0 THEN 4 ELSE 0 END AS flag,
 concat('c', CAST(l_suppkey % 3 AS STRING)) AS contig, l_partkey % 40 AS five_prime, l_partkey % 2 = 1 AS reverse, CAST(floor(l_extendedprice) AS BIGINT) AS qual_sum FROM lineitem"""

INTERVALS = "SELECT concat('c', CAST(p_partkey % 24 AS STRING)) AS contig, p_partkey * 5 + 30 AS start_pos, p_partkey * 5 + 30 + p_size * 3 AS end_pos FROM part"

FASTQ_FILES = """SELECT concat('/seq/', lower(c_mktsegment), '-', CAST(c_custkey % 40 AS STRING), '-tumor_S', CAST(c_nationkey AS STRING), '_L00', CAST(c_custkey % 4 + 1 AS STRING),
 '_R', CAST(c_custkey % 2 + 1 AS STRING), '_001.fastq.gz') AS path FROM customer"""

HLA_ALLELES = """SELECT c_nationkey AS sample, substr('ABC', CAST(c_custkey % 3 AS INT) + 1, 1) AS molecule, c_custkey AS ord,
 concat(substr('ABC', CAST(c_custkey % 3 AS INT) + 1, 1), '*', lpad(CAST(c_custkey % 17 + 1 AS STRING), 2, '0'), ':', lpad(CAST(c_custkey % 5 + 1 AS STRING), 2, '0'), ':01') AS allele FROM customer"""


def spark_view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """The view over one table, without registering anything in the session.

    Sequences come from an explode of one: Spark copies a column's expression into each place of a filter that names
    it, which had the text of every document cleaned dozens of times, but not past an explode. An empty sequence is
    null, since Spark may work out ``doc_id % length(seq)`` before the filter that leaves short sequences out.
    """
    if _SEQUENCES in sql:
        cleaned = F.explode(F.array(F.expr(_SEQUENCE.replace("@@", "")))).alias("seq")
        given = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", cleaned).withColumn("seq", F.nullif("seq", F.lit("")))
        return spark.sql(sql.replace(_SEQUENCES, "{given}"), given=given)
    name = re.search(r"FROM (\w+)", sql)[1] if "FROM (" not in sql else "documents"
    return spark.sql(sql.replace("@@", "").replace(f"FROM {name}", "FROM {given}"), given=spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def duck(sql: str) -> str:
    return sql.replace("@@", ", 'g'")
